"""Order-free comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = _rows(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    return (
        f"rows {actual.total()} vs {expected.total()};"
        f" only spark {list((actual - expected).items())[:3]};"
        f" only sql {list((expected - actual).items())[:3]}"
    )
