"""Readers of database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.schemas import ATTACHMENT, ATTACHMENT_COLUMNS, ITEM, ITEM_COLUMNS


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read, split into ranges of ``partition_column`` if given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    split = (partition_column, lower, upper, num_partitions)
    if any(value is not None for value in split):
        if any(value is None for value in split):
            raise ValueError("a partitioned read needs its column, both bounds and a count")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table. Filters and pruned columns are pushed to the server by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def _renamed(rows: DataFrame, names: dict[str, str], schema: T.StructType) -> DataFrame:
    by_lower = {column.lower(): column for column in rows.columns}
    picked = []
    for source, target in names.items():
        column = by_lower.get(source.lower()) or by_lower.get(target)
        if column is None:
            raise ValueError(f"column {source} is missing")
        kind = schema[target].dataType
        value = F.col(column)
        if dict(rows.dtypes)[column] != kind.simpleString():
            value = value.cast(kind)
        picked.append(value.alias(target))
    return rows.select(*picked)


def attachments_from(rows: DataFrame) -> DataFrame:
    """Attachment rows under the names and types used here."""
    return _renamed(rows, ATTACHMENT_COLUMNS, ATTACHMENT)


def items_from(rows: DataFrame) -> DataFrame:
    """Item rows under the names and types used here."""
    return _renamed(rows, ITEM_COLUMNS, ITEM)
