"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A group this large is numbered in slices. At most MAX_HOT groups can be hot:
# one that is not among the MAX_HOT largest holds under 1/MAX_HOT of all rows.
HOT_ROWS = 1_000_000
MAX_HOT = 4096


def hot_groups(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of the largest groups; never more than ``MAX_HOT`` rows."""
    return (
        rows.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") >= hot_rows)
        .orderBy(F.desc("_rows"), F.asc(key))
        .limit(MAX_HOT)
        .select(key)
    )


def number_within(
    rows: DataFrame, key: str, order: Sequence[str], name: str = "rn", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``row_number() over (partition by key order by order)``, safe for hot keys.

    A plain window sorts each group in one task. Here a hot group is cut into
    slices by the first column of ``order``, the slices are numbered apart, and
    each is shifted by the number of rows in the slices before it. Other groups
    are one slice. Which groups are hot never changes the result.

    The rows are shuffled once: the shift is joined on the keys they are already
    partitioned and sorted by.
    """
    lead = order[0]
    hot = hot_groups(rows, key, hot_rows).withColumn("_hot", F.lit(True))
    sliced = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.when(F.col("_hot"), F.col(lead))
    )
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.where("_hot")
        .groupBy(key, "_slice")
        .agg(F.count("*").alias("_rows"))
        .select(key, "_slice", F.sum("_rows").over(before).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    numbered = sliced.withColumn("_local", local).join(shifts, [key, "_slice"], "left")
    position = F.col("_local") + F.coalesce(F.col("_shift"), F.lit(0))
    return numbered.withColumn(name, position.cast("bigint")).drop(
        "_hot", "_slice", "_local", "_shift"
    )
