"""Which groups two sides may meet in row by row, and which need a way that builds no pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group is joined plainly if that makes at most so many pairs for each of its rows,
# and so many in all.
PAIRS_PER_ROW = 16
PAIRS_PER_GROUP = 100_000


def crowded_groups(
    left: DataFrame,
    right: DataFrame,
    group: str = "ras_id",
    pairs_per_row: int = PAIRS_PER_ROW,
    pairs_per_group: int = PAIRS_PER_GROUP,
) -> DataFrame:
    """Groups whose rows would make too many pairs; the others make few more than they have rows.

    No row is left out by either way: every group that both sides have is joined
    plainly or is one of these.
    """
    ours = left.groupBy(group).agg(F.count("*").alias("_ours"))
    theirs = right.groupBy(group).agg(F.count("*").alias("_theirs"))
    pairs = F.col("_ours") * F.col("_theirs")
    most = F.least(pairs_per_row * (F.col("_ours") + F.col("_theirs")), F.lit(pairs_per_group))
    return ours.join(theirs, group).where(pairs > most).select(group)
