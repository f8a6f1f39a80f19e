"""Sizes, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestry.functions.text import as_column
from attestry.schemas import SIZE_BUCKETS

MIB = 1024 * 1024

# Unit names, and the lower edge in MiB of every size bucket but the first.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")
BUCKET_EDGES_MIB = (1, 10, 50, 100)


def round1(value: Column | str) -> Column:
    """Round a non-negative double to one decimal by its exact binary value.

    ``round`` and ``bround`` look at the shortest decimal text of a double, so
    0.05 (a little more than a twentieth) counts as a tie there. Here the value
    p is held against the midpoint m = (2j+1)/20 above its tenth j = floor(10p).
    20p > 2j+1 is tested as 4p > (2j+1) - 16p: both products are exact, and near
    the midpoint so is the difference. True ties go to the even tenth.
    """
    p = as_column(value).cast("double")
    tenth = F.floor(p * 10)
    rest = (tenth * 2 + 1) - p * 16
    step = F.when(p * 4 > rest, 1).when(p * 4 == rest, tenth % 2).otherwise(0)
    return (tenth + step) / F.lit(10.0)


def percentage(part: Column | str, total: Column | str) -> Column:
    """Share of a total in percent, one decimal; null for an empty total."""
    part, total = as_column(part), as_column(total)
    share = F.when(total != 0, part.cast("double") / total * 100)
    return round1(share)


def format_size(size: Column | str) -> Column:
    """Size in the largest unit below 1024, one decimal, e.g. ``1.2 KB``."""
    value = as_column(size).cast("double")

    def by_magnitude(choices: list) -> Column:
        chosen = F.when(value < 1024.0, choices[0])
        for power, choice in enumerate(choices[1:-1], start=2):
            chosen = chosen.when(value < 1024.0**power, choice)
        return chosen.when(value.isNotNull(), choices[-1])

    divisor = by_magnitude([1024.0**power for power in range(len(SIZE_UNITS))])
    number = F.format_string("%.1f", round1(value / divisor))
    return F.concat(number, F.lit(" "), by_magnitude(list(SIZE_UNITS)))


def size_bucket(size: Column | str) -> Column:
    """Label of the size bucket; every bucket includes its lower edge."""
    size = as_column(size)
    label = F.when(size < BUCKET_EDGES_MIB[0] * MIB, SIZE_BUCKETS[0])
    for edge, name in zip(BUCKET_EDGES_MIB[1:], SIZE_BUCKETS[1:-1]):
        label = label.when(size < edge * MIB, name)
    return label.when(size.isNotNull(), SIZE_BUCKETS[-1])
