"""Running totals inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Numbers that one block spans. A block, not a group, is what one task sorts.
BLOCK = 4096


def with_totals_before(
    rows: DataFrame,
    group: Sequence[str],
    number: str,
    totals: dict[str, Column],
    order: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Add to every row the sum of each column over the rows before it in its group.

    Rows of a group are ordered by ``number``, ties by ``order``. A group is cut
    into blocks of ``block`` numbers; sums run inside blocks, and each block is
    shifted by what the earlier blocks of its group hold. The shifts come from one
    row per block and are joined on the keys the rows already lie by, so rows are
    shuffled once. Columns of ``group`` must not be null.
    """
    keys = [*group, "_block"]
    named = rows.withColumn("_block", F.floor(F.col(number) / F.lit(block)))
    named = named.withColumns({f"_{name}": value for name, value in totals.items()})
    inside = (
        Window.partitionBy(*keys)
        .orderBy(number, *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    held = named.groupBy(*keys).agg(*(F.sum(f"_{name}").alias(f"_all_{name}") for name in totals))
    shifts = held.select(
        *keys,
        *(F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_shift_{n}") for n in totals),
    )
    local = named.withColumns(
        {name: F.coalesce(F.sum(f"_{name}").over(inside), F.lit(0)) for name in totals}
    )
    shifted = local.join(shifts, keys).withColumns(
        {name: F.col(name) + F.col(f"_shift_{name}") for name in totals}
    )
    return shifted.drop("_block", *(f"_{n}" for n in totals), *(f"_shift_{n}" for n in totals))


def cut_in_chunks(
    placed: DataFrame, group: Sequence[str], chunk_chars: int, own: str = "own", start: str = "start"
) -> DataFrame:
    """``(*group, chunk_no, text)`` from texts that know where they start in that of their group.

    Chunk k (from 0) holds the characters from ``k * chunk_chars`` on. Texts are cut
    where chunks end and meet again by chunk, so no value is longer than a chunk.
    """
    size = F.lit(chunk_chars).cast("bigint")
    last = F.floor((F.col(start) + F.length(own) - 1) / size)
    numbers = F.sequence(F.floor(F.col(start) / size), last)
    cut = placed.where(F.length(own) > 0).withColumn("chunk_no", F.explode(numbers))
    begin = F.greatest(F.col("chunk_no") * size - F.col(start), F.lit(0)).cast("int")
    end = F.least((F.col("chunk_no") + 1) * size - F.col(start), F.length(own)).cast("int")
    pieces = cut.select(
        *group,
        "chunk_no",
        F.col(start).alias("_start"),
        F.substring(F.col(own), begin + 1, end - begin).alias("_piece"),
    )
    return pieces.groupBy(*group, "chunk_no").agg(
        F.expr("listagg(_piece, '') within group (order by _start)").alias("text")
    )
