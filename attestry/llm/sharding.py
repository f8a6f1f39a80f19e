"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in blocks (the partitions they were read in). How many rows of a block go
to a shard is drawn exactly, as a uniform permutation of all rows would have it:
block after block from the multivariate hypergeometric distribution of the places
left. Then each block is permuted by itself and dealt by its row of the matrix,
the rows are exchanged, and each shard is permuted again. Shard sizes are at most
one row apart, the law of ``rows``.

Only keys and random numbers move; a shard is permuted in slices by ranges of the
random number, each numbered by itself and shifted, so no task holds a shard. The
matrix has a row for each partition and is drawn on the driver.

The rows are first written to the shared folder: a lost executor then rereads the
same blocks and random numbers. The result depends on ``seed`` and on how the input
is laid out in files.

Cases: rows are told apart by where they lie, so equal rows, null keys and ties are
dealt like all others; null text has no bytes; an empty table gives an empty result.
With fewer rows than shards the first shards get one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import blocks_for, partitions, stored, with_running_totals

SEED = 71


def communication_matrix(blocks: list[int], shards: list[int], seed: int):
    """Rows of each block for each shard: a uniform draw with these row and column sums."""
    import numpy as np

    random = np.random.default_rng(seed)
    left = np.array(shards, dtype=np.int64)
    drawn = []
    for rows in blocks:
        row = np.zeros(len(left), dtype=np.int64)
        rest, wanted = int(left.sum()), rows
        for shard in range(len(left)):
            rest -= int(left[shard])
            if wanted:
                row[shard] = split(random, int(left[shard]), rest, wanted)
                wanted -= int(row[shard])
        left -= row
        drawn.append(row)
    return drawn


def split(random, good: int, bad: int, wanted: int) -> int:
    """A hypergeometric number, also where the library's limit of 10^9 is passed."""
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, wanted))
    if wanted > 500_000_000:
        half = wanted // 2
        first = split(random, good, bad, half)
        return first + split(random, good - first, bad - half + first, wanted - half)
    # Few draws from very many places: one after the other, in closed form per chunk.
    found = 0
    for _ in range(wanted):
        if random.integers(good + bad) < good:
            found, good = found + 1, good - 1
        else:
            bad -= 1
    return found


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def assign(rows: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``rows`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard).

    Give it keys and what must travel with them, not whole texts; join or write by
    (shard, slot) after. Columns starting with an underscore are reserved.
    """
    spark = rows.sparkSession
    placed = stored(
        rows.select(
            "*",
            F.spark_partition_id().alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        ).select(
            "*",
            F.xxhash64(F.lit(seed), "_row").alias("_first"),
            F.xxhash64(F.lit(seed + 1), "_row").alias("_second"),
        ),
        "sharding",
    )
    counts = placed.groupBy("_block").count().orderBy("_block").collect()  # one per partition
    total = sum(c["count"] for c in counts)
    matrix = communication_matrix([c["count"] for c in counts], shard_sizes(total, shards), seed)
    ends = [
        (c["_block"], [int(e) for e in drawn.cumsum()]) for c, drawn in zip(counts, matrix)
    ]
    ends = spark.createDataFrame(ends, "_block int, _ends array<bigint>")
    # Permute each block and deal it out by its row of the matrix.
    local = Window.partitionBy("_block").orderBy("_first", "_row")
    dealt = (
        placed.withColumn("_place", F.row_number().over(local))
        .join(ends, "_block")
        .withColumn("shard", F.size(F.filter("_ends", lambda e: e < F.col("_place"))))
    )
    # Permute each shard, slice by slice of the second random number.
    slices = blocks_for(total // max(1, shards))
    slices = max(slices, min(partitions(spark), total // max(1, shards) // 256 + 1))
    sliced = dealt.drop("_block", "_ends", "_place").withColumn(
        "_slice", F.floor((F.col("_second") / 2.0**64 + 0.5) * slices).cast("int")
    )
    numbered = with_running_totals(
        sliced, "shard", "_slice", ["_second", "_row"], {"_slot": F.lit(1).cast("bigint")}
    )
    return numbered.select(*rows.columns, "shard", (F.col("_slot") - 1).alias("slot"))


def shard_documents(
    documents: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every document.

    ``size`` is the UTF-8 length of the text plus one. ``grown_shard`` is null:
    under the law of ``rows`` one more shard is a new draw.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = documents.select(
        F.col(key),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    return assign(slim, shards, seed).select(
        key,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
