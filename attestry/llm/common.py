"""Helpers that the operators share: tables, shared storage, group-free numbering."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that one window partition of ``numbered`` is meant to hold.
BLOCK_ROWS = 65_536
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names; one of its own only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = tempfile.mkdtemp(prefix="attestry-")
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet to the shared folder and read back.

    This cuts the lineage: what follows rereads files that every executor sees,
    and random or physical choices made before are fixed from here on. The shuffle
    files of the write go when it has ended, as nothing reads them again.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    written = spark.read.schema(frame.schema).parquet(path)
    written._stored_path = path
    return written


def dropped(*frames: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again: all that came of them is stored."""
    for frame in frames:
        session = frame.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(frame._stored_path)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks_for(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, -(-rows // block_rows))


def with_running_totals(
    rows: DataFrame, group: str, block: str, order: list, totals: dict[str, Column]
) -> DataFrame:
    """Running totals (inclusive) of each column in ``totals`` within ``group``.

    Rows of a group are ordered by ``block`` and then by ``order``. No task gets a
    whole group: totals are kept per block, blocks are shifted by what lies before
    them. ``block`` has to be spread evenly over the rows by the caller.
    """
    from pyspark.sql import Window

    named = rows.withColumns({f"_{name}": value for name, value in totals.items()})
    sums = named.groupBy(group, block).agg(*(F.sum(f"_{n}").alias(f"_sum_{n}") for n in totals))
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(group).alias("_of_group"),
        F.col(block).alias("_of_block"),
        *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals),
    )
    inside = Window.partitionBy(group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = named.withColumns({n: F.sum(f"_{n}").over(inside) for n in totals})
    joined = local.join(
        sums, F.col(group).eqNullSafe(F.col("_of_group")) & (F.col(block) == F.col("_of_block"))
    )
    return joined.withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in totals}).drop(
        "_of_group", "_of_block", *(f"_{n}" for n in totals), *(f"_before_{n}" for n in totals)
    )


def worker_memory(name: str, build):
    """What ``build`` returns, kept in the Python worker for its later tasks.

    ``name`` must say all that ``build`` depends on. Only for things of bounded
    size that speed up work and do not change results.
    """
    import sys
    import types

    holder = sys.modules.setdefault("_attestry_worker", types.ModuleType("_attestry_worker"))
    if not hasattr(holder, "kept"):
        holder.kept = {}
    if name not in holder.kept:
        if len(holder.kept) >= 2:
            holder.kept.clear()
        holder.kept[name] = build()
    return holder.kept[name]


def whole_groups(batches):
    """Batches cut so that rows of one first column, which must be sorted, stay together."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None and rest.num_rows:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        keys = batch.column(0).to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield batch.slice(0, cut)
        rest = batch.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def runs(keys):
    """Start and end of each run of equal keys."""
    import numpy as np

    starts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
    return zip(starts[:-1], starts[1:])


def in_block_pairs(rows: DataFrame, group: str, item: str, size: int) -> DataFrame:
    """``rows`` dealt so that any two of a group meet in one block pair.

    A group is cut into blocks of about ``size`` by a hash of ``item``. Each row goes
    to the pairs of its block with every block of the group, with ``pair`` (the name
    of the pair) and ``side``: 0 or 1 in a pair of different blocks, 2 where a block
    meets itself.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    blocks = rows.join(sizes, group).withColumn("_blocks", F.ceil(F.col("_n") / size).cast("int"))
    blocks = blocks.withColumn("_own", F.pmod(F.xxhash64(item, F.lit(31)), "_blocks").cast("int"))
    spread = blocks.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    name = F.xxhash64(group, F.least("_own", "_other"), F.greatest("_own", "_other"))
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0)
    return spread.select(
        *rows.columns, name.alias("pair"), side.otherwise(1).cast("int").alias("side")
    )
