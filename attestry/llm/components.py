"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.common import stored

MAX_ROUNDS = 200


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node it reaches.

    Each round hangs the larger neighbours of a node on its smallest one, then the
    smaller ones; the rounds end when nothing changes, after about as many as the
    logarithm of the longest path. Neighbourhoods are never gathered: a round is
    minima by key and joins on the key, which adaptive execution splits where one
    node has very many links. Each round is written to the shared folder.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
