"""Mixing sources to target weights by temperature.

The share of a source in the tokens is raised to an exponent and normalised: 1
keeps the natural shares, 0 makes all equal. The exponent is bisected until the
weights meet a target: an entropy (as a part of the largest possible one), or a
limit on how often a source may be repeated. Weights become rows under a budget of
tokens: a source's documents are permuted, the permutation is passed through as
often as its quota holds it whole, and a last pass stops where the quota is met.

A permutation is made of blocks of a random number, each ordered and summed by
itself and shifted by what lies before it, so a source of any size is spread over
all tasks. Sources are counted first; their number, not the rows, bounds what the
driver sees.

Cases: null text has no tokens, null is a source of its own. A source without
tokens has weight 0 and each of its rows passes once, as no number of passes
changes its share. Rows are told apart by where they lie, so equal rows and repeated
keys are passed through each for itself. An empty table gives an empty result. The
permutation depends on ``seed`` and on how the input is laid out in files.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.common import blocks_for, partitions, stored, with_running_totals

SEED = 5
STEPS = 60  # of the bisection: more than the bits of a double in [0, 1]
MAX_SOURCES = 1_000_000


@dataclass(frozen=True)
class Target:
    """``entropy``: part of log(number of sources) the weights must reach, 0 to 1.

    ``repeats``: the most often a source may be passed through. With both, the
    entropy is met as far as the limit allows. ``budget``: tokens of the mix; None
    for the least number at which every source is passed through at least once, so
    that no document is left out.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Normalised weights of sources with these token counts."""
    most = max(tokens, default=0)
    raised = [exp(exponent * log(n / most)) if n else 0.0 for n in tokens]
    total = sum(raised)
    return [r / total for r in raised] if total else raised


def entropy(weights: list[float]) -> float:
    return -sum(w * log(w) for w in weights if w)


def budget_of(tokens: list[int], weights: list[float], target: Target) -> float:
    if target.budget is not None:
        return float(target.budget)
    return max((n / w for n, w in zip(tokens, weights) if w), default=0.0)


def passes(tokens: list[int], weights: list[float], target: Target) -> list[float]:
    """How often each source is passed through."""
    budget = budget_of(tokens, weights, target)
    return [w * budget / n if n else 1.0 for n, w in zip(tokens, weights)]


def solve(tokens: list[int], target: Target) -> float:
    """The largest exponent that meets the entropy and the least that keeps the limit, 0 to 1.

    Entropy falls and repeats fall as the exponent grows. Where even natural shares
    repeat too much (a budget beyond the corpus), 1 is the answer.
    """

    def bisect(low_side) -> float:
        low, high = 0.0, 1.0
        if low_side(high):
            return high
        for _ in range(STEPS):
            middle = (low + high) / 2
            if low_side(middle):
                low = middle
            else:
                high = middle
        return low

    exponent = 1.0
    if target.entropy is not None:
        wanted = target.entropy * log(max(1, sum(1 for n in tokens if n)))
        exponent = bisect(lambda a: entropy(tempered(tokens, a)) >= wanted)
    if target.repeats is not None:
        many = lambda a: max(passes(tokens, tempered(tokens, a), target), default=0) > target.repeats
        if many(exponent):
            low, high = exponent, 1.0
            for _ in range(STEPS):
                middle = (low + high) / 2
                low, high = (middle, high) if many(middle) else (low, middle)
            exponent = high
    return exponent


def words(text: str = "text") -> Column:
    """Words between ASCII white space, the token measure where no other is given."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


def quota(n: int, weight: float, budget: float, target: Target) -> int:
    """Tokens of a source with ``n``; without a given budget never below one whole pass.

    Doubles are too coarse for that: the source that fixes the budget gets exactly ``n``.
    """
    share = floor(weight * budget + 1e-6)
    if target.budget is not None:
        return share
    return n if weight and n / weight == budget else max(share, n)


def plan(counted: DataFrame, target: Target) -> list[tuple]:
    """(source, tokens, weight, quota) of every source, from one row each."""
    rows = counted.orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    tokens = [row["tokens"] for row in rows]
    weights = tempered(tokens, solve(tokens, target))
    budget = budget_of(tokens, weights, target)
    return [(row["source"], n, w, quota(n, w, budget, target)) for row, n, w in zip(rows, tokens, weights)]


def mix(
    documents: DataFrame,
    target: Target,
    key: str = "doc_id",
    source: str = "source",
    tokens: Column | None = None,
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """Keys with how often each is passed through.

    Returns ``key``, source, tokens, weight (of the source), passes. A document is in
    the last, broken pass if the tokens before it in the permutation are below what
    the quota leaves for that pass, so a quota is passed by less than one document.
    """
    spark = documents.sparkSession
    measured = stored(
        documents.select(
            F.col(key).alias("_key"),
            F.col(source).alias("source"),
            (words(text) if tokens is None else tokens).alias("tokens"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mixing",
    )
    counted = measured.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    counted_rows = counted.agg(F.sum("rows").alias("n")).first()["n"] or 0
    made = plan(counted, target)
    blocks = max(blocks_for(counted_rows), min(partitions(spark), counted_rows // 256 + 1))
    weights = spark.createDataFrame(
        [(s, s is None, n, w, q // n if n else 1, q % n if n else 0) for s, n, w, q in made],
        "_source string, _none boolean, _all bigint, weight double, _whole bigint, _rest bigint",
    )
    shuffled = measured.withColumn("_random", F.xxhash64(F.lit(seed), "_row")).withColumn(
        "_block", F.floor((F.col("_random") / 2.0**64 + 0.5) * blocks).cast("int")
    )
    ordered = with_running_totals(
        shuffled, "source", "_block", ["_random", "_row"], {"_upto": F.col("tokens")}
    )
    joined = ordered.join(
        weights,
        F.col("source").cast("string").eqNullSafe(F.col("_source")),
    )
    before = F.col("_upto") - F.col("tokens")
    return joined.select(
        F.col("_key").alias(key),
        "source",
        "tokens",
        "weight",
        (F.col("_whole") + (before < F.col("_rest")).cast("bigint")).alias("passes"),
    )


def realise(documents: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``documents`` with each row repeated as often as it is passed through.

    Rows of 0 passes go. Rows that share a key are all taken as often as the one
    of them that is taken most.
    """
    most = mixed.groupBy(F.col(key).alias("_mixed")).agg(F.max("passes").cast("int").alias("_passes"))
    joined = documents.join(most.where("_passes > 0"), F.col(key).eqNullSafe(F.col("_mixed")))
    repeated = joined.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_passes"))))
    return repeated.select(*documents.columns)
