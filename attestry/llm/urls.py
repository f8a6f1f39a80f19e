"""URL filters: host and path rules, and logistic regression where no rule fits.

A rule is a host and a path: it fits the host itself and all its subdomains if the
path starts with the rule's; the longest rule wins. Other URLs are judged by a
logistic regression on hashed character n-grams of host and path. It is trained
from a small labelled URL table on the driver, in a fixed order of rows and
iterations, so that equal input gives equal weights.

Cases: null and malformed URLs (no ``://``) have an empty host and path and are
judged by the regression like all others; without labelled rows all weights are
zero and it allows. Repeated rows are judged each for itself and learned from once;
an empty table gives an empty one. URLs are read whole, whatever their length.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1_000  # rules are compiled into one expression
MAX_LABELLED = 5_000  # labelled URLs that the regression is fitted on
WEIGHTS = 1 << 14
GRAMS = (2, 3, 4)
ROUNDS, RATE, DECAY = 150, 8.0, 1e-5


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.

    ``rules`` are pairs of verdict and ``host/path``.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    cases = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        inside = (host_ == name) | host_.endswith("." + name)
        cases.append(
            F.when(
                inside & path_.startswith("/" + rest),
                F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")),
            )
        )
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*cases, none)


def features(host_: str, path_: str) -> list[int]:
    """Hashed n-grams of host and path, told apart by a prefix, ends marked."""
    found = []
    for kind, value in (("h", f"^{host_}$"), ("p", f"^{path_}$")):
        for n in GRAMS:
            found += [
                crc32((kind + value[i : i + n]).encode()) % WEIGHTS
                for i in range(max(1, len(value) - n + 1))
            ]
    return found


def fit(labelled: DataFrame, limit: int = MAX_LABELLED) -> list[float]:
    """Weights from rows (host, path, label), label 1 for URLs to block.

    The fit takes at most ``limit`` different rows, those with the smallest hash:
    a bounded sample of labelled rows, whatever the size of the table.
    """
    import numpy as np

    order = [F.xxhash64("host", "path"), "host", "path", "label"]
    rows = labelled.select("host", "path", "label").distinct().orderBy(*order).limit(limit).collect()
    weights = np.zeros(WEIGHTS)
    if not rows:
        return weights.tolist()
    lists = [features(r["host"], r["path"]) for r in rows]
    sizes = np.array([len(x) for x in lists])
    flat, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), sizes)
    value = (1.0 / np.sqrt(sizes))[row]
    label = np.array([float(r["label"]) for r in rows])
    # Both labels weigh the same.
    share = label.mean()
    weight = np.where(label > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    for _ in range(ROUNDS):
        score = np.bincount(row, weights[flat] * value, minlength=len(lists))
        error = (1 / (1 + np.exp(-score)) - label) * weight
        slope = np.bincount(flat, error[row] * value, minlength=WEIGHTS) / len(lists)
        weights -= RATE * (slope + DECAY * weights)
    return weights.tolist()


def blocked_chance(rows: DataFrame, weights: list[float], key: str) -> DataFrame:
    """``rows`` of (key, host, path, rule, verdict) with the chance that a URL is to be blocked.

    Each distinct URL of a batch is scored once.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches):
        from math import exp, sqrt

        import pyarrow as pa

        for batch in batches:
            columns = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            urls = list(zip(columns["host"].to_pylist(), columns["path"].to_pylist()))
            known = {}
            for url in dict.fromkeys(urls):
                found = features(*url)
                score = sum(weights[f] for f in found) / sqrt(len(found))
                known[url] = 1 / (1 + exp(-max(-700.0, min(700.0, score))))
            chance = pa.array([known[u] for u in urls], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, chance], names=[*batch.schema.names, "chance"])

    return rows.mapInArrow(run, f"{kinds}, chance double")


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labelled: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key``, host, path, rule, verdict, chance of every URL.

    ``labelled`` holds host, path and label (1: block). Without it the URLs that a
    rule fits are the labelled table.
    """
    parts = pages.select(
        F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path")
    )
    ruled = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).select(
        key, "host", "path", "_rule.rule", "_rule.verdict"
    )
    if labelled is None:
        labelled = ruled.where("rule is not null").select(
            "host", "path", (F.col("verdict") == "block").cast("int").alias("label")
        )
    scored = blocked_chance(ruled, fit(labelled), key)
    by_chance = F.when(F.col("chance") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("verdict", by_chance))
