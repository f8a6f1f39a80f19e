"""Which names contain which, by an inverted index of character sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.operators.crowded import crowded_groups

# Length of the indexed sequences; shorter names are looked up whole.
GRAM = 4


def containment_links(
    left: DataFrame, right: DataFrame, group: str = "ras_id", gram: int = GRAM
) -> DataFrame:
    """(group, left, right): names of a group of which one contains the other, ignoring case.

    ``left`` and ``right`` are ``(group, name)``. Null and empty names have no links;
    equal pairs are one row.

    A name can lie only in names that hold each of its sequences, so it is looked
    up under the rarest one the other side has there; one that the other side lacks
    settles it. What is met is then compared whole. Names that share nothing rare
    are the only ones that meet in number.

    The index holds some sixty sequences per name, so only crowded groups have one.
    The names of the others are compared one by one.
    """
    ours, theirs = _names(left, group), _names(right, group)
    crowded = crowded_groups(ours, theirs, group)
    found = _links_by_pairs(ours.join(crowded, group, "left_anti"), theirs, group)
    indexed = (side.join(crowded, group, "left_semi") for side in (ours, theirs))
    return found.unionByName(_links_by_index(*indexed, group, gram))


def links_by_index(
    left: DataFrame, right: DataFrame, group: str = "ras_id", gram: int = GRAM
) -> DataFrame:
    """``containment_links`` of groups that are known to be crowded."""
    return _links_by_index(_names(left, group), _names(right, group), group, gram)


def _links_by_pairs(ours: DataFrame, theirs: DataFrame, group: str) -> DataFrame:
    pairs = ours.withColumnsRenamed({"low": "_left", "name": "left"}).join(
        theirs.withColumnsRenamed({"low": "_right", "name": "right"}), group
    )
    one, other = F.col("_left"), F.col("_right")
    linked = pairs.where(F.contains(one, other) | F.contains(other, one))
    return linked.select(group, "left", "right")


def _links_by_index(ours: DataFrame, theirs: DataFrame, group: str, gram: int) -> DataFrame:
    forth = _inside(ours, theirs, group, gram).select(group, "inner", "outer")
    back = _inside(theirs, ours, group, gram).select(
        group, F.col("outer").alias("inner"), F.col("inner").alias("outer")
    )
    links = forth.unionByName(back).distinct()
    return (
        links.withColumnsRenamed({"inner": "_left", "outer": "_right"})
        .join(ours.withColumnsRenamed({"low": "_left", "name": "left"}), [group, "_left"])
        .join(theirs.withColumnsRenamed({"low": "_right", "name": "right"}), [group, "_right"])
        .select(group, "left", "right")
    )


def _names(side: DataFrame, group: str) -> DataFrame:
    named = side.select(group, "name").where(F.col("name") != "").distinct()
    return named.withColumn("low", F.lower("name"))


def _sequences(length: int) -> object:
    """All sequences of ``length`` characters of ``low``, each once."""
    places = F.sequence(F.lit(1), F.length("low") - (length - 1))
    each = F.transform(places, lambda i: F.substring(F.col("low"), i, F.lit(length)))
    return F.when(F.length("low") >= length, F.array_distinct(each)).otherwise(
        F.array().cast("array<string>")
    )


def _inside(inner: DataFrame, outer: DataFrame, group: str, gram: int) -> DataFrame:
    """(group, inner, outer): lower-cased names and those they lie in."""
    lows = outer.select(group, "low").distinct()
    wanted = inner.select(group, "low").distinct()
    short = wanted.where(F.length("low") < gram)
    every = F.concat(_sequences(gram), *(_sequences(n) for n in range(1, gram)))
    index = lows.select(group, F.col("low").alias("outer"), F.explode(every).alias("key"))
    often = index.where(F.length("key") == gram).groupBy(group, "key").agg(F.count("*").alias("n"))
    # The rarest sequence of a name; one that is not there at all comes first.
    rarest = (
        wanted.where(F.length("low") >= gram)
        .select(group, F.col("low").alias("inner"), F.explode(_sequences(gram)).alias("key"))
        .join(often, [group, "key"], "left")
        .groupBy(group, "inner")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("_rarest"))
        .where(F.col("_rarest.n") > 0)
        .select(group, "inner", F.col("_rarest.key").alias("key"))
    )
    looked_up = rarest.unionByName(short.select(group, F.col("low").alias("inner"), F.col("low").alias("key")))
    met = looked_up.join(index, [group, "key"])
    return met.where(F.contains(F.col("outer"), F.col("inner"))).select(group, "inner", "outer")
