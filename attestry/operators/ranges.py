"""Prices of documents against prices of items, without building many pairs.

Cases whose prices make few pairs are joined plainly. Of the others both sides are put
into one order. Running totals over that order count
the items between two bounds; the last and the next item before and behind a place
are carried along it. The order is cut into slices of a bounded number of rows, so a
case of any size, and prices however close, are spread over tasks.
"""

from __future__ import annotations

from sys import float_info

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.checks import PRICE_TOLERANCE, price_in_range, usable_price
from attestry.operators.crowded import crowded_groups

# Bounds are certain only up to this relative distance; what lies closer to a
# bound is tested by the rule itself. It is far above the error of doubles.
SLACK = 1e-9
# Prices within this distance of each other, as logarithms, share an edge key or
# lie under neighbouring ones.
EDGE_WIDTH = 1e-8
# Rows of one slice of a case.
SLICE_ROWS = 20_000
# Cells of the logarithm that are never parted, and how many of them one sum runs over.
CELLS_PER_E = 2**20
CELL_BITS = 17


def with_slices(events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``slice`` to ``(ras_id, at, ...)``: numbers that follow the order of ``at`` (> 0).

    Rows are counted by cells of about one millionth of the price. Two levels of
    running totals over the counts give the rows before a cell, and so its slice:
    a slice begins at most ``slice_rows`` rows after the one before, and holds no
    more than that plus one cell. The sums see cells, not rows.
    """
    named = events.withColumn("_cell", F.floor(F.ln("at") * CELLS_PER_E))
    cells = named.groupBy("ras_id", "_cell").agg(F.count("*").alias("_n"))
    cells = cells.withColumn("_part", F.shiftright("_cell", CELL_BITS))
    in_part = (
        Window.partitionBy("ras_id", "_part")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    in_case = (
        Window.partitionBy("ras_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = (
        cells.groupBy("ras_id", "_part")
        .agg(F.sum("_n").alias("_n"))
        .select("ras_id", "_part", F.coalesce(F.sum("_n").over(in_case), F.lit(0)).alias("_earlier"))
    )
    numbered = (
        cells.withColumn("_before", F.coalesce(F.sum("_n").over(in_part), F.lit(0)))
        .join(parts, ["ras_id", "_part"])
        .select(
            "ras_id", "_cell", F.floor((F.col("_earlier") + F.col("_before")) / slice_rows).alias("slice")
        )
    )
    return named.join(numbered, ["ras_id", "_cell"]).drop("_cell")


def hits_by_price(ours: DataFrame, stored: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(ras_id, extracted_price, hits): items whose original passes ``price_in_range``.

    ``ours`` is ``(ras_id, extracted_price)``, distinct; ``stored`` is ``(ras_id,
    original, items)`` with distinct prices and their counts. Prices without a hit
    may be missing.

    The pairs of small cases are tested one by one; ``hits_by_slices`` serves the rest.
    """
    ours = ours.where(usable_price("extracted_price") > 0)
    stored = stored.where(usable_price("original") > 0)
    crowded = crowded_groups(ours, stored)
    pairs = ours.join(crowded, "ras_id", "left_anti").join(stored, "ras_id")
    passed = pairs.where(price_in_range("extracted_price", "original"))
    few = passed.groupBy("ras_id", "extracted_price").agg(F.sum("items").alias("hits"))
    many = (side.join(crowded, "ras_id", "left_semi") for side in (ours, stored))
    return few.unionByName(hits_by_slices(*many, slice_rows))


def hits_by_slices(ours: DataFrame, stored: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``hits_by_price`` without any pair of a price and an item.

    For a positive price e the originals in range form an interval about
    ``e / 1.2 .. e / 0.8``. Its sure part is counted by running totals, the two
    narrow edges by the rule, so the result is exactly that of the pairs.
    """
    ours = ours.where(usable_price("extracted_price") > 0)
    stored = stored.where(usable_price("original") > 0)
    low = F.col("extracted_price") / (1 + PRICE_TOLERANCE)
    # The bound of the largest prices is beyond all numbers: the largest number will do.
    high = F.least(F.col("extracted_price") / (1 - PRICE_TOLERANCE), F.lit(float_info.max))
    sure = _sure_hits(ours, stored, low * (1 + SLACK), high * (1 - SLACK), slice_rows)
    parts = sure.unionByName(_edge_hits(ours, stored, low, high))
    return parts.groupBy("ras_id", "extracted_price").agg(F.sum("hits").alias("hits"))


def pairs_in_range(ours: DataFrame, stored: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row ``hits``: how many pairs of a case pass ``price_in_range``.

    ``ours`` is ``(ras_id, extracted_price, docs)``, with distinct prices and their
    counts; ``stored`` as in ``hits_by_price``.
    """
    hits = hits_by_price(ours.select("ras_id", "extracted_price"), stored, slice_rows)
    met = ours.join(hits, ["ras_id", "extracted_price"])
    return met.agg(F.coalesce(F.sum(F.col("docs") * F.col("hits")), F.lit(0)).alias("hits"))


def _sure_hits(
    ours: DataFrame, stored: DataFrame, first: Column, last: Column, slice_rows: int
) -> DataFrame:
    """Items between ``first`` and ``last``, both included: one running total minus another."""
    nothing = F.lit(None).cast("double")
    events = (
        stored.select(
            "ras_id", F.col("original").alias("at"), F.lit(1).alias("rank"), "items",
            F.lit(0).alias("sign"), nothing.alias("extracted_price"),
        )
        .unionByName(_bound(ours, first, 0, -1))
        .unionByName(_bound(ours, last, 2, 1))
    )
    sliced = with_slices(events, slice_rows)
    inside = (
        Window.partitionBy("ras_id", "slice")
        .orderBy("at", "rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy("ras_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        sliced.groupBy("ras_id", "slice")
        .agg(F.sum("items").alias("_held"))
        .select("ras_id", "slice", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_shift"))
    )
    running = sliced.withColumn("_running", F.sum("items").over(inside)).where("sign <> 0")
    counted = running.join(shifts, ["ras_id", "slice"])
    return counted.groupBy("ras_id", "extracted_price").agg(
        F.sum(F.col("sign") * (F.col("_running") + F.col("_shift"))).alias("hits")
    )


def _bound(ours: DataFrame, at: Column, rank: int, sign: int) -> DataFrame:
    return ours.select(
        "ras_id",
        at.alias("at"),
        F.lit(rank).alias("rank"),
        F.lit(0).cast("bigint").alias("items"),
        F.lit(sign).alias("sign"),
        "extracted_price",
    )


def _edge_hits(ours: DataFrame, stored: DataFrame, low: Column, high: Column) -> DataFrame:
    """Items next to a bound, outside the sure part, tested by the rule.

    An equi-join on a fine key of the logarithm: few originals lie there.
    """
    edges = F.array(
        F.struct(low * (1 - SLACK) * (1 - SLACK), low * (1 + SLACK), F.lit(False)),
        F.struct(high * (1 - SLACK), high * (1 + SLACK) * (1 + SLACK), F.lit(True)),
    ).cast("array<struct<start: double, stop: double, upper: boolean>>")
    start_key = F.floor(F.ln("edge.start") / EDGE_WIDTH)
    near = (
        ours.withColumn("edge", F.explode(edges))
        .withColumn("key", F.explode(F.array(start_key, start_key + 1)))
        .join(
            stored.withColumn("key", F.floor(F.ln("original") / EDGE_WIDTH)), ["ras_id", "key"]
        )
    )
    original = F.col("original")
    # The sure part includes its own ends, the edges leave them out.
    on_edge = F.when(
        F.col("edge.upper"), (original > F.col("edge.start")) & (original <= F.col("edge.stop"))
    ).otherwise((original >= F.col("edge.start")) & (original < F.col("edge.stop")))
    passed = near.where(on_edge & price_in_range("extracted_price", "original"))
    return passed.select("ras_id", "extracted_price", F.col("items").alias("hits"))


def nearest_prices(ours: DataFrame, stored: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(ras_id, extracted_price, nearest): the original closest to each price of ours.

    ``ours`` is ``(ras_id, extracted_price)``, ``stored`` ``(ras_id, original)``, both
    distinct. Of two originals equally close the smaller one counts. Only positive
    prices are compared; a case without an original has no row.

    The pairs of small cases are looked at one by one; ``nearest_by_slices`` serves the rest.
    """
    ours = ours.where(usable_price("extracted_price") > 0)
    stored = stored.where(usable_price("original") > 0)
    crowded = crowded_groups(ours, stored)
    pairs = ours.join(crowded, "ras_id", "left_anti").join(stored, "ras_id")
    last, following = neighbours("extracted_price", "original")
    few = (
        pairs.groupBy("ras_id", "extracted_price")
        .agg(last.alias("_last"), following.alias("_next"))
        .select("ras_id", "extracted_price", closest("extracted_price").alias("nearest"))
    )
    many = (side.join(crowded, "ras_id", "left_semi") for side in (ours, stored))
    return few.unionByName(nearest_by_slices(*many, slice_rows))


def neighbours(price: str, original: str) -> tuple[Column, Column]:
    """Aggregates: the last original not above a price, and the next one above it."""
    value = F.col(original)
    return F.max(F.when(value <= F.col(price), value)), F.min(F.when(value > F.col(price), value))


def closest(price: str) -> Column:
    """Of ``_last`` and ``_next`` the one closer to the price, ``_last`` if they are equally close."""
    closer = F.col("_next") - F.col(price) < F.col(price) - F.col("_last")
    return F.when(F.col("_last").isNull() | closer, F.col("_next")).otherwise(F.col("_last"))


def nearest_by_slices(ours: DataFrame, stored: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``nearest_prices`` without any pair of a price and an item.

    An as-of merge: in the common order each price sees the last item before it
    and the next one behind it, in its slice or carried over from others.
    """
    ours = ours.where(usable_price("extracted_price") > 0)
    stored = stored.where(usable_price("original") > 0)
    nothing = F.lit(None).cast("double")
    events = stored.select(
        "ras_id", F.col("original").alias("at"), F.lit(1).alias("rank"),
        F.col("original").alias("item"), nothing.alias("extracted_price"),
    ).unionByName(
        ours.select(
            "ras_id", F.col("extracted_price").alias("at"), F.lit(2).alias("rank"),
            nothing.alias("item"), "extracted_price",
        )
    )
    sliced = with_slices(events, slice_rows)
    order = Window.partitionBy("ras_id", "slice").orderBy("at", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    by_slice = Window.partitionBy("ras_id").orderBy("slice")
    carried = (
        sliced.groupBy("ras_id", "slice")
        .agg(F.max("item").alias("_most"), F.min("item").alias("_least"))
        .select(
            "ras_id",
            "slice",
            F.max("_most").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)).alias("_from"),
            F.min("_least").over(by_slice.rowsBetween(1, Window.unboundedFollowing)).alias("_to"),
        )
    )
    placed = sliced.withColumns(
        {"_last": F.max("item").over(before), "_next": F.min("item").over(behind)}
    ).where("rank = 2")
    met = placed.join(carried, ["ras_id", "slice"]).withColumns(
        {"_last": F.coalesce("_last", "_from"), "_next": F.coalesce("_next", "_to")}
    )
    return met.select(
        "ras_id", "extracted_price", closest("extracted_price").alias("nearest")
    ).where(F.col("nearest").isNotNull())
