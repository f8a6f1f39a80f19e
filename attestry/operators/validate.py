"""Cross-checks of extracted documents against database rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.checks import (
    has_digit,
    improvement,
    is_better,
    is_garbage,
    name_length,
    price_in_range,
    supplier_match,
    usable_price,
)
from attestry.operators.containment import links_by_index
from attestry.operators.crowded import crowded_groups
from attestry.operators.ranges import (
    closest,
    hits_by_slices,
    nearest_by_slices,
    neighbours,
)
from attestry.operators.storage import stored
from attestry.schemas import IMPROVEMENTS

EXAMPLES = 3

# Members of documents and items that a report reads; tables for it need no others.
LINK_MEMBERS = ("is_quotation", "meta.ras_id", "quotation_data.supplier_name")
LINK_COLUMNS = ("ras_id", "supplier")
SUMMARY_MEMBERS = (*LINK_MEMBERS, "quotation_data.quoted_price")
SUMMARY_COLUMNS = (*LINK_COLUMNS, "original_inr")
CHECK_MEMBERS = (
    "json_file",
    "is_quotation",
    "meta.ras_id",
    "meta.file_name",
    "quotation_data.quoted_price",
    "quotation_data.canonical_item_name",
)
CHECK_COLUMNS = ("ras_id", "item_name", "original_inr")


def document_cases(docs: DataFrame) -> DataFrame:
    """Distinct case ids of the documents, as text."""
    ids = docs.select(F.col("meta.ras_id").alias("ras_id"))
    return ids.where(F.coalesce("ras_id", F.lit("")) != "").distinct()


def rows_of_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Database rows (items or attachments) of the cases that have documents."""
    cases = document_cases(docs).withColumnRenamed("ras_id", "_case")
    matches = rows["ras_id"].cast("string") == cases["_case"]
    return rows.join(cases, matches, "left_semi")


def doc_classification(docs: DataFrame) -> DataFrame:
    """Stored label and verified type of every document."""
    return docs.select(
        F.col("meta.ras_id").alias("ras_id"),
        F.col("meta.file_name").alias("file_name"),
        F.col("meta.att_type_from_db").alias("att_type_from_db"),
        F.col("document_classification.verified_type").alias("our_verified_type"),
        F.col("document_classification.confidence").alias("our_confidence"),
        F.col("document_classification.att_type_matches_content").alias("matches"),
        F.col("document_classification.classification_reason").alias("reason"),
    )


def classification_counts(checks: DataFrame) -> DataFrame:
    """One row: labels that fit, labels that do not, labels not judged."""
    return checks.agg(
        F.count("*").alias("documents"),
        F.count_if("matches").alias("matches"),
        F.count_if(~F.col("matches")).alias("mismatches"),
        F.count_if(F.col("matches").isNull()).alias("not_judged"),
    )


def mismatch_examples(checks: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """The first documents whose label does not fit."""
    wrong = checks.where(~F.col("matches"))
    order = ["ras_id", "file_name", "att_type_from_db", "our_verified_type", "reason"]
    return wrong.orderBy(*order).limit(rows).select(*order)


_OF_QUOTATION = {
    "json_file": "json_file",
    "ras_id": "meta.ras_id",
    "file_name": "meta.file_name",
    "extracted_supplier": "quotation_data.supplier_name",
    "extracted_price": "quotation_data.quoted_price",
    "currency": "quotation_data.currency",
    "our_canonical_name": "quotation_data.canonical_item_name",
}


def _quotations(docs: DataFrame, *names: str) -> DataFrame:
    """Quotations with their case id and the columns asked for; ``docs`` may lack the others."""
    return docs.where("is_quotation").select(
        *(F.col(_OF_QUOTATION[name]).alias(name) for name in ("ras_id", *names))
    )


def _items(items: DataFrame, **columns: Column | str) -> DataFrame:
    """Item rows keyed by case id as text, with the columns asked for."""
    picked = [
        (F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()
    ]
    return items.select(F.col("ras_id").cast("string").alias("ras_id"), *picked)


def price_check(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every quotation against every item row of its case.

    The report has one row per pair by definition. For totals use
    ``price_summary``, which does not build the pairs.
    """
    stored = _items(
        items,
        db_supplier="supplier",
        db_original_price="original_inr",
        db_negotiated_price="negotiated_inr",
    )
    ours = _quotations(docs, "file_name", "extracted_supplier", "extracted_price", "currency")
    pairs = ours.join(stored, "ras_id")
    return pairs.select(
        "ras_id",
        "file_name",
        "extracted_supplier",
        "db_supplier",
        supplier_match("extracted_supplier", "db_supplier").alias("supplier_match"),
        "extracted_price",
        "currency",
        "db_original_price",
        "db_negotiated_price",
        price_in_range("extracted_price", "db_original_price").alias("price_in_range"),
    )


def _weighted(rows: DataFrame, *keys: str, weight: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(weight))


def supplier_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct supplier pairs of each case, whether they match, and how often they meet.

    Both sides are counted by case and supplier before they are joined.
    """
    ours = _quotations(docs, "extracted_supplier")
    ours = _weighted(ours, "ras_id", "extracted_supplier", weight="_docs")
    stored = _weighted(
        _items(items, db_supplier="supplier"), "ras_id", "db_supplier", weight="_items"
    )
    return ours.join(stored, "ras_id").select(
        "ras_id",
        "extracted_supplier",
        "db_supplier",
        supplier_match("extracted_supplier", "db_supplier").alias("supplier_match"),
        (F.col("_docs") * F.col("_items")).alias("pairs"),
    )


def supplier_links(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Supplier pairs of a case that match, and how often they meet.

    In cases with many names they are found through an index of character sequences, so
    names that have nothing in common are not put side by side there. Both sides are
    counted by case and supplier once and stored.
    """
    ours = stored(_named(_quotations(docs, "extracted_supplier"), "extracted_supplier"), "ours")
    theirs = stored(_named(_items(items, db_supplier="supplier"), "db_supplier"), "theirs")
    few, many = _by_crowding(ours, theirs)
    links = _links_of(few, theirs)
    return links.unionByName(_links_by_index(*many)) if many else links


def _by_crowding(
    ours: DataFrame, theirs: DataFrame
) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Our rows of cases that make few pairs, and both sides of the crowded cases.

    Which cases are crowded is worked out once. Their rows are stored, as they are read many
    times; where no case is crowded there is no second part.
    """
    crowded = stored(crowded_groups(ours, theirs), "crowded")
    if crowded.isEmpty():
        return ours, None
    one, other = (
        stored(side.join(crowded, "ras_id", "left_semi"), "many") for side in (ours, theirs)
    )
    return ours.join(crowded, "ras_id", "left_anti"), (one, other)


def _named(rows: DataFrame, supplier: str) -> DataFrame:
    """Suppliers of each case that have a name, and how many rows they have."""
    return _weighted(rows.where(F.col(supplier) != ""), "ras_id", supplier, weight="_rows")


def _links_of(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Matching pairs, every pair of a case put side by side."""
    pairs = ours.withColumnRenamed("_rows", "_docs").join(theirs, "ras_id")
    return pairs.where(supplier_match("extracted_supplier", "db_supplier")).select(
        "ras_id",
        "extracted_supplier",
        "db_supplier",
        (F.col("_docs") * F.col("_rows")).alias("pairs"),
    )


def _links_by_index(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The same through the index of character sequences."""
    links = links_by_index(
        ours.select("ras_id", F.col("extracted_supplier").alias("name")),
        theirs.select("ras_id", F.col("db_supplier").alias("name")),
    ).withColumnsRenamed({"left": "extracted_supplier", "right": "db_supplier"})
    return (
        links.join(ours.withColumnRenamed("_rows", "_docs"), ["ras_id", "extracted_supplier"])
        .join(theirs, ["ras_id", "db_supplier"])
        .select(
            "ras_id",
            "extracted_supplier",
            "db_supplier",
            (F.col("_docs") * F.col("_rows")).alias("pairs"),
        )
    )


def price_summary(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row: prices in range and checked, suppliers matched and checked.

    Pairs are built only in cases where they are few, once for all four sums. In the others
    checked prices and suppliers are the product of two counts per case, prices in range are
    counted by ``hits_by_slices``, and matching suppliers are found as by ``supplier_links``.
    """
    ours = _quotations(docs, "extracted_supplier", "extracted_price")
    theirs = _items(items, original="original_inr", db_supplier="supplier")
    few, many = _by_crowding(ours, theirs)
    parts = _summed_pairs(few, theirs)
    for part in _summed_totals(*many) if many else ():
        parts = parts.unionByName(part, allowMissingColumns=True)
    names = ("price_hits", "price_checked", "supplier_checked", "supplier_hits")
    return parts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))


def _summed_pairs(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row of sums over the pairs of each case."""
    in_range = price_in_range("extracted_price", "original")
    match = supplier_match("extracted_supplier", "db_supplier")
    return ours.join(theirs, "ras_id").agg(
        F.count_if(in_range).alias("price_hits"),
        F.count(in_range).alias("price_checked"),
        F.count(match).alias("supplier_checked"),
        F.count_if(match).alias("supplier_hits"),
    )


def _summed_totals(ours: DataFrame, theirs: DataFrame) -> tuple[DataFrame, ...]:
    """The same from totals of both sides, in three rows."""
    priced = _weighted(ours, "ras_id", "extracted_price", weight="_docs")
    originals = _weighted(theirs, "ras_id", "original", weight="items")
    hits = hits_by_slices(priced.select("ras_id", "extracted_price"), originals)
    met = priced.join(hits, ["ras_id", "extracted_price"])
    counts = ours.groupBy("ras_id").agg(
        F.count_if(usable_price("extracted_price").isNotNull()).alias("_priced"),
        F.count_if(F.col("extracted_supplier") != "").alias("_named"),
    )
    held = theirs.groupBy("ras_id").agg(
        F.count_if(usable_price("original") > 0).alias("_usable"),
        F.count_if(F.col("db_supplier") != "").alias("_supplied"),
    )
    checked = counts.join(held, "ras_id").agg(
        F.sum(F.col("_priced") * F.col("_usable")).alias("price_checked"),
        F.sum(F.col("_named") * F.col("_supplied")).alias("supplier_checked"),
    )
    links = _links_by_index(_named(ours, "extracted_supplier"), _named(theirs, "db_supplier"))
    matched = links.agg(F.sum("pairs").alias("supplier_hits"))
    return met.agg(F.sum(F.col("_docs") * F.col("hits")).alias("price_hits")), checked, matched


def _our_names(docs: DataFrame) -> DataFrame:
    return _quotations(docs, "file_name", "our_canonical_name").select(
        "ras_id",
        "file_name",
        "our_canonical_name",
        name_length("our_canonical_name").alias("our_name_length"),
        has_digit("our_canonical_name").alias("our_has_specs"),
    )


def _stored_names(items: DataFrame) -> DataFrame:
    return _items(
        items,
        db_item_name="item_name",
        db_name_length=name_length("item_name"),
        db_has_specs=has_digit("item_name"),
        db_is_garbage=is_garbage("item_name"),
    )


def _grade() -> Column:
    return improvement(F.col("our_name_length"), F.col("db_name_length"), F.col("db_is_garbage"))


def name_quality(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Our item name against the stored one, for every pair of a case.

    What depends on one name only is worked out before the join, once per name.
    """
    better = is_better(
        F.col("our_name_length"),
        F.col("our_has_specs"),
        F.col("db_name_length"),
        F.col("db_is_garbage"),
    )
    pairs = _our_names(docs).join(_stored_names(items), "ras_id")
    return pairs.select(
        "ras_id",
        "file_name",
        "db_item_name",
        "db_name_length",
        "db_has_specs",
        "db_is_garbage",
        "our_canonical_name",
        "our_name_length",
        "our_has_specs",
        better.alias("our_is_better"),
        _grade().alias("improvement"),
    )


def name_summary(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs per grade.

    A grade depends on two lengths and a flag only. Both sides are counted by
    these before the join, so a case of any size joins a few short lists.
    """
    ours = _weighted(_our_names(docs), "ras_id", "our_name_length", weight="_docs")
    stored = _weighted(
        _stored_names(items), "ras_id", "db_name_length", "db_is_garbage", weight="_items"
    )
    graded = ours.join(stored, "ras_id").select(
        _grade().alias("improvement"), (F.col("_docs") * F.col("_items")).alias("pairs")
    )
    return graded.groupBy("improvement").agg(F.sum("pairs").alias("pairs"))


def document_checks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per quotation whose case has items: what its items say about it.

    ``items`` rows of the case, ``items_checked`` those whose price could be
    compared, ``hits`` those in range, ``nearest_price`` the closest original of the
    case, ``MAJOR`` to ``UNCLEAR`` how many item names get that grade, ``best_grade``
    the first of these grades that any gets. Summed up, the counts are those of
    ``price_summary`` and ``name_summary``.

    Cases whose documents and items make few pairs are joined plainly, in one pass.
    In the others no pair is built: hits and nearest prices come from the common
    order of prices, grades from the distinct name lengths of a case.
    """
    ours = _quotations(docs, "json_file", "file_name", "extracted_price", "our_canonical_name")
    ours = ours.withColumn("our_name_length", name_length("our_canonical_name"))
    ours = ours.drop("our_canonical_name")
    theirs = _items(
        items,
        original="original_inr",
        db_name_length=name_length("item_name"),
        db_is_garbage=is_garbage("item_name"),
    )
    few, many = _by_crowding(ours, theirs)
    checks = _checks_by_pairs(few, theirs)
    if many:
        checks = checks.unionByName(_checks_by_totals(*many))
    best = F.lit(None).cast("string")
    for grade in reversed(IMPROVEMENTS):
        best = F.when(F.col(grade) > 0, F.lit(grade)).otherwise(best)
    checked = F.when(usable_price("extracted_price").isNotNull(), F.col("_usable")).otherwise(0)
    return checks.select(
        "json_file",
        "ras_id",
        "file_name",
        "extracted_price",
        "items",
        checked.cast("bigint").alias("items_checked"),
        F.coalesce("hits", F.lit(0)).alias("hits"),
        "nearest_price",
        *IMPROVEMENTS,
        best.alias("best_grade"),
    )


def _checks_by_pairs(ours: DataFrame, stored: DataFrame) -> DataFrame:
    """What the items of its case say about each document, pair by pair.

    The number only keeps equal rows apart in this one pass.
    """
    kept = ["json_file", "file_name", "extracted_price", "our_name_length"]
    usable = usable_price("original") > 0
    compared = stored.withColumn("original", F.when(usable, F.col("original")))
    pairs = ours.withColumn("_row", F.monotonically_increasing_id()).join(compared, "ras_id")
    last, following = neighbours("extracted_price", "original")
    summed = pairs.withColumn("_grade", _grade()).groupBy("ras_id", "_row", *kept).agg(
        F.count("*").alias("items"),
        F.count("original").alias("_usable"),
        F.count_if(price_in_range("extracted_price", "original")).alias("hits"),
        last.alias("_last"),
        following.alias("_next"),
        *(F.count_if(F.col("_grade") == grade).alias(grade) for grade in IMPROVEMENTS),
    )
    nearest = F.when(usable_price("extracted_price") > 0, closest("extracted_price"))
    return summed.withColumn("nearest_price", nearest).drop("_row", "_last", "_next")


def _checks_by_totals(ours: DataFrame, stored: DataFrame) -> DataFrame:
    """The same from totals of both sides."""
    per_case = stored.groupBy("ras_id").agg(
        F.count("*").alias("items"), F.count_if(usable_price("original") > 0).alias("_usable")
    )
    prices = (
        ours.select("ras_id", "extracted_price")
        .where(usable_price("extracted_price") > 0)
        .distinct()
    )
    originals = _weighted(
        stored.where(usable_price("original") > 0), "ras_id", "original", weight="items"
    )
    grades = (
        ours.select("ras_id", "our_name_length")
        .distinct()
        .join(
            _weighted(stored, "ras_id", "db_name_length", "db_is_garbage", weight="_items"),
            "ras_id",
        )
        .withColumn("_grade", _grade())
        .groupBy("ras_id", "our_name_length")
        .agg(
            *(
                F.coalesce(F.sum(F.when(F.col("_grade") == g, F.col("_items"))), F.lit(0)).alias(g)
                for g in IMPROVEMENTS
            )
        )
    )
    on_price = ["ras_id", "extracted_price"]
    nearest = nearest_by_slices(prices, originals.select("ras_id", "original"))
    return (
        ours.join(per_case, "ras_id")
        .join(hits_by_slices(prices, originals), on_price, "left")
        .join(nearest.withColumnRenamed("nearest", "nearest_price"), on_price, "left")
        .join(grades, ["ras_id", "our_name_length"])
    )


def improvement_examples(docs: DataFrame, items: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """The first pairs graded MAJOR, by case, file and names.

    A MAJOR pair is a useless stored name met by any name of ours. The first
    ``rows`` of them lie in the first ``rows`` cases that have both, among the
    first ``rows`` names of each side there: every earlier name of one side
    would make an earlier pair. Only these are joined.
    """
    ours = _our_names(docs).where(F.col("our_name_length") > 0)
    useless = _stored_names(items).where("db_is_garbage")
    cases = (
        ours.select("ras_id")
        .distinct()
        .join(useless.select("ras_id").distinct(), "ras_id", "left_semi")
        .orderBy("ras_id")
        .limit(rows)
    )

    def first_of_case(side: DataFrame, *order: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("ras_id").orderBy(*order))
        chosen = side.join(cases, "ras_id", "left_semi")
        return chosen.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")

    pairs = first_of_case(ours, "file_name", "our_canonical_name").join(
        first_of_case(useless, "db_item_name"), "ras_id"
    )
    order = ["ras_id", "file_name", "db_item_name", "our_canonical_name"]
    return pairs.select(*order).orderBy(*order).limit(rows)
