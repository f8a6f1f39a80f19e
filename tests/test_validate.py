from __future__ import annotations

import itertools
import random

import pytest

from attestry import validate_documents
from attestry.operators import validate
from attestry.schemas import DOC, ITEM


def _doc(case, name, supplier, price, item, quotation=True, matches=True):
    label = (None, "high", "PO", matches, "because")
    offer = (supplier, item, None, None, price, "INR") + (None,) * 8 if quotation else None
    meta = (case, name, ".pdf", "PO", 1, None)
    return (label, quotation, offer, None, None, meta, f"{case}_{name}.json")


@pytest.fixture(scope="module")
def reports(spark):
    """Random documents and items with every kind of gap."""
    rng = random.Random(3)
    docs = [
        _doc(
            str(rng.randrange(6)),
            f"f{i}",
            rng.choice([None, "", "Acme", "acme ltd", "Other"]),
            rng.choice([None, 0.0, 100.0, 119.9, 120.0, 80.0, 81.0, 1.2, 125.0, 1e6]),
            rng.choice([None, "", "Pump", "Pump 3000 with motor", "X" * 30 + "1"]),
            quotation=rng.random() < 0.8,
            matches=rng.choice([True, False, None]),
        )
        for i in range(120)
    ]
    items = [
        (
            rng.randrange(8),
            rng.choice([None, " ", "As per attached", "Pump", "Motor 12345 long name"]),
            "c",
            "s",
            rng.choice([None, "", "ACME", "Foo"]),
            rng.choice([None, 0.0, 100.0, 1.0, -5.0, 104.0, 99.99]),
            90.0,
        )
        for _ in range(60)
    ]
    return spark.createDataFrame(docs, DOC).cache(), spark.createDataFrame(items, ITEM).cache()


def test_pairs_are_all_of_them(reports):
    docs, items = reports
    quotations = docs.where("is_quotation").groupBy("meta.ras_id").count().collect()
    stored = {str(r["ras_id"]): r["count"] for r in items.groupBy("ras_id").count().collect()}
    expected = sum(r["count"] * stored.get(r["ras_id"], 0) for r in quotations)
    assert validate.price_check(docs, items).count() == expected
    assert validate.name_quality(docs, items).count() == expected


def test_price_summary_equals_the_pairs(reports):
    docs, items = reports
    pairs = validate.price_check(docs, items).collect()
    row = validate.price_summary(docs, items).first()
    assert row["price_hits"] == sum(p["price_in_range"] is True for p in pairs) > 0
    assert row["price_checked"] == sum(p["price_in_range"] is not None for p in pairs)
    assert row["supplier_hits"] == sum(p["supplier_match"] is True for p in pairs) > 0
    assert row["supplier_checked"] == sum(p["supplier_match"] is not None for p in pairs)
    assert row["price_checked"] >= row["price_hits"]


def test_name_summary_equals_the_pairs(reports):
    docs, items = reports
    pairs = validate.name_quality(docs, items).groupBy("improvement").count().collect()
    totals = validate.name_summary(docs, items).collect()
    assert {tuple(r) for r in totals} == {tuple(r) for r in pairs}


@pytest.mark.parametrize("rows", [1, 3, 10])
def test_examples_are_the_first_pairs(reports, rows):
    docs, items = reports
    order = ["ras_id", "file_name", "db_item_name", "our_canonical_name"]
    pairs = validate.name_quality(docs, items).where("improvement = 'MAJOR'")
    expected = [tuple(r) for r in pairs.select(*order).orderBy(*order).limit(rows).collect()]
    actual = [tuple(r) for r in validate.improvement_examples(docs, items, rows).collect()]
    assert actual == expected and len(actual) == rows


def test_label_counts(reports):
    docs, _ = reports
    row = validate.classification_counts(validate.doc_classification(docs)).first()
    assert row["documents"] == 120 == row["matches"] + row["mismatches"] + row["not_judged"]
    wrong = validate.mismatch_examples(validate.doc_classification(docs)).collect()
    assert len(wrong) == 3 and [r["ras_id"] for r in wrong] == sorted(r["ras_id"] for r in wrong)


def test_keys_are_compared_as_text(spark):
    docs = spark.createDataFrame([_doc("007", "a", "S", 1.0, "n"), _doc("7", "b", "S", 1.0, "n")], DOC)
    items = spark.createDataFrame([(7, "n", "c", "s", "S", 1.0, 1.0)], ITEM)
    assert [r["file_name"] for r in validate.price_check(docs, items).collect()] == ["b"]


def test_missing_offer_is_not_an_error(spark):
    label, _, _, extra, summary, meta, file = _doc("1", "a", "S", 1.0, "n")
    docs = spark.createDataFrame([(label, True, None, extra, summary, meta, file)], DOC)
    items = spark.createDataFrame([(1, "refer me", "c", "s", "S", 1.0, 1.0)], ITEM)
    price = validate.price_check(docs, items).first()
    assert price["price_in_range"] is None and price["supplier_match"] is None
    name = validate.name_quality(docs, items).first()
    assert name["our_is_better"] is True and name["improvement"] == "SAME"


def test_report_tables(reports):
    docs, items = reports
    tables = validate_documents(docs, items)
    assert {"doc_classification", "price_validation", "item_name_quality"} <= set(tables)
    assert tables["price_validation"].count() == validate.price_check(docs, items).count()


def test_rows_of_documents(reports):
    docs, items = reports
    cases = {r["ras_id"] for r in validate.document_cases(docs).collect()}
    kept = {r["ras_id"] for r in validate.rows_of_documents(items, docs).collect()}
    assert kept == {r["ras_id"] for r in items.collect() if str(r["ras_id"]) in cases}


def test_price_hits_at_the_edges(spark):
    """Counting by ranges must agree with the float rule right at its bounds."""
    import math

    rng = random.Random(5)
    stored = [1.0, 3.0, 0.1, 7.7, 99.99, 1234.56, 1e9 + 0.01] + [rng.uniform(0.01, 1e6) for _ in range(60)]
    ours = []
    for o in stored:
        for edge in (o * 1.2, o * 0.8):
            ours += [edge, math.nextafter(edge, 0), math.nextafter(edge, math.inf), round(edge, 2)]
    docs = spark.createDataFrame([_doc("1", f"f{i}", "S", p, "n") for i, p in enumerate(ours)], DOC)
    items = spark.createDataFrame([(1, "n", "c", "s", "S", o, 1.0) for o in stored], ITEM)
    expected = sum(abs(e - o) / o < 0.2 for e, o in itertools.product(ours, stored))
    assert validate.price_summary(docs, items).first()["price_hits"] == expected


def test_odd_prices_do_not_end_the_summary(spark):
    from attestry.operators.ranges import pairs_in_range

    prices = [1e308, 1.2e308, float("inf"), float("nan"), 1e-320, 5.0, -3.0]
    sides = [spark.createDataFrame([(1, p, 1) for p in prices], f"ras_id int, {name} double, {n} bigint") for name, n in (("extracted_price", "docs"), ("original", "items"))]
    assert pairs_in_range(*sides).first()["hits"] == 6


# ---- orders, slices, names ----


def _prices(rng, count, cases):
    near = [100.0, 120.0, 125.0, 80.0, 100.0 / 1.2, 100.0 / 0.8, 5e-324, 1e308, 83.33333333333334]
    return [
        (str(rng.randrange(cases)), rng.choice([rng.uniform(50, 200), rng.choice(near), rng.lognormvariate(3, 5)]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("slice_rows", [1, 7, 10**6])
def test_hits_and_nearest_prices_equal_the_pairs(spark, slice_rows):
    from attestry.operators import ranges

    rng = random.Random(9)
    ours = sorted({*_prices(rng, 300, 4), ("0", -3.0), ("1", 0.0), ("9", 5.0)})
    stored = {}
    for case, price in [*_prices(rng, 400, 5), ("0", -1.0), ("1", 0.0)]:
        stored[case, price] = stored.get((case, price), 0) + rng.randrange(1, 4)
    left = spark.createDataFrame(ours, "ras_id string, extracted_price double")
    right = spark.createDataFrame([(*k, n) for k, n in stored.items()], "ras_id string, original double, items bigint")
    hits = {(r[0], r[1]): r[2] for r in ranges.hits_by_price(left, right, slice_rows).collect()}
    nearest = {(r[0], r[1]): r[2] for r in ranges.nearest_prices(left, right.drop("items"), slice_rows).collect()}
    for case, price in ours:
        usable = [(p, n) for (c, p), n in stored.items() if c == case and p > 0]
        expected = sum(n for p, n in usable if price != 0 and abs(price - p) / p < 0.2)
        assert hits.get((case, price), 0) == expected, (case, price)
        closest = min(((abs(p - price), p) for p, _ in usable), default=(None, None))[1] if price > 0 else None
        assert nearest.get((case, price)) == closest, (case, price)


def test_close_prices_of_one_case_are_spread_over_slices(spark):
    from pyspark.sql import functions as F

    from attestry.operators import ranges

    hot = spark.range(100_000).select(F.lit("hot").alias("ras_id"), (100 + F.col("id") / 100_000).alias("at"))
    small = spark.range(500).select((F.col("id") % 100).cast("string").alias("ras_id"), (F.col("id") + 1.0).alias("at"))
    sliced = ranges.with_slices(hot.unionByName(small), 1_000)
    sizes = sliced.groupBy("ras_id", "slice").agg(F.count("*").alias("n"), F.min("at").alias("a"), F.max("at").alias("b"))
    found = sizes.where("ras_id = 'hot'").orderBy("slice").collect()
    # A slice holds its rows and at most one cell more: a millionth of the price, here some ten rows.
    assert max(r["n"] for r in found) <= 1_020 and sum(r["n"] for r in found) == 100_000 and len(found) >= 99
    assert all(x["b"] < y["a"] for x, y in zip(found, found[1:]))
    assert {r["slice"] for r in sizes.where("ras_id <> 'hot'").collect()} == {0}


def test_containment_links_equal_the_pairs(spark):
    from pyspark.sql import functions as F

    from attestry.operators.containment import containment_links

    rng = random.Random(6)
    words = ["Acme", "ACME", "ltd", "é", "É", "a", "b", "ab", "Supplier#00001", "Supplier#0000", "x.y", "%", "_", " "]
    name = lambda: "".join(rng.choice(words) for _ in range(rng.randint(0, 4))) or rng.choice([None, ""])
    left = sorted({(rng.randrange(3), name()) for _ in range(150)}, key=str)
    right = sorted({(rng.randrange(4), name()) for _ in range(150)}, key=str)
    frames = [spark.createDataFrame(rows, "ras_id int, name string") for rows in (left, right)]
    found = sorted(map(tuple, containment_links(*frames).collect()))
    lower = {
        n: low
        for n, low in frames[0].unionByName(frames[1]).where("name <> ''").distinct().select("name", F.lower("name")).collect()
    }
    expected = sorted(
        (c, a, b)
        for (c, a), (d, b) in itertools.product(left, right)
        if c == d and a and b and (lower[a] in lower[b] or lower[b] in lower[a])
    )
    assert found == expected


def test_a_case_with_many_names_meets_few_of_them(spark):
    from pyspark.sql import functions as F

    from attestry.operators import containment

    names = spark.range(20_000).select(F.lit(1).alias("ras_id"), F.format_string("Supplier#%09d", F.col("id") * 49).alias("name"))
    long = names.withColumn("name", F.concat(F.lower("name"), F.lit(" LTD")))
    links = containment.containment_links(names, long)
    assert links.count() == 20_000
    inner = containment._names(names, "ras_id")
    outer = containment._names(long, "ras_id")
    met = containment._inside(inner, outer, "ras_id", containment.GRAM)
    plan = met._jdf.queryExecution().analyzed().toString()
    assert "Cartesian" not in plan and "Cross" not in plan
    met.collect()


def test_document_checks_sum_up_to_the_totals(reports):
    from pyspark.sql import functions as F

    docs, items = reports
    checks = validate.document_checks(docs, items)
    totals = checks.agg(F.sum("hits"), F.sum("items_checked"), *(F.sum(g) for g in ("MAJOR", "MINOR", "SAME", "UNCLEAR"))).first()
    summary = validate.price_summary(docs, items).first()
    grades = {r["improvement"]: r["pairs"] for r in validate.name_summary(docs, items).collect()}
    assert (totals[0], totals[1]) == (summary["price_hits"], summary["price_checked"])
    assert [totals[2 + i] for i in range(4)] == [grades.get(g, 0) for g in ("MAJOR", "MINOR", "SAME", "UNCLEAR")]
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert "NestedLoop" not in plan and checks.count() == checks.select("json_file").distinct().count()


# ---- cases that make few pairs, and the others ----


def _sides(spark, rng):
    """Cases of one to forty prices a side, and names of all lengths."""
    sizes = [rng.choice([1, 2, 3, 40]) for _ in range(12)]
    ours = {(str(c), price) for c, n in enumerate(sizes) for _, price in _prices(rng, n, 1)}
    stored = {(str(c), price): rng.randrange(1, 4) for c, n in enumerate(sizes) for _, price in _prices(rng, 41 - n, 1)}
    left = spark.createDataFrame(sorted(ours), "ras_id string, extracted_price double")
    right = spark.createDataFrame([(*k, n) for k, n in stored.items()], "ras_id string, original double, items bigint")
    return left, right


def test_crowded_groups_are_those_with_many_pairs(spark):
    from attestry.operators.crowded import crowded_groups

    sizes = {"few": (2, 3), "one": (1, 500), "many": (40, 40), "left": (50, 0)}
    rows = [[(c,) for c, n in sizes.items() for _ in range(n[side])] for side in (0, 1)]
    left, right = (spark.createDataFrame([*r, (None,)], "ras_id string") for r in rows)
    assert [r[0] for r in crowded_groups(left, right).collect()] == ["many"]
    found = crowded_groups(left, right, pairs_per_group=400).collect()
    assert sorted(r[0] for r in found) == ["many", "one"]


def test_names_of_small_cases_are_not_indexed(spark):
    """The index holds some sixty rows per name; small cases bring none into it."""
    from attestry.operators import containment, crowded

    names = spark.range(3_000).selectExpr("id div 3 as ras_id", "'Supplier#' || id % 50 as name")
    ours, theirs = (containment._names(side, "ras_id") for side in (names, names))
    assert crowded.crowded_groups(ours, theirs).count() == 0
    by_index = containment._links_by_index(ours, theirs, "ras_id", containment.GRAM).collect()
    assert sorted(containment.containment_links(names, names).collect()) == sorted(by_index)


def test_pairs_and_slices_find_the_same(spark):
    from attestry.operators import ranges

    left, right = _sides(spark, random.Random(12))
    both = lambda found: {(r[0], r[1]): r[2] for r in found.collect() if r[2]}
    assert both(ranges.hits_by_price(left, right)) == both(ranges.hits_by_slices(*_usable(left, right)))
    right = right.drop("items")
    assert both(ranges.nearest_prices(left, right)) == both(ranges.nearest_by_slices(*_usable(left, right)))


def _usable(left, right):
    return left.where("extracted_price > 0"), right.where("original > 0")


def test_document_checks_are_the_same_by_pairs_and_by_totals(reports, monkeypatch):
    """Also for documents that come twice."""
    from attestry.operators import crowded, validate as v

    docs, items = reports
    docs = docs.unionByName(docs.limit(7))
    ways = []
    for per_row in (0, 10**6):
        monkeypatch.setattr(v, "crowded_groups", lambda a, b, n=per_row: crowded.crowded_groups(a, b, "ras_id", n, n))
        ways.append(sorted(map(str, v.document_checks(docs, items).collect())))
    assert ways[0] == ways[1] and len(ways[0]) > 80
