from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from attestry import build_manifest, profile_inventory, select_cases
from attestry.operators import inventory, numbering, resolve, sampling, sheets

MIB = 2**20


# ---- inventory ----


@pytest.fixture
def objects(spark):
    rows = [
        ("R_10_2025/a.pdf", 1280),
        ("R_10_2025/b.PDF", MIB),
        ("R_10_2025/c", 5 * MIB),
        ("R_1_2024/a.xlsx", 100 * MIB),
        ("R_1_2024/b.png", 10),
        ("R_2_2024/z.png", 20),
        ("misc/x.txt", 7),
        ("R_3_24/y.txt", 8),
    ]
    return spark.createDataFrame(rows, "name string, size bigint")


def test_extensions_of_a_case_in_chunks(spark):
    names = [f"R_1_2025/f.{'é' * (i % 3)}x{i}" for i in range(3000)] + ["R_1_2025/plain", "R_2_2025/b.PDF", "none/x.y"]
    frame = spark.createDataFrame([(n, 1) for n in names + names[:9]], "name string, size bigint")
    chunks = inventory.case_file_types(frame, chunk_chars=50).collect()
    texts = {}
    for row in sorted(chunks, key=lambda r: r["chunk_no"]):
        assert len(row["text"]) <= 50
        texts[row["ras_id"]] = texts.get(row["ras_id"], "") + row["text"]
    assert texts == {r["ras_id"]: r["file_types"] for r in inventory.case_coverage(frame).collect()}


def test_summary(objects):
    row = inventory.inventory_summary(objects).first()
    assert (row["total_files"], row["distinct_cases"]) == (8, 3)
    assert row["total_bytes"] == 1280 + 106 * MIB + 45 and row["total_size"] == "106.0 MB"


def test_file_types(objects):
    rows = [tuple(r)[:2] + (r["pct"],) for r in inventory.top_file_types(objects).collect()]
    # Of equal counts the extension listed first comes first.
    assert rows == [
        (".pdf", 2, 25.0),
        (".png", 2, 25.0),
        (".txt", 2, 25.0),
        ("(no extension)", 1, 12.5),
        (".xlsx", 1, 12.5),
    ]
    top = inventory.top_file_types(objects, top=1).first()
    assert (top["total_size"], top["avg_size"]) == ("1.0 MB", "512.6 KB")


def test_buckets_keep_empty_ones(objects):
    rows = inventory.size_distribution(objects).orderBy("position").collect()
    assert [(r["bucket"], r["num_files"]) for r in rows] == [
        ("< 1 MB", 5),
        ("1-10 MB", 2),
        ("10-50 MB", 0),
        ("50-100 MB", 0),
        ("> 100 MB", 1),
    ]
    assert sum(r["num_files"] for r in rows) == objects.count()


def test_coverage_order_is_listing_order(objects):
    every = {r["ras_id"] for r in inventory.case_coverage(objects).collect()}
    rows = inventory.case_coverage(objects, top=10).collect()
    assert every == {r["ras_id"] for r in rows}
    assert [(r["ras_id"], r["num_files"], r["file_types"]) for r in rows] == [
        ("10", 3, "(no extension), .pdf"),
        ("1", 2, ".png, .xlsx"),
        ("2", 1, ".png"),
    ]
    tied = objects.where("name like 'R_1%b%' or name like 'R_10%c' or name like 'R_2_%'")
    assert [r["ras_id"] for r in inventory.case_coverage(tied, top=2).collect()] == ["10", "1"]


@pytest.mark.parametrize(
    ("counts", "median"), [([1, 2, 3], 2), ([1, 2, 3, 4], 3), ([5], 5), ([1, 1, 4, 4], 4)]
)
def test_median_is_the_upper_one(spark, counts, median):
    names = [(f"R_{c}_2025/{i}", 1) for c, n in enumerate(counts) for i in range(n)]
    row = inventory.files_per_case(spark.createDataFrame(names, "name string, size bigint")).first()
    assert row["median_files"] == median == sorted(counts)[len(counts) // 2]
    assert (row["min_files"], row["max_files"]) == (min(counts), max(counts))
    assert row["avg_files"] == round(sum(counts) / len(counts), 1)


def test_profile_of_an_empty_container(spark):
    empty = spark.createDataFrame([], "name string, size bigint")
    tables = profile_inventory(empty)
    assert tables["summary"].first()["total_files"] == 0
    assert [r["pct"] for r in tables["size_distribution"].collect()] == [0.0] * 5
    assert tables["file_types"].count() == tables["case_coverage"].count() == 0


# ---- sampling ----


def _attachments(spark, rows):
    schema = "ras_id bigint, att_id bigint, file_name string, file_location string, att_type string, supplier_id bigint, uploaded_on timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def test_select_cases(spark):
    now = datetime(2024, 8, 31)
    edge = datetime(2024, 2, 29)
    rows = []
    for case, types, suppliers, when in [
        (1, ["PO", None, "BER"], [1, 2, None], now),
        (2, ["PO", "PO", "PO"], [1, 2, 3], edge),
        (3, ["PO", "PO", "PO"], [1, 2, 3], datetime(2024, 2, 28)),
        (4, ["PO", "PO"], [1, 2], now),
        (5, ["PO", "PO", "PO"], [1, 1, None], now),
        (6, ["PO", "PO", "PO", "PO"], [1, 2, 2, 2], now),
    ]:
        rows += [(case, case * 10 + i, "f", None, t, s, when) for i, (t, s) in enumerate(zip(types, suppliers))]
    found = select_cases(_attachments(spark, rows), now)
    kept = {r["ras_id"]: r for r in found.collect()}
    assert set(kept) == {1, 2, 6}
    assert kept[1]["doc_types"] == "BER, NULL, PO" and kept[1]["num_doc_types"] == 2
    assert (kept[2]["num_suppliers"], kept[2]["num_attachments"]) == (3, 3)
    ranked = [r["ras_id"] for r in sampling.pick_sample(found, 3).collect()]
    assert ranked == [2, 6, 1]
    assert {r["ras_id"] for r in select_cases(_attachments(spark, rows), now, min_doc_types=2).collect()} == {1}
    assert [r["ras_id"] for r in select_cases(_attachments(spark, rows), now, top=1).collect()] == [2]


# ---- resolution ----


@pytest.fixture
def stored(spark):
    when = datetime(2024, 1, 1)
    attachments = _attachments(
        spark,
        [
            (1, 11, "a.pdf", "/box/R_1_2025/a.pdf", "PO", 5, when),
            (1, 12, "gone.pdf", "R_1_2025/gone.pdf", None, None, when),
            (1, 13, None, "R_1_2025/c.pdf", "PO", 5, when),
            (1, 14, "", "R_1_2025/c.pdf", "PO", 5, when),
            (1, 15, "blank.pdf", "  ", "PO", 5, when),
            (2, 21, "x.pdf", "elsewhere/x.pdf", "PO", 5, when),
            (2, 22, None, "R_2_2025/y.pdf", "PO", 5, when),
            (3, 31, "n.pdf", None, "PO", 5, when),
            (4, 41, "q.pdf", "R_4_2025/q.pdf", "PO", 5, when),
            (4, 42, "copy of q.pdf", "R_4_2025/q.pdf", "PO", 5, when),
        ],
    )
    names = ["R_1_2025/a.pdf", "R_1_2025/c.pdf", "R_2_2025/y.pdf", "R_2_x/z/w.png", "R_2_2025/", "R_22_2025/k.pdf"]
    names += ["R_02_2025/k.pdf", "R_4_2025/q.pdf", "R_4_2025/r.pdf", "other/R_3_2025/n.pdf"]
    objects = spark.createDataFrame([(n, len(n)) for n in names], "name string, size bigint")
    return attachments, objects


def test_manifest(stored):
    attachments, objects = stored
    cases = attachments.select("ras_id").distinct()
    manifest, unresolved = build_manifest(attachments, objects, cases, "box")
    rows = {(r["ras_id"], r["file_name"], r["blob_path"], r["att_type"]) for r in manifest.collect()}
    # Case 2 has no direct hit: its null name does not count, so it is searched by prefix.
    assert rows == {
        (1, "a.pdf", "R_1_2025/a.pdf", "PO"),
        (2, "y.pdf", "R_2_2025/y.pdf", "unknown"),
        (2, "w.png", "R_2_x/z/w.png", "unknown"),
        (4, "q.pdf", "R_4_2025/q.pdf", "PO"),
        (4, "copy of q.pdf", "R_4_2025/q.pdf", "PO"),
    }
    reasons = {r["att_id"]: r["reason"] for r in unresolved.collect()}
    assert reasons == {
        12: "object_not_found",
        13: "null_file_name",
        14: "empty_file_name",
        15: "blank_location",
        21: "object_not_found",
        22: "null_file_name",
        31: "blank_location",
    }


def test_a_manifest_reads_the_objects_twice_at_most(spark, stored, tmp_path):
    attachments, objects = stored
    path = str(tmp_path / "objects")
    objects.write.parquet(path)
    read = []
    from attestry.operators import storage
    from attestry.plans import jobs

    def counting(frame, label):
        read.append(frame._jdf.queryExecution().executedPlan().toString())
        return storage.stored(frame, label)

    kept, jobs.stored = jobs.stored, counting
    try:
        cases = attachments.select("ras_id").distinct()
        manifest, unresolved = build_manifest(attachments, spark.read.parquet(path), cases, "box")
    finally:
        jobs.stored = kept
    read += [f._jdf.queryExecution().executedPlan().toString() for f in (manifest, unresolved)]
    scans = [s for plan in read for s in re.findall(r"FileScan parquet \[name#\d+,size#\d+L\]", plan)]
    assert len(scans) == 2
    assert manifest.count() == 5 and unresolved.count() == 7


def test_every_attachment_is_resolved_or_not(spark, sf_dir):
    from attestry.catalog import fixtures as fx

    attachments, objects = fx.located(spark, sf_dir), fx.objects(spark, sf_dir)
    direct = resolve.resolve_direct(attachments, objects, fx.CONTAINER)
    failed = resolve.unresolved(attachments, objects, fx.CONTAINER)
    assert direct.count() + failed.count() == attachments.count()
    assert direct.join(failed, "att_id", "left_semi").count() == 0
    fallback = resolve.resolve_fallback(attachments.select("ras_id").distinct(), direct, objects)
    assert fallback.join(direct, "ras_id", "left_semi").count() == 0


def test_mark_missing(stored):
    attachments, objects = stored
    located = resolve.normalise_locations(attachments, "box").where("blob_path is not null")
    marked = {r["att_id"]: r["found"] for r in resolve.mark_missing(located, objects).collect()}
    assert marked[11] and not marked[12] and len(marked) == 8


# ---- sheets ----


SHEET_ROWS = "file string, sheet_no int, sheet string, row_no int, row_text string"


def test_sheet_text_is_bounded_and_ordered(spark):
    rows = [("w", s, f"s{s}", r, f"c{s}-{r}") for s in range(1, 8) for r in range(150, 0, -1) if s != 2]
    frame = spark.createDataFrame(rows, SHEET_ROWS)
    chunks = sheets.sheet_chunks(frame, max_sheets=5, max_rows=100)
    sizes = sheets.sheet_sizes(frame, max_sheets=5, max_rows=100).first()
    text = sheets.workbook_text(chunks).first()["text"]
    parts = text.split("\n\n")
    assert sizes["num_sheets"] == 4 and sizes["num_rows"] == 400 and sizes["num_chars"] == len(text)
    assert parts[0::2] == [f"=== Sheet: s{s} ===" for s in (1, 3, 4, 5)]
    assert parts[1].split("\n") == [f"c1-{r}" for r in range(1, 101)]
    small = sheets.sheet_chunks(frame, 5, 100, chunk_chars=32)
    assert sheets.workbook_text(small).first()["text"] == text
    assert sheets.workbook_text(small, max_chars=90, chunk_chars=32).first()["text"] == text[:90]


@pytest.mark.parametrize("chunk_chars", [1, 7, 100, 10**6])
def test_chunks_are_full_and_join_to_the_text(spark, chunk_chars):
    rows = [("w", 1, "a", 5, None), ("w", 1, "a", -3, "first"), ("w", 1, "a", 9000, "é" * 250), ("w", 1, "a", 7, "")]
    rows += [("w", 2, None, 1, "x\ny"), (None, 1, "a", 1, "z"), ("v", 3, "a", 1, "1"), ("v", 3, "a", 1, "0")]
    chunks = sheets.sheet_chunks(spark.createDataFrame(rows, SHEET_ROWS), chunk_chars=chunk_chars).collect()
    texts = {}
    for row in sorted(chunks, key=lambda r: r["chunk_no"]):
        texts.setdefault((row["file"], row["sheet_no"], row["sheet"]), []).append(row["text"])
    for parts in texts.values():
        assert all(len(p) == chunk_chars for p in parts[:-1]) and 0 < len(parts[-1]) <= chunk_chars
    assert {k: "".join(v) for k, v in texts.items()} == {
        ("w", 1, "a"): "=== Sheet: a ===\n\nfirst\n\n\n" + "é" * 250,
        ("w", 2, ""): "=== Sheet:  ===\n\nx\ny",
        ("", 1, "a"): "=== Sheet: a ===\n\nz",
        ("v", 3, "a"): "=== Sheet: a ===\n\n0\n1",
    }


def test_a_hot_sheet_comes_out_whole_in_bounded_parts(spark):
    hot = spark.range(30_000).selectExpr(
        "'w' as file", "1 as sheet_no", "'s' as sheet", "cast(id as int) as row_no", "'c' || id as row_text"
    )
    others = spark.range(50).selectExpr(
        "'w' as file", "cast(id + 2 as int) as sheet_no", "'t' as sheet", "1 as row_no", "'x' as row_text"
    )
    chunks = sheets.sheet_chunks(hot.unionByName(others), chunk_chars=1000)
    found = chunks.where("sheet_no = 1").orderBy("chunk_no").collect()
    assert [r["chunk_no"] for r in found] == list(range(len(found)))
    assert "".join(r["text"] for r in found) == "=== Sheet: s ===\n\n" + "\n".join(f"c{i}" for i in range(30_000))
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def _pandas_lines(rows, max_chars):
    """Lines of one sheet as pandas prints them; ``rows`` maps (row, column) to a cell."""
    import numpy as np
    import pandas as pd

    last = max(c for _, c in rows)
    numbers = sorted({r for r, _ in rows if r > 1})
    names = [rows.get((1, c)) or f"Unnamed: {c - 1}" for c in range(1, last + 1)]
    data = [[rows.get((r, c), np.nan) for c in range(1, last + 1)] for r in numbers]
    frame = pd.DataFrame(data, columns=names, dtype=object)
    text = frame.to_string(index=False, max_colwidth=max_chars)
    return dict(zip([1, *numbers], text.split("\n")))


@pytest.mark.parametrize("max_chars", [None, 12])
def test_row_texts_equal_a_printed_frame(spark, max_chars):
    import random

    draw = random.Random(4)
    sheets_given = {}
    for number in range(1, 7):
        cells = {(1, c): f"name {c}" for c in range(1, 6) if draw.random() < 0.8}
        for r in draw.sample(range(2, 500), 12):
            for c in range(1, 7):
                if draw.random() < 0.7:
                    cells[(r, c)] = draw.choice(["a", "é\tb", "line\nbreak", "x" * draw.randint(1, 30), "1.5", " "])
        sheets_given[number] = cells
    sheets_given[7] = {(1, 1): "only a header"}
    sheets_given[8] = {(2, 3): "no header"}
    rows = [("f", n, f"s{n}", r, c, v) for n, cells in sheets_given.items() for (r, c), v in cells.items()]
    rows += [("f", 8, "s8", 2, 9, None), ("f", 8, "s8", 0, 1, "above the header")]
    frame = spark.createDataFrame(rows, "file string, sheet_no int, sheet string, row_no int, col_no int, cell string")
    found = {}
    for row in sheets.row_texts(frame, max_chars).collect():
        found.setdefault(row["sheet_no"], {})[row["row_no"]] = row["row_text"]
    assert found == {n: _pandas_lines(cells, max_chars) for n, cells in sheets_given.items() if n != 7}


def test_cells_are_cut_on_request(evaluate):
    assert evaluate([("x" * 60,)], "x string", sheets.bound_cell("x")) == ["x" * 60]
    assert evaluate([("x" * 60,)], "x string", sheets.bound_cell("x", 50)) == ["x" * 50]


# ---- numbering ----


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_numbering_equals_a_plain_window(spark, hot_rows):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).alias("key"),
        F.when(F.col("id") % 17 != 0, F.col("id") % 40).alias("lead"),
        F.xxhash64("id").alias("rest"),
    )
    plain = F.row_number().over(Window.partitionBy("key").orderBy("lead", "rest"))
    expected = rows.withColumn("rn", plain.cast("bigint"))
    actual = numbering.number_within(rows, "key", ["lead", "rest"], hot_rows=hot_rows)
    assert actual.columns == expected.columns
    assert actual.exceptAll(expected).count() == 0 and expected.exceptAll(actual).count() == 0


def test_hot_groups_are_bounded(spark):
    rows = spark.range(20_000).select((F.col("id") % 10_000).alias("key"))
    assert numbering.hot_groups(rows, "key", 1).count() == numbering.MAX_HOT


def test_numbered_attachments_have_their_place_in_the_case(spark, sf_dir):
    from attestry.catalog import fixtures as fx

    with fx.numbered(True):
        rows = fx.attachments(spark, sf_dir).select("ras_id", "att_id", "rn").collect()
    places = {}
    for case, att_id, place in rows:
        assert att_id == case * 100 + place
        places.setdefault(case, []).append(place)
    assert all(sorted(found) == list(range(1, len(found) + 1)) for found in places.values())
    assert "rn" in fx.attachments(spark, sf_dir).columns
