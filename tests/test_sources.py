from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from attestry import attach_contents
from attestry.schemas import ATTACHMENT, ITEM, MANIFEST
from attestry.sources import files, objects, tables, writers


@pytest.fixture
def container(tmp_path):
    root = tmp_path / "box"
    (root / "R_1_2025").mkdir(parents=True)
    (root / "R_1_2025" / "a.pdf").write_bytes(b"%PDF" * 10)
    (root / "R_1_2025" / "b c.png").write_bytes(b"\x89PNG")
    (root / "R_12_2025").mkdir()
    (root / "R_12_2025" / "x.txt").write_bytes(b"x")
    return root


def test_listing_reads_no_content(spark, container):
    listed = objects.list_objects(spark, str(container))
    assert {tuple(r) for r in listed.collect()} == {
        ("R_1_2025/a.pdf", 40),
        ("R_1_2025/b c.png", 4),
        ("R_12_2025/x.txt", 1),
    }
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    assert objects.list_objects(spark, str(container), prefix="R_1_").count() == 2


def test_read_objects(spark, container):
    rows = {r["name"]: bytes(r["content"]) for r in objects.read_objects(spark, str(container)).collect()}
    assert rows["R_1_2025/a.pdf"] == b"%PDF" * 10 and rows["R_12_2025/x.txt"] == b"x"


@pytest.mark.parametrize("batch_bytes", [1, 10**6])
def test_fetch_contents(spark, container, batch_bytes):
    wanted = ["R_1_2025/a.pdf", "R_1_2025/none.pdf", "R_1_2025/b c.png", "R_12_2025/x.txt"]
    manifest = spark.createDataFrame([(i, p) for i, p in enumerate(wanted)], "i int, blob_path string").coalesce(1)
    with pytest.raises(ValueError, match="scheme"):
        objects.fetch_contents(manifest, str(container))
    fetched = objects.fetch_contents(manifest, f"file://{container}", batch_bytes)
    rows = fetched.orderBy("i").collect()
    assert [r["found"] for r in rows] == [True, False, True, True]
    assert [r["content"] and bytes(r["content"]) for r in rows] == [b"%PDF" * 10, None, b"\x89PNG", b"x"]


def test_inventory_table(spark, container, tmp_path):
    path = str(tmp_path / "inventory")
    writers.write_table(objects.list_objects(spark, str(container)), path)
    assert objects.read_inventory(spark, path).count() == 3


def test_attach_contents(spark):
    manifest = spark.createDataFrame([("a",), ("b",)], "blob_path string")
    contents = spark.createDataFrame([("a", [bytearray(b"x")], None)], "blob_path string, pages array<binary>, text string")
    found = {r["blob_path"]: r["found"] for r in attach_contents(manifest, contents).collect()}
    assert found == {"a": True, "b": False}


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_manifest_round_trip(spark, tmp_path, format):
    path = str(tmp_path / "manifest")
    rows = [
        (1, 'a "b", c\nd.pdf', "PO", 5, "RAS_1/a", "R_1/a", 9, 11, None),
        (2, "x.pdf", None, None, "RAS_2/x", "R_2/x", 0, None, None),
    ]
    frame = spark.createDataFrame(rows, MANIFEST)
    writers.write_table(frame, path, format)
    assert sorted(files.read_manifest(spark, path, format).collect()) == sorted(frame.collect())


def test_missing_manifest_is_named(spark, tmp_path):
    with pytest.raises(files.MissingInputError, match="build it first"):
        files.read_manifest(spark, str(tmp_path / "none"))


def test_document_directory(spark, tmp_path):
    good = {
        "is_quotation": True,
        "quotation_data": {"quoted_price": 5},
        "_metadata": {"ras_id": "7", "file_name": "a.pdf", "supplier_id_from_db": 3},
    }
    directory = tmp_path / "docs"
    directory.mkdir()
    (directory / "RAS_7_a b+c.pdf.json").write_text(json.dumps(good, indent=2))
    (directory / "bad.json").write_text('{"a": 1} and more')
    (directory / "list.json").write_text("[1]")
    (directory / "note.txt").write_text("{}")
    docs, rejects = files.read_document_files(spark, str(directory))
    row = docs.first()
    assert docs.count() == 1 and row["json_file"] == "RAS_7_a b+c.pdf.json"
    assert row["meta"]["ras_id"] == "7" and row["meta"]["supplier_id_from_db"] == 3
    assert row["quotation_data"]["quoted_price"] == 5.0
    assert {tuple(r) for r in rejects.collect()} == {("bad.json", "json_error"), ("list.json", "not_an_object")}


def test_documents_as_json_lines(spark, sf_dir, tmp_path):
    """What is written as JSON comes back equal, every field of the schema among it."""
    from datetime import datetime

    from attestry.catalog.queries import _documents
    from attestry.schemas import DOC

    whole = (
        ("PO", "high", "PO", True, "because"),
        True,
        ("S", "I", "M", {"kW": "5", "é": "ü"}, 1.5, "INR", 0.5, "3", "30 days", "FOB", "1 y", "60 d", "2024-01-01", "Q-1"),
        [("a", "1", "x"), (None, "2", None)],
        "summary\nwith a line",
        ("7", "a.pdf", ".pdf", "PO", 3, datetime(2024, 1, 2, 3, 4, 5)),
        "RAS_7_a.pdf.json",
    )
    docs = _documents(spark, sf_dir).unionByName(spark.createDataFrame([whole], DOC))
    docs.write.parquet(str(tmp_path / "table"))
    docs = files.read_documents(spark, str(tmp_path / "table"))
    path = str(tmp_path / "documents")
    writers.write_documents(docs, path, "json")
    with open(path + "/part-extra.json", "w") as extra:
        extra.write('{"json_file": "x"} and more\n\n   \n[1]\n{"is_quotation": true}\n')
    again, rejects = files.read_document_lines(spark, path)
    assert again.schema.simpleString() == DOC.simpleString()
    text = lambda frame: sorted(r[0] for r in frame.select(F.to_json(F.struct("*"))).collect())
    assert text(again) == text(docs)
    assert again.where("json_file = 'RAS_7_a.pdf.json'").first().asDict(True) == spark.createDataFrame([whole], DOC).first().asDict(True)
    found = {(r["file"], r["block_start"], r["reason"], r["line"]) for r in rejects.collect()}
    assert found == {
        ("part-extra.json", 0, "json_error", '{"json_file": "x"} and more'),
        ("part-extra.json", 0, "not_an_object", "[1]"),
        ("part-extra.json", 0, "no_key", '{"is_quotation": true}'),
    }


def _keyed(spark, rows):
    from attestry.schemas import DOC

    full = [(None, None, None, None, summary, None, key) for key, summary in rows]
    return spark.createDataFrame(full, DOC)


def test_a_second_run_replaces_only_its_keys(spark, tmp_path):
    path = str(tmp_path / "documents")
    held = lambda: {r["json_file"]: r["raw_summary"] for r in files.read_documents(spark, path).collect()}
    writers.upsert_documents(_keyed(spark, [(f"k{i}", "old") for i in range(40)]), path, slots=8)
    before = {str(p.relative_to(path)) for p in (tmp_path / "documents").rglob("*.parquet")}
    writers.upsert_documents(_keyed(spark, [("k3", "new"), ("k40", "new")]), path, slots=8)
    assert held() == {f"k{i}": "old" for i in range(40)} | {"k3": "new", "k40": "new"}
    assert files.read_documents(spark, path).count() == 41
    after = {str(p.relative_to(path)) for p in (tmp_path / "documents").rglob("*.parquet")}
    assert before & after, "parts without a new key were written again"
    writers.upsert_documents(_keyed(spark, []), path, slots=8)
    assert len(held()) == 41
    with pytest.raises(ValueError, match="slot_of_8"):
        writers.upsert_documents(_keyed(spark, [("k1", "x")]), path, slots=16)


def test_a_failed_run_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "documents")
    writers.upsert_documents(_keyed(spark, [(f"k{i}", "old") for i in range(20)]), path, slots=4)
    broken = _keyed(spark, [(f"k{i}", "new") for i in range(20)]).withColumn(
        "raw_summary", F.when(F.col("json_file") == "k7", F.raise_error(F.lit("no"))).otherwise(F.col("raw_summary"))
    )
    with pytest.raises(Exception, match="no"):
        writers.upsert_documents(broken, path, slots=4)
    with pytest.raises(Exception, match="without json_file"):
        writers.upsert_documents(_keyed(spark, [(None, "new")]), path, slots=4)
    rows = files.read_documents(spark, path).collect()
    assert len(rows) == 20 and {r["raw_summary"] for r in rows} == {"old"}


def test_pieces_of_files(spark, container):
    (container / "R_12_2025" / "empty").write_bytes(b"")
    (container / "R_12_2025" / "large").write_bytes(bytes(range(256)) * 40)
    sizes = [("R_1_2025/a.pdf", 40), ("R_12_2025/empty", 0), ("R_12_2025/large", 10240), ("R_1_2025/none", 30)]
    manifest = spark.createDataFrame([*sizes, sizes[0], ("R_1_2025/unknown", None)], "blob_path string, size_bytes bigint")
    ranges = objects.plan_pieces(manifest.distinct(), piece_bytes=4096).where("blob_path like '%large'").orderBy("piece_no")
    assert [tuple(r)[1:] for r in ranges.collect()] == [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 2048)]
    pieces = objects.fetch_pieces(manifest, f"file://{container}", 16, partitions=3)
    read = {}
    for row in pieces.orderBy("blob_path", "piece_no").collect():
        assert row["content"] is None or len(row["content"]) <= 16
        read[row["blob_path"]] = read.get(row["blob_path"], b"") + bytes(row["content"] or b"")
    assert read == {
        "R_1_2025/a.pdf": b"%PDF" * 10,
        "R_12_2025/empty": b"",
        "R_12_2025/large": bytes(range(256)) * 40,
        "R_1_2025/none": b"",
    }
    contents = spark.createDataFrame([(k, bytearray(v)) for k, v in read.items() if "none" not in k], "blob_path string, content binary")
    cut = objects.piece_summary(objects.cut_pieces(contents, piece_bytes=16))
    fetched = objects.piece_summary(pieces)
    summary = {r["blob_path"]: (r["found"], r["num_pieces"], r["size"]) for r in fetched.collect()}
    assert summary == {
        "R_1_2025/a.pdf": (True, 3, 40),
        "R_12_2025/empty": (True, 1, 0),
        "R_12_2025/large": (True, 640, 10240),
        "R_1_2025/none": (False, 0, None),
    }
    assert sorted(map(tuple, fetched.where("found").collect())) == sorted(map(tuple, cut.collect()))


def test_write_tables(spark, tmp_path):
    frame = spark.range(3)
    writers.write_tables({"one": frame, "two": frame}, str(tmp_path / "out"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "two")).count() == 3
    with pytest.raises(ValueError):
        writers.write_table(frame, str(tmp_path / "x"), "xlsx")


def test_source_tables_are_renamed(spark):
    rows = spark.sql(
        "select 1 PURCHASE_ID, 2 PURCHASE_DTL_ID, 3L ATTACHMENT_ID, 'f' FILES_NAME, 'l' FILE_LOCATION,"
        " 't' ATT_TYPE, 4 SUPPLIER_ID, timestamp'2024-01-01' UPLOADED_ON, 9 other"
    )
    assert tables.attachments_from(rows).schema.simpleString() == ATTACHMENT.simpleString()
    items = spark.sql(
        "select 1 purchase_req_id, 'i' Item_Name, 'c' Purchase_Category, 's' Sub_Category_Type, 'x' Supplier,"
        " 1.50 Original_Item_Value_INR, '2' Negotiated_Item_Value_INR"
    )
    converted = tables.items_from(items)
    assert converted.schema.simpleString() == ITEM.simpleString()
    assert converted.first()["negotiated_inr"] == 2.0
    with pytest.raises(ValueError, match="SUPPLIER_ID"):
        tables.attachments_from(rows.drop("SUPPLIER_ID"))


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "t", "id", 0, 100, 8, driver="d")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert options["driver"] == "d"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", partition_column="id")


def test_route_of_object_names(spark):
    frame = spark.createDataFrame([("file:/a/b/c",), ("s3://x/y",)], "p string")
    names = [r[0] for r in frame.select(objects.object_name(F.col("p"), "file:/a")).collect()]
    assert names == ["b/c", "s3://x/y"]


def test_contents_tables(spark):
    from attestry.operators.contents import image_contents, page_contents, workbook_contents

    pages = spark.createDataFrame(
        [("a.pdf", n, bytearray(b"%d" % n)) for n in range(9, 0, -1)] + [("b.pdf", 4, bytearray(b"x"))],
        "blob_path string, page_no int, content binary",
    )
    kept = {r["blob_path"]: [bytes(p) for p in r["pages"]] for r in page_contents(pages, 5).collect()}
    assert kept == {"a.pdf": [b"1", b"2", b"3", b"4", b"5"], "b.pdf": [b"x"]}
    whole = {r["blob_path"]: len(r["pages"]) for r in page_contents(pages).collect()}
    assert whole == {"a.pdf": 9, "b.pdf": 1}
    rows = spark.createDataFrame(
        [("w.xlsx", 1, "S", 1, "cell")], "file string, sheet_no int, sheet string, row_no int, row_text string"
    )
    images = spark.createDataFrame([("i.png", bytearray(b"i"))], "name string, content binary")
    together = page_contents(pages).unionByName(workbook_contents(rows)).unionByName(image_contents(images))
    assert together.count() == 4
    assert workbook_contents(rows).first()["text"] == "=== Sheet: S ===\n\ncell"
