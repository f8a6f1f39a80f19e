"""Tables between steps hold what is read from them, and text files are compressed on request."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from attestry.catalog import queries as catalog
from attestry.functions import responses
from attestry.operators import crowded, extract, storage, validate
from attestry.schemas import DOC, ITEM, REQUEST_KEYS, members
from attestry.sources import files, writers

QUERIES = catalog.queries()


def _answers(spark):
    """Answers of a few cases, some stored under one key, some broken."""
    offer = '"quotation_data": {"supplier_name": "S%d", "quoted_price": "%d.5", "currency": "INR"}'
    rows = []
    for i in range(60):
        raw = '{"is_quotation": %s, ' % ("true" if i % 3 else "false") + offer % (i, i) + "}"
        raw = (raw, "[1]", raw + " and more", '{"quotation_data": 5}')[(i % 7 == 6) * (i % 4)]
        name = f"f{i % 4}.pdf"
        rows.append((str(i), i % 5, name, ".pdf", "pdf", "PO", True, i, f"p/{i}", i, None, raw, None))
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REQUEST_KEYS.fields)
    return spark.createDataFrame(rows, f"{keys}, raw string, error string")


def test_documents_of_few_members_are_those_of_all(spark):
    answers = _answers(spark)
    whole = extract.extracted_documents(answers)
    for names in (validate.LINK_MEMBERS, validate.SUMMARY_MEMBERS, validate.CHECK_MEMBERS, ("json_file",)):
        part = extract.extracted_documents(answers, columns=names)
        assert part.schema.simpleString() == members(DOC, names).simpleString()
        flat = lambda docs: sorted(map(str, docs.select(*names).collect()))  # noqa: E731, B023
        assert flat(part) == flat(whole) and part.count() == 20
    with pytest.raises(ValueError, match="nothing"):
        extract.extracted_documents(answers, columns=["nothing"])


def test_an_answer_is_bound_once(spark):
    """Each explode copies the whole row; there were three."""
    plan = responses.parse_responses(_answers(spark).drop("error")).where("status = 'success'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode") == 1 and text.count("parseJson") == 1


def _kept(monkeypatch, module):
    """Names and schemas of the tables that a module stores."""
    tables = {}

    def recording(frame, label):
        tables[label] = frame.schema.simpleString()
        return storage.stored(frame, label)

    monkeypatch.setattr(module, "stored", recording)
    return tables


@pytest.mark.parametrize(
    "name, docs, items",
    [
        ("q30b_supplier_links", "struct<quotation_data:struct<supplier_name:string>", "struct<ras_id:bigint,supplier:string>"),
        ("q32_price_summary", "struct<quotation_data:struct<supplier_name:string,quoted_price:double>", "struct<ras_id:bigint,supplier:string,original_inr:double>"),
        ("q32b_document_checks", "struct<quotation_data:struct<canonical_item_name:string,quoted_price:double>", "struct<ras_id:bigint,item_name:string,original_inr:double>"),
    ],
)
def test_reports_store_what_they_read(spark, sf_dir, monkeypatch, name, docs, items):
    tables = _kept(monkeypatch, catalog)
    QUERIES[name](spark, sf_dir)
    offer = lambda schema: schema.replace("is_quotation:boolean,", "")
    assert offer(tables["documents"]).startswith(docs) and tables["items"] == items
    assert "additional_items" not in tables["documents"]


def test_the_manifest_moves_what_it_holds(spark, sf_dir, monkeypatch):
    from attestry.plans import jobs

    tables = _kept(monkeypatch, jobs)
    QUERIES["q36_manifest_csv"](spark, sf_dir)
    assert "blob_path" in tables["located"]
    for name in ("file_location", "l_partkey", "l_extendedprice", "dtl_id", "path:", "rn:"):
        assert name not in tables["located"].replace("blob_path", "")


@pytest.mark.parametrize("name, kind", [("q36_manifest_csv", "csv"), ("q36b_documents_json", "json")])
def test_handed_text_is_compressed(spark, sf_dir, tmp_path, monkeypatch, name, kind):
    monkeypatch.setattr(catalog, "_path", lambda spark, label: str(tmp_path / "handed"))
    assert QUERIES[name](spark, sf_dir).count() > 0
    written = glob.glob(f"{tmp_path}/handed/part-*")
    assert written and all(n.endswith(f".{kind}.gz") for n in written)


def test_compressed_documents_come_back(spark, tmp_path, monkeypatch):
    docs = extract.extracted_documents(_answers(spark)).withColumn("raw_summary", F.lit('a "b"\nc'))
    docs.write.parquet(str(tmp_path / "table"))
    docs = files.read_documents(spark, str(tmp_path / "table"))
    monkeypatch.setattr(writers, "FILE_ROWS", 3)
    path = str(tmp_path / "json")
    writers.write_documents(docs, path, "json", compression="gzip")
    again, rejects = files.read_document_lines(spark, path)
    text = lambda frame: sorted(r[0] for r in frame.select(F.to_json(F.struct("*"))).collect())
    assert text(again) == text(docs) and rejects.count() == 0
    assert len(glob.glob(path + "/part-*.json.gz")) >= 7


def _reports(spark):
    rng = random.Random(17)
    docs, items = [], []
    for i in range(90):
        offer = (rng.choice([None, "", "Acme", "acme ltd", "ABC", "x"]), "I", None, None)
        offer += (rng.choice([None, 0.0, -4.0, 100.0, 119.9, 80.0, 125.0]), "INR") + (None,) * 8
        case = rng.choice([None, "1", "2", "3", "4"])
        docs.append((None, rng.random() < 0.8, offer, None, None, (case, f"f{i}", None, None, 1, None), f"{i}.json"))
    for _ in range(70):
        name = rng.choice([None, "", "ACME", "Foo", "abcd", "X"])
        items.append((rng.choice([None, 1, 2, 3, 5]), "n", "c", "s", name, rng.choice([None, 0.0, 100.0, -5.0, 104.0]), 1.0))
    return spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)


@pytest.mark.parametrize("report", ["supplier_links", "price_summary"])
def test_reports_are_the_same_by_pairs_and_by_totals(spark, monkeypatch, report):
    sides = _reports(spark)
    ways = []
    for per_row in (0, 10**6):
        bounds = lambda a, b, n=per_row: crowded.crowded_groups(a, b, "ras_id", n, n)
        monkeypatch.setattr(validate, "crowded_groups", bounds)
        ways.append(sorted(map(str, getattr(validate, report)(*sides).collect())))
    assert ways[0] == ways[1] and ways[0]
    pairs = validate.price_check(*sides)
    if report == "price_summary":
        expected = pairs.agg(
            F.count_if("price_in_range").alias("price_hits"),
            F.count("price_in_range").alias("price_checked"),
            F.count("supplier_match").alias("supplier_checked"),
            F.count_if("supplier_match").alias("supplier_hits"),
        )
    else:
        linked = pairs.where("supplier_match").groupBy("ras_id", "extracted_supplier", "db_supplier")
        expected = linked.agg(F.count("*").alias("pairs"))
    assert ways[0] == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("report", ["supplier_links", "price_summary", "document_checks"])
def test_where_no_case_is_crowded_both_sides_are_joined_once(spark, tmp_path, report):
    """Which cases are crowded was worked out in place, so every use read both sides again."""
    docs, items = _reports(spark)
    few = F.struct(F.concat("json_file", F.lit("")).alias("ras_id"), "meta.file_name")
    docs.withColumn("meta", few).write.parquet(str(tmp_path / "docs"))
    items.write.parquet(str(tmp_path / "items"))
    docs, items = (spark.read.parquet(str(tmp_path / n)) for n in ("docs", "items"))
    plan = getattr(validate, report)(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
