from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from attestry import ExtractOptions, extract_documents, summarise_extraction
from attestry.operators import extract
from attestry.schemas import DOC, EXTRACTION_RESULT, RESPONSE, STATUSES

FAST = ExtractOptions(min_interval_s=0.0)


def recorder(log: str):
    """Factory of a client that answers from its prompt and notes every call."""

    def factory():
        import pathlib
        import time
        import uuid

        class Client:
            def complete(self, system, parts, temperature, max_tokens):
                started = time.monotonic()
                note = pathlib.Path(log) / uuid.uuid4().hex
                note.write_text(f"{started} {len(parts)} {temperature} {max_tokens}")
                text = parts[0]["text"]
                name = text.split("File: ")[1].split("\n")[0]
                if "boom" in name:
                    raise RuntimeError("no answer")
                if "prose" in name:
                    return "I cannot read this."
                if "list" in name:
                    return "[]"
                answer = {
                    "document_classification": {"verified_type": "PO", "att_type_matches_content": "q" not in name},
                    "is_quotation": "q" in name,
                    "quotation_data": {"quoted_price": 10, "supplier_name": "S", "canonical_item_name": text[-5:]},
                }
                return f"```json\n{json.dumps(answer)}\n```"

        return Client()

    return factory


@pytest.fixture
def inputs(spark):
    when = datetime(2024, 1, 1)
    page = bytearray(b"page")
    rows = [
        (1, 1, "q1.pdf", "PO", [page] * 7, None, True),
        (1, 2, "book.xlsx", None, None, "12345", True),
        (1, 3, "scan.jpeg", "PO", [page], None, True),
        (1, 4, "mail.msg", "PO", None, None, True),
        (1, 5, "gone.pdf", "PO", None, None, False),
        (2, 6, "boom.pdf", "PO", [page], None, True),
        (2, 7, "prose.pdf", "PO", [page], None, True),
        (2, 8, "list.png", "PO", [page], None, True),
    ]
    frame = spark.createDataFrame(
        rows,
        "ras_id bigint, att_id bigint, file_name string, att_type string, pages array<binary>, text string, found boolean",
    )
    return frame.withColumns(
        {
            "supplier_id": F.lit(7).cast("bigint"),
            "blob_path": F.concat(F.lit("p/"), "file_name"),
            "uploaded_on": F.lit(when).cast("timestamp_ntz"),
        }
    )


def notes(path):
    return [p.read_text().split() for p in path.iterdir()]


def test_extract_documents(spark, inputs, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    stored = str(tmp_path / "responses")
    at = datetime(2024, 5, 6, 7, 8, 9)
    docs, results = extract_documents(inputs, recorder(str(log)), stored, FAST, at)
    assert docs.schema.simpleString() == DOC.simpleString()
    assert results.schema.simpleString() == EXTRACTION_RESULT.simpleString()
    by_name = {r["file_name"]: r for r in results.collect()}
    assert {n: r["status"] for n, r in by_name.items()} == {
        "q1.pdf": "success",
        "book.xlsx": "success",
        "scan.jpeg": "success",
        "mail.msg": "unsupported",
        "gone.pdf": "not_found",
        "boom.pdf": "error",
        "prose.pdf": "json_error",
        "list.png": "error",
    }
    assert {r["status"] for r in by_name.values()} == set(STATUSES)
    assert by_name["boom.pdf"]["error"] == "no answer"
    assert by_name["list.png"]["error"] == "not_an_object"
    assert by_name["mail.msg"]["ext"] == ".msg" and by_name["gone.pdf"]["ext"] is None
    assert by_name["q1.pdf"]["quoted_price"] == 10.0
    assert by_name["scan.jpeg"]["quoted_price"] is None
    assert by_name["scan.jpeg"]["is_quotation"] is False
    assert by_name["prose.pdf"]["is_quotation"] is None
    documents = {r["json_file"]: r for r in docs.collect()}
    assert set(documents) == {"RAS_1_q1.pdf.json", "RAS_1_book.xlsx.json", "RAS_1_scan.jpeg.json"}
    assert documents["RAS_1_book.xlsx.json"]["quotation_data"]["canonical_item_name"] == "12345"
    assert documents["RAS_1_q1.pdf.json"]["meta"]["extraction_timestamp"] == at
    assert documents["RAS_1_q1.pdf.json"]["meta"]["ras_id"] == "1"
    # Six calls: the missing and the unsupported file are never sent; all pages are.
    calls = notes(log)
    assert len(calls) == 6
    assert sorted(c[1] for c in calls) == ["1", "2", "2", "2", "2", "8"]
    assert {tuple(c[2:]) for c in calls} == {("0.1", "3000")}
    totals = summarise_extraction(results).first()
    assert tuple(totals) == (8, 3, 1, 1)


def test_stored_responses_are_not_asked_again(spark, inputs, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    stored = str(tmp_path / "responses")
    routed = extract.route_files(inputs)
    requests = extract.build_requests(routed)
    first = requests.where("ras_id = 1")
    rows = extract.store_responses(first, stored, recorder(str(log)), FAST).collect()
    failed = sum(r["raw"] is None for r in rows)
    assert len(notes(log)) == len(rows) == 3
    waves = ExtractOptions(min_interval_s=0.0, waves=3, partitions=2)
    table = extract.store_responses(requests, stored, recorder(str(log)), waves)
    assert len(notes(log)) == 6 + failed  # a failed call is made again, an answered one is not
    assert table.schema.simpleString() == RESPONSE.simpleString()
    assert table.count() == table.select("request_id").distinct().count() == 6


def test_failed_calls_are_made_again_and_batches_kept_apart(spark, inputs, tmp_path):
    class Working:
        def complete(self, system, parts, temperature, max_tokens):
            return "{}"

    def broken():
        raise ValueError("no credentials")

    stored = str(tmp_path / "responses")
    requests = extract.build_requests(extract.route_files(inputs))
    first = extract.store_responses(requests, stored, broken, FAST).collect()
    assert {r["error"] for r in first} == {"no credentials"} and len(first) == 6
    part = requests.where("ras_id = 1")
    again = extract.store_responses(part, stored, Working, FAST).collect()
    assert [(r["raw"], r["error"]) for r in again] == [("{}", None)] * 3
    whole = extract.store_responses(requests, stored, Working, FAST).collect()
    assert len(whole) == 6 and {r["raw"] for r in whole} == {"{}"}
    other = requests.withColumn("prompt_version", F.lit("2"))
    assert len(extract.store_responses(other, stored, broken, FAST).collect()) == 6
    assert spark.read.parquet(stored).count() == 6 + 3 + 3 + 6


def test_partitions_do_not_change_responses(spark, sf_dir):
    import stand_in

    answers = stand_in.extract_batch(spark, sf_dir)
    requests = stand_in.extract_requests(spark, sf_dir)
    one, eight = (
        extract.call_model(requests, stand_in.client_factory(), ExtractOptions(min_interval_s=0.0, partitions=n))
        .select("request_id", "raw", "error", "attempts")
        for n in (1, 8)
    )
    expected = sorted(map(tuple, answers.collect()))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, eight.collect())) == expected


def test_failed_calls_are_retried_and_spaced(spark, inputs, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    requests = extract.build_requests(extract.route_files(inputs)).where("file_name = 'boom.pdf'")
    options = ExtractOptions(min_interval_s=0.3, max_attempts=3, partitions=1)
    row = extract.call_model(requests, recorder(str(log)), options).first()
    assert (row["raw"], row["error"], row["attempts"]) == (None, "no answer", 3)
    starts = sorted(float(c[0]) for c in notes(log))
    assert all(b - a >= 0.3 for a, b in zip(starts, starts[1:])) and len(starts) == 3


def test_a_broken_factory_fails_rows_not_the_job(spark, inputs):
    def broken():
        raise ValueError("no credentials")

    requests = extract.build_requests(extract.route_files(inputs))
    rows = extract.call_model(requests, broken, FAST).collect()
    assert {r["error"] for r in rows} == {"no credentials"} and len(rows) == 6


def test_the_last_of_equal_keys_stays(spark):
    rows = [
        ("RAS_1_a", datetime(2024, 1, 1), 1, "x"),
        ("RAS_1_a", datetime(2024, 1, 2), 2, "x"),
        ("RAS_1_a", datetime(2024, 1, 2), 3, "x"),
        ("RAS_1_b", None, None, "x"),
        ("RAS_1_b", None, None, "y"),
    ]
    frame = spark.createDataFrame(rows, "json_file string, uploaded_on timestamp_ntz, att_id bigint, blob_path string")
    kept = {(r["json_file"], r["att_id"], r["blob_path"]) for r in extract.latest_per_key(frame).collect()}
    assert kept == {("RAS_1_a", 3, "x"), ("RAS_1_b", None, "y")}


# ---- outcomes ----


def short():
    """Factory of a client whose answers for names with an x need 10,000 tokens, and break off below."""

    def factory():
        from attestry import Reply

        class Short:
            def complete(self, system, parts, temperature, max_tokens):
                if "x" in parts[0]["text"].split("\n")[0] and max_tokens < 10_000:
                    return Reply('{"is_quotation": true}', cut=True)
                return "{}"

        return Short()

    return factory


def test_cut_answers_are_asked_again_with_larger_bounds(spark, inputs, tmp_path):
    stored = str(tmp_path / "responses")
    requests = extract.build_requests(extract.route_files(inputs)).where("ras_id = 1")
    low = ExtractOptions(min_interval_s=0.0, token_limit=5_000)
    rows = {r["file_name"]: r for r in extract.store_responses(requests, stored, short(), low).collect()}
    assert rows["book.xlsx"]["outcome"] == "cut" and rows["book.xlsx"]["max_tokens"] == 5_000
    assert rows["book.xlsx"]["attempts"] == 2 and rows["q1.pdf"]["outcome"] == "finished"
    # At its limit a cut answer is final; with a higher one it is asked again.
    extract.store_responses(requests, stored, short(), low)
    assert spark.read.parquet(stored).count() == 3
    high = ExtractOptions(min_interval_s=0.0, token_limit=12_000)
    again = {r["file_name"]: r for r in extract.store_responses(requests, stored, short(), high).collect()}
    book = again["book.xlsx"]
    assert (book["outcome"], book["raw"], book["call_no"], book["max_tokens"]) == ("finished", "{}", 2, 10_000)
    assert spark.read.parquet(stored).count() == 4


def test_a_cut_answer_never_counts(spark, inputs, tmp_path):
    low = ExtractOptions(min_interval_s=0.0, token_limit=3_000)
    docs, results = extract_documents(inputs, short(), str(tmp_path / "responses"), low)
    status = {r["file_name"]: r["status"] for r in results.collect()}
    assert status["book.xlsx"] == "json_error" and status["q1.pdf"] == "success"
    assert "RAS_1_book.xlsx.json" not in {r["json_file"] for r in docs.collect()}


def test_rows_from_before_outcomes_count_by_their_text(spark):
    from attestry.operators import calls

    rows = [("a", "1", "{}", None, 1), ("b", "1", None, "e", 2), ("b", "1", None, "e", 1)]
    old = spark.createDataFrame(rows, "request_id string, prompt_version string, raw string, error string, attempts int")
    old = old.withColumns({"call_no": F.lit(None).cast("int"), "max_tokens": F.lit(None).cast("int")})
    asked = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "request_id string, prompt_version string")
    open_ = {r["request_id"]: (r["call_no"], r["max_tokens"]) for r in calls.open_calls(asked, old, FAST).collect()}
    assert open_ == {"b": (3, 3000), "c": (1, 3000)}


def test_a_rate_is_shared_by_the_partitions():
    assert ExtractOptions(calls_per_second=4.0, partitions=8).interval() == 2.0
    with pytest.raises(ValueError):
        ExtractOptions(calls_per_second=4.0).interval()


# ---- stored contents ----


def echo():
    """Factory of a client that answers with what it was sent."""

    def factory():
        import base64

        class Echo:
            def complete(self, system, parts, temperature, max_tokens):
                pages = [base64.b64decode(p["url"].split(",")[1]).decode() for p in parts[1:]]
                text = parts[0]["text"].split("Content of the file:\n")
                name = text[0].split("File: ")[1].split("\n")[0]
                if name == "boom.pdf":
                    raise RuntimeError("no answer")
                offer = {"canonical_item_name": "|".join(pages + text[1:]), "supplier_name": parts[-1]["type"]}
                answer = {
                    "document_classification": {"verified_type": "PO"},
                    "is_quotation": True,
                    "quotation_data": offer,
                }
                return json.dumps(answer)

        return Echo()

    return factory


@pytest.fixture
def store(spark, tmp_path):
    from attestry.operators import contents
    from attestry.operators.calls import store_contents

    pages = [("p/a.pdf", n, bytearray(b"page%d" % n)) for n in range(1, 13)]
    pages += [("p/boom.pdf", 1, bytearray(b"x"))] + [(f"p/{i}.pdf", 1, bytearray(b"%d" % i)) for i in range(40)]
    cells = [("p/book.xlsx", s, f"s{s}", r, f"r{r}") for s in (1, 2) for r in range(1, 400)]
    pieces = (
        contents.page_pieces(spark.createDataFrame(pages, "blob_path string, page_no int, content binary"))
        .unionByName(contents.image_pieces(spark.createDataFrame([("p/i.png", bytearray(b"image"))], "name string, content binary")))
        .unionByName(
            contents.workbook_pieces(
                spark.createDataFrame(cells, "file string, sheet_no int, sheet string, row_no int, row_text string"), 100
            )
        )
    )
    table = f"contents_{tmp_path.name.replace('-', '_')}"
    yield store_contents(pieces, table, str(tmp_path / "contents"), buckets=8, slots=4)
    spark.sql(f"drop table {table}")


@pytest.fixture
def manifest(spark):
    names = ["a.pdf", "a.pdf", "boom.pdf", "i.png", "book.xlsx", "gone.pdf", "mail.msg", *(f"{i}.pdf" for i in range(40))]
    rows = [(1, n, f"p/{name}", name) for n, name in enumerate(names)]
    frame = spark.createDataFrame(rows, "ras_id bigint, att_id bigint, blob_path string, file_name string")
    return frame.withColumns(
        {
            "att_type": F.lit("PO"),
            "supplier_id": F.lit(7).cast("bigint"),
            "uploaded_on": F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"),
        }
    )


def test_extract_stored(spark, store, manifest, tmp_path):
    from attestry import extract_stored, open_contents

    path = str(tmp_path / "responses")
    options = ExtractOptions(min_interval_s=0.0, waves=4)
    docs, results = extract_stored(manifest, store, echo(), path, options)
    docs = {r["json_file"]: r["quotation_data"] for r in docs.collect()}
    text = "\n\n".join(f"=== Sheet: s{s} ===\n\n" + "\n".join(f"r{r}" for r in range(1, 400)) for s in (1, 2))
    assert docs["RAS_1_a.pdf.json"]["canonical_item_name"] == "|".join(f"page{n}" for n in range(1, 13))
    assert docs["RAS_1_i.png.json"]["canonical_item_name"] == "image"
    assert docs["RAS_1_book.xlsx.json"]["canonical_item_name"] == text
    assert docs["RAS_1_39.pdf.json"]["canonical_item_name"] == "39" and len(docs) == 43
    status = {(r["file_name"], r["status"]) for r in results.collect()}
    assert {s for s in status if s[1] != "success"} == {
        ("boom.pdf", "error"), ("gone.pdf", "not_found"), ("mail.msg", "not_found"),
    }
    assert spark.read.parquet(path).count() == 45  # both requests to a.pdf are calls of their own
    sizes = {r["blob_path"]: (r["num_pieces"], r["num_bytes"]) for r in store.files(spark).collect()}
    assert sizes["p/a.pdf"] == (12, 63) and sizes["p/i.png"] == (1, 5)
    # A second run asks for the failed one only; bounds cut pages and text.
    bounded = ExtractOptions(min_interval_s=0.0, waves=2, max_pages=2, max_text_chars=20)
    extract_stored(manifest, store, echo(), path, bounded)
    assert spark.read.parquet(path).where("call_no = 2").count() == spark.read.parquet(path).count() - 45 == 1
    docs, _ = extract_stored(manifest, store, echo(), str(tmp_path / "other"), bounded)
    docs = {r["json_file"]: r["quotation_data"]["canonical_item_name"] for r in docs.collect()}
    assert docs["RAS_1_a.pdf.json"] == "page1|page2" and docs["RAS_1_book.xlsx.json"] == text[:20]
    # Another session names the same files.
    spark.sql(f"create database if not exists other")
    from dataclasses import replace

    again = open_contents(spark, replace(store, table="other.contents"), str(tmp_path / "contents"))
    assert again.pieces(spark).count() == store.pieces(spark).count()
    spark.sql("drop database other cascade")


def test_no_exchange_carries_contents(spark, store, manifest):
    """Pieces are joined where they lie, a wave reads its own slots, and all read each once."""
    import re

    from attestry.operators import calls
    from attestry.schemas import RESPONSE as schema

    routed = extract.route_files(manifest)
    requests = extract.plan_requests(routed).withColumn("slot", calls.slot_of("blob_path", store.slots))
    answers = spark.createDataFrame([], schema)
    read = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for wave in range(4):
            met = calls.calls_of_wave(requests, answers, store, [wave], FAST)
            plan = met._jdf.queryExecution().executedPlan()
            text = plan.toString()
            assert "Bucketed: true" in text
            for line in re.findall(r"Exchange .*", text):
                assert "content" not in line and "text#" not in line
            # Nothing below an exchange reads the contents.
            for part in re.split(r"\n(?=.*Exchange)", text)[1:]:
                scan = re.search(r"\n([ :|]*)[+:]- .*FileScan parquet spark_catalog", part)
                if scan:
                    depth = len(re.match(r"[ :|+-]*", part.split("\n")[0]).group())
                    assert len(scan.group(1)) < depth, part
            read += [tuple(r) for r in met.select("blob_path", "piece_no").distinct().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    present = {r["blob_path"] for r in manifest.collect()}
    pieces = [tuple(r) for r in store.pieces(spark).select("blob_path", "piece_no").collect() if r[0] in present]
    assert sorted(read) == sorted(pieces)
