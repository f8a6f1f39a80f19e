from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from attestry.functions import amounts, checks, paths, prompts, responses, routing
from attestry.functions.text import WHITESPACE, strip


def test_whitespace_is_all_of_it():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_drops_all_kinds_of_blanks(evaluate):
    rows = [("　\x1c a b \x85\xa0",), ("",), (None,)]
    assert evaluate(rows, "x string", strip("x")) == ["a b", "", None]


# ---- paths ----


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("R_1_2025/a.PDF", ".pdf"),
        ("x/.bashrc", "(no extension)"),
        ("x/a.", "."),
        ("..a.b", ".b"),
        ("...", "(no extension)"),
        ("x.y/abc", "(no extension)"),
        ("d/.x.tar.gz", ".gz"),
        ("", "(no extension)"),
        ("a\nb.TXT", ".txt"),
    ],
)
def test_extension_label(evaluate, name, expected):
    assert evaluate([(name,)], "x string", paths.extension_label("x")) == [expected]


def test_case_ids(evaluate):
    rows = [
        ("R_237910_2025/q.pdf",),
        ("R_1_25/q.pdf",),
        ("x/R_1_2025/q.pdf",),
        ("R_1_2025",),
        (None,),
    ]
    assert evaluate(rows, "x string", paths.case_id("x")) == ["237910", None, None, None, None]
    loose = ["237910", "1", None, "1", None]
    assert evaluate(rows, "x string", paths.case_id_of_prefix("x")) == loose


@pytest.mark.parametrize(
    ("location", "expected"),
    [
        ("R_1_2025/a", "R_1_2025/a"),
        ("/R_1_2025/a", "R_1_2025/a"),
        ("b.x/R_1", "R_1"),
        (" /b.x/R_1\t", "R_1"),
        ("//b.x/R_1", "/b.x/R_1"),
        ("b.x/b.x/R_1", "b.x/R_1"),
        ("b/x/R_1", "b/x/R_1"),
        ("   ", None),
        ("", None),
        (None, None),
    ],
)
def test_normalise_location(evaluate, location, expected):
    rows = [(location,)]
    assert evaluate(rows, "x string", paths.normalise_location("x", "b.x")) == [expected]


def test_doc_key_replaces_separators(evaluate):
    key = paths.doc_key("r", "x")
    assert evaluate([(7, "a/b\\c.pdf")], "r bigint, x string", key) == ["RAS_7_a_b_c.pdf"]


# ---- amounts ----


@pytest.mark.parametrize(
    ("size", "expected"),
    [
        (0, "0.0 B"),
        (1023, "1023.0 B"),
        (1024, "1.0 KB"),
        (1280, "1.2 KB"),
        (1792, "1.8 KB"),
        (1048575, "1024.0 KB"),
        (1048576, "1.0 MB"),
        (3 * 2**30, "3.0 GB"),
        (2**50, "1024.0 TB"),
        (None, None),
    ],
)
def test_format_size(evaluate, size, expected):
    assert evaluate([(size,)], "x bigint", amounts.format_size("x")) == [expected]


def test_round1_follows_the_exact_binary_value(evaluate):
    rng = random.Random(1)
    values = [0.05, 0.15, 0.25, 0.35, 0.45, 1.05, 2.5, 0.75, 99.95, 0.0, 100.0, 1e9 + 0.25]
    values += [n / total * 100 for total in range(1, 60) for n in range(total + 1)]
    values += [n / 2000 * 100 for n in range(2001)]
    values += [rng.uniform(0, 2000) for _ in range(5000)]
    values += [round(rng.uniform(0, 100), 2) for _ in range(5000)]
    actual = evaluate([(v,) for v in values], "x double", amounts.round1("x"))
    assert actual == [round(v, 1) for v in values]


def test_format_size_follows_the_exact_binary_value(evaluate):
    rng = random.Random(2)
    values = [rng.uniform(0, 1023) for _ in range(2000)] + [rng.randrange(1024) / 20 for _ in range(999)]
    actual = evaluate([(v,) for v in values], "x double", amounts.format_size("x"))
    assert actual == [f"{v:.1f} B" for v in values]


def test_percentage_of_nothing_is_null(evaluate):
    share = amounts.percentage("a", "b")
    rows = [(1, 3), (0, 5), (1, 2000), (0, 0), (None, 2)]
    assert evaluate(rows, "a bigint, b bigint", share) == [33.3, 0.0, 0.1, None, None]


def test_size_bucket_edges(evaluate):
    mib = 2**20
    sizes = [0, mib - 1, mib, 10 * mib - 1, 10 * mib, 50 * mib, 100 * mib - 1, 100 * mib, None]
    expected = ["< 1 MB"] * 2 + ["1-10 MB"] * 2 + ["10-50 MB"] + ["50-100 MB"] * 2 + ["> 100 MB", None]
    assert evaluate([(s,) for s in sizes], "x bigint", amounts.size_bucket("x")) == expected


# ---- routing ----


def test_route_and_reason(evaluate):
    exts = [".pdf", ".xlsx", ".xls", ".png", ".bmp", ".msg", ".docx", ".csv", ""]
    rows = [(e,) for e in exts]
    routes = ["pdf", "excel", "excel", "image", "image"] + ["unsupported"] * 4
    assert evaluate(rows, "x string", routing.route("x")) == routes
    reasons = [None] * 5 + ["known_unconverted", "unknown", "unknown", "unknown"]
    assert evaluate(rows, "x string", routing.unsupported_reason("x")) == reasons


def test_media_type(evaluate):
    rows = [(".jpg",), (".jpeg",), (".tiff",), (".bmp",), (".png",), (".pdf",), (None,)]
    expected = ["image/jpeg", "image/jpeg", "image/tiff", "image/bmp"] + ["image/png"] * 3
    assert evaluate(rows, "x string", routing.media_type("x")) == expected


# ---- prompts ----


def test_prompt_names_file_and_label(evaluate):
    template = prompts.PromptTemplate("9", "s", "f={file_name} t={att_type} {other} f={file_name}")
    prompt = prompts.render_prompt(template, "f", "t")
    rows = [("a{att_type}.pdf", "PO"), ("b", None)]
    assert evaluate(rows, "f string, t string", prompt) == [
        "f=a{att_type}.pdf t=PO {other} f=a{att_type}.pdf",
        "f=b t=unknown {other} f=b",
    ]


def test_default_prompt_lists_every_answer_field():
    from attestry.schemas import ANSWER, DOCUMENT_TYPES

    text = prompts.DEFAULT_TEMPLATE.user
    for member in ANSWER.fields:
        assert f"\n{member.name}: " in text
    assert all(kind in text for kind in DOCUMENT_TYPES)
    assert "meta" not in text


def test_document_text_is_whole_unless_bounded(evaluate):
    template = prompts.PromptTemplate("1", "s", "p", text_header="|")
    rows = [("é word " * 20_000,), ("ab",)]
    whole = prompts.with_document_text(template, F.lit("p"), "x")
    assert evaluate(rows, "x string", whole) == ["p|" + "é word " * 20_000, "p|ab"]
    bounded = prompts.with_document_text(template, F.lit("p"), "x", 12)
    assert evaluate(rows, "x string", bounded) == ["p|" + ("é word " * 2)[:12], "p|ab"]


def test_message_parts(evaluate):
    pages = [bytearray(b"x" * 200)] * 7
    parts = evaluate([(pages,), (None,)], "x array<binary>", prompts.message_parts(F.lit("p"), F.lit("image/png"), "x"))
    assert [p["type"] for p in parts[0]] == ["text"] + ["image_url"] * 7
    assert parts[0][1]["url"].startswith("data:image/png;base64,eHh4")
    assert "\n" not in parts[0][1]["url"] and "\r" not in parts[0][1]["url"]
    assert parts[0][1]["detail"] == "high" and parts[0][0]["text"] == "p"
    assert len(parts[1]) == 1


# ---- responses ----


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("{}", "{}"),
        ("```json\n{}\n```", "{}"),
        ("```{}```", "{}"),
        ("```json```{}", "{}"),
        ("```json{}", "{}"),
        ("```JSON\n{}\n```", "JSON\n{}"),
        (" 　{}\n", "{}"),
        ("{}```\n", "{}"),
        ("```", ""),
        ("``````", ""),
        ("````", "`"),
        ("```json", ""),
        ("``````{}", "```{}"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_response(evaluate, raw, expected):
    assert evaluate([(raw,)], "x string", responses.clean_response("x")) == [expected]


JSON_CASES = [
    ('{"a":1}', "success"),
    ("  {}\n", "success"),
    ('{"a":1,"a":2}', "success"),
    ('{"a":1} trailing', "json_error"),
    ('{"a":1}{"b":2}', "json_error"),
    ('{"a":1},{"b":2}', "json_error"),
    ('{"a":1}]', "json_error"),
    ('{"a":1}],[{"b":2}', "json_error"),
    ('{"a":1,}', "json_error"),
    ("{'a':1}", "json_error"),
    ('{"a":01}', "json_error"),
    ('{"a":NaN}', "json_error"),
    ("", "json_error"),
    ("tru", "json_error"),
    ("[1]", "error"),
    ("null", "error"),
    ('"{}"', "error"),
    ("1", "error"),
    (None, "error"),
]


def test_parse_status(spark):
    frame = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(JSON_CASES)], "i int, raw string")
    rows = {r["i"]: r for r in responses.parse_responses(frame).drop("answer").collect()}
    assert [rows[i]["status"] for i in range(len(JSON_CASES))] == [s for _, s in JSON_CASES]
    reasons = [rows[i]["error"] for i, (_, s) in enumerate(JSON_CASES) if s == "error"]
    assert reasons == ["not_an_object"] * 4 + ["no_response"]
    for raw, status in JSON_CASES:
        if raw is None or "NaN" in raw:
            continue
        try:
            valid = isinstance(json.loads(raw), dict) or status == "error"
        except json.JSONDecodeError:
            valid = False
        assert valid == (status != "json_error"), raw


def test_failed_call_is_an_error(spark):
    frame = spark.createDataFrame([("{}", "timed out"), ("{}", None)], "raw string, failure string")
    rows = responses.parse_responses(frame, error="failure").select("status", "error").collect()
    assert sorted(map(tuple, rows), key=str) == [("error", "timed out"), ("success", None)]


def test_sample_record(spark):
    record = {
        "document_classification": {
            "verified_type": "Quotation",
            "confidence": "high",
            "att_type_matches_content": True,
        },
        "is_quotation": True,
        "quotation_data": {
            "supplier_name": "Maker AG",
            "canonical_item_name": "Press 400T",
            "technical_specifications": {"tonnage": "400T", "type": "Horizontal"},
            "quoted_price": 8623842,
            "currency": "INR",
            "payment_terms": "30% advance",
        },
    }
    frame = spark.createDataFrame([(json.dumps(record, indent=2),)], "raw string")
    row = responses.with_typed_answer(responses.parse_responses(frame)).drop("answer").first()
    assert row["is_quotation"] is True
    assert row["quotation_data"]["quoted_price"] == 8623842.0
    assert row["quotation_data"]["technical_specifications"] == record["quotation_data"]["technical_specifications"]
    assert row["document_classification"]["att_type_matches_content"] is True
    assert row["additional_items"] is None


def test_members_of_the_wrong_type_are_null(spark):
    raws = [
        '{"quotation_data":{"quoted_price":"8,623","supplier_name":5,"unit_price":" 7 "},"is_quotation":"false"}',
        '{"quotation_data":{"quoted_price":"8623842","unit_price":"12d"},"is_quotation":true}',
        '{"quotation_data":null,"document_classification":"x","additional_items":{}}',
        '{"quotation_data":{"quoted_price":"NaN"},"additional_items":[{"item_name":"a","price":5}]}',
    ]
    frame = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    rows = responses.with_typed_answer(responses.parse_responses(frame)).drop("answer").orderBy("i").collect()
    offer = [r["quotation_data"] for r in rows]
    assert [o and o["quoted_price"] for o in offer] == [None, 8623842.0, None, None]
    assert offer[0]["unit_price"] == 7.0 and offer[1]["unit_price"] is None
    assert offer[0]["supplier_name"] == "5"
    assert [r["is_quotation"] for r in rows] == [False, True, False, False]
    assert rows[2]["document_classification"] is None and rows[2]["additional_items"] is None
    assert rows[3]["additional_items"][0]["price"] == "5"


# ---- checks ----


def test_supplier_match(evaluate):
    rows = [("Acme", "ACME Ltd"), ("acme ltd", "Acme"), ("a", "b"), ("", "b"), (None, "b"), ("a", None), ("a_", "axb")]
    expected = [True, True, False, None, None, None, False]
    assert evaluate(rows, "a string, b string", checks.supplier_match("a", "b")) == expected


def test_price_in_range(evaluate):
    rows = [(119.0, 100.0), (120.0, 100.0), (80.0, 100.0), (81.0, 100.0), (1.2, 1.0), (0.0, 100.0)]
    rows += [(None, 1.0), (1.0, None), (1.0, 0.0), (1.0, -5.0), (-100.0, 100.0)]
    expected = [abs(e - o) / o < 0.2 if e and o and o > 0 else None for e, o in rows]
    assert evaluate(rows, "e double, o double", checks.price_in_range("e", "o")) == expected
    assert expected[:5] == [True, False, False, True, True]


def test_price_text_is_cast_or_null(evaluate):
    rows = [("119", "100"), ("1,19", "100")]
    assert evaluate(rows, "e string, o string", checks.price_in_range("e", "o")) == [True, None]


def test_garbage_names(evaluate):
    names = [None, "", " \t", "As per attached", "REFER annexure", "preferred", "see Attached", "Pump 3"]
    expected = [True] * 7 + [False]
    assert evaluate([(n,) for n in names], "x string", checks.is_garbage("x")) == expected


def test_digits_are_ascii(evaluate):
    rows = [("a1",), ("a²",), ("",), (None,)]
    assert evaluate(rows, "x string", checks.has_digit("x")) == [True, False, False, False]


@pytest.mark.parametrize(
    ("ours", "stored", "garbage", "grade"),
    [
        (5, 100, True, "MAJOR"),
        (0, 0, True, "SAME"),
        (0, 15, True, "UNCLEAR"),
        (15, 10, False, "SAME"),
        (16, 10, False, "MINOR"),
        (30, 20, False, "UNCLEAR"),
        (29, 20, False, "SAME"),
        (31, 20, False, "MINOR"),
        (10, 20, False, "UNCLEAR"),
        (11, 20, False, "SAME"),
        (1, 0, False, "MINOR"),
    ],
)
def test_improvement(evaluate, ours, stored, garbage, grade):
    verdict = checks.improvement(F.col("a"), F.col("b"), F.col("g"))
    assert evaluate([(ours, stored, garbage)], "a int, b int, g boolean", verdict) == [grade]


def test_is_better(evaluate):
    verdict = checks.is_better(F.col("a"), F.col("d"), F.col("b"), F.col("g"))
    rows = [(5, True, 4, False), (5, False, 4, False), (4, True, 4, False), (0, False, 9, True)]
    assert evaluate(rows, "a int, d boolean, b int, g boolean", verdict) == [True, False, False, True]


def test_prices_that_are_no_numbers_are_not_checked(evaluate):
    inf, nan = float("inf"), float("nan")
    rows = [(1.0, nan), (nan, 1.0), (inf, 1.0), (1.0, inf), (1e308, 1.1e308), (0.0, 1.0), (-inf, 1.0)]
    found = evaluate(rows, "a double, b double", checks.price_in_range("a", "b"))
    assert found == [None, None, None, None, True, None, None]
