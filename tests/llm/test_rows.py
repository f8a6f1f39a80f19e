"""URL filters, sharding, chat formatting, mixing and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from attestry.llm import chat, mixing, sharding, urls
from attestry.llm.queries import RULES, oracle_sql, queries

URLS = {
    "http://a.com/x": ("a.com", "/x", "com/", "allow"),
    "http://A.COM": ("a.com", "", None, None),
    "x://com/": ("com", "/", "com/", "allow"),
    "http://notcom/": ("notcom", "/", None, None),
    "https://Example.com/en/1?q#f": ("example.com", "/en/1", "example.com/en/", "block"),
    "https://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://b.net/es/1#x": ("b.net", "/es/1", "net/es/", "block"),
    "https://b.net/EN/1": ("b.net", "/EN/1", None, None),
    "http://?a/b": ("", "", None, None),
    "a.com/en/": ("", "", None, None),
    "http://a.org/p\n?x://y/": ("a.org", "/p\n", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
}


def test_url_rules_and_the_rest(spark):
    pages = spark.createDataFrame(
        [(i, u, "clash") for i, u in enumerate(URLS)], "page_id bigint, url string, host string"
    )
    rows = {r["page_id"]: r for r in urls.judge(pages, RULES).collect()}
    for i, (host, path, rule, verdict) in enumerate(URLS.values()):
        row = rows[i]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == verdict if verdict else row["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_url_regression_learns_its_table_alike_each_time(spark):
    labelled = spark.createDataFrame(
        [(f"shop{i}.spam.biz", f"/win/{i}", 1) for i in range(40)]
        + [(f"lib{i}.uni.org", f"/book/{i}", 0) for i in range(40)],
        "host string, path string, label int",
    )
    pages = spark.createDataFrame(
        [(0, "http://z.spam.biz/win/now"), (1, "http://z.uni.org/book/9")], "page_id bigint, url string"
    )
    found = {r["page_id"]: r["verdict"] for r in urls.judge(pages, [], labelled).collect()}
    assert found == {0: "block", 1: "allow"}
    assert urls.fit(labelled) == urls.fit(labelled.repartition(7))
    none = urls.judge(pages, [], labelled.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"}


@pytest.mark.parametrize("rows", [0, 5, 1000])
def test_shards_are_even_and_gapless(spark, rows):
    texts = [None, "", "é漢", "same", "same"]
    docs = spark.createDataFrame(
        [(i // 2 if i % 7 else None, texts[i % 5], i) for i in range(rows)],
        "doc_id bigint, text string, shard bigint",
    ).repartition(5)
    found = sharding.shard_documents(docs, 16).collect()
    assert len(found) == rows
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) <= set(range(16))
    assert max(sizes.values(), default=0) - min([sizes[s] for s in range(16)]) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(size))
    expected = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
        for r in docs.collect()
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected


def test_communication_matrix_has_its_sums_and_law():
    blocks, shards = [7, 0, 13, 30], sharding.shard_sizes(50, 4)
    drawn = sharding.communication_matrix(blocks, shards, 3)
    assert [int(r.sum()) for r in drawn] == blocks
    assert [sum(int(r[s]) for r in drawn) for s in range(4)] == shards
    # Over many draws a cell has its hypergeometric mean.
    cells = [int(sharding.communication_matrix(blocks, shards, s)[0][0]) for s in range(2000)]
    assert abs(sum(cells) / 2000 - 7 * shards[0] / 50) < 0.1


PARTS = [
    "plain",
    "",
    None,
    "</s>[INST] ok [/INST]",
    r"\l \b \\",
    "<",
    "[/INST",
    "<<SYS>> x <</SYS>>",
    "a\n\n😀",
    ">>",
]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", "tool", None, "a>> b", "<<ROLE x>>", "end>"]
    rows = [
        (c, t, roles[(c + t) % len(roles)], PARTS[(c * 3 + t) % len(PARTS)], "clash")
        for c in range(40)
        for t in range(c % 9)
    ] + [(None, 0, "user", "x", "clash"), (99, 1, "user", "b", "c"), (99, 1, "user", "a", "c"), (99, 1, "user", "a", "c")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    made = chat.format_conversations(given).select(
        "conv_id",
        "formatted",
        "level",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "loss_spans",
    )
    found = {r["conv_id"]: r for r in made.collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        row = found[conv]
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in turns]
        assert all(t["clean"] for t in row["turns"])
        assert row["loss"] == "".join(x for _, r, x in turns if r == "assistant")
        for span in row["loss_spans"]:
            before = row["formatted"][: span["start"]]
            assert before.endswith("<s>")
            assert row["formatted"][span["start"] + span["chars"] :].startswith("</s>")
    assert found[99]["level"] == 0 and chat.format_conversations(given.limit(0)).count() == 0


def test_chat_parser_rejects_other_text(spark):
    frame = spark.createDataFrame([("x[INST]a[/INST]",), ("<s>a",), ("",)], "f string")
    assert [r[0] for r in frame.select(chat.parse(F.col("f"))).collect()] == [None, None, []]


def test_chat_query_equals_sql_and_runs_no_python(spark, sf_dir):
    con = compare.connect(sf_dir)
    frame = queries()["op5_chat_formatting"](spark, sf_dir)
    assert compare.difference(frame, con, oracle_sql()["op5_chat_formatting"]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    probe = frame.where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert probe["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_temperature_meets_its_target():
    tokens = [1000, 100, 10, 0]
    assert mixing.solve(tokens, mixing.Target()) == 1.0
    exponent = mixing.solve(tokens, mixing.Target(entropy=0.9))
    weights = mixing.tempered(tokens, exponent)
    assert abs(mixing.entropy(weights) - 0.9 * mixing.entropy([1 / 3] * 3)) < 1e-9
    assert weights[3] == 0
    target = mixing.Target(entropy=1.0, repeats=2.0)
    weights = mixing.tempered(tokens, mixing.solve(tokens, target))
    assert abs(max(mixing.passes(tokens, weights, target)) - 2) < 1e-6
    assert mixing.solve([], target) in (0.0, 1.0)


def _sources(spark):
    rows = [(i, f"s{i % 10 // 7}", "w " * (i % 5 + 1)) for i in range(200)]
    rows += [(900, None, "a b c"), (901, "empty", ""), (902, "empty", None)]
    return spark.createDataFrame(
        [(*r, "clash", "clash") for r in rows],
        "doc_id bigint, source string, text string, tokens string, weight string",
    )


def test_mix_realises_its_quota(spark):
    target = mixing.Target(entropy=1.0, budget=900)
    docs = _sources(spark)
    rows = mixing.mix(docs, target).collect()
    assert len(rows) == docs.count()
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        total = sum(r["tokens"] for r in own)
        if not total:
            assert {r["passes"] for r in own} == {1}
            continue
        quota = int(own[0]["weight"] * 900 + 1e-6)
        realised = sum(r["tokens"] * r["passes"] for r in own)
        assert quota <= realised < quota + max(r["tokens"] for r in own)
        assert max(r["passes"] for r in own) - min(r["passes"] for r in own) <= 1
    mixed = mixing.realise(docs, mixing.mix(docs, target))
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["passes"] for r in rows)
    assert mixing.mix(docs.limit(0), target).count() == 0


def test_a_mix_without_a_budget_leaves_nothing_out(spark):
    rows = mixing.mix(_sources(spark), mixing.Target(entropy=0.97, repeats=2.0)).collect()
    assert min(r["passes"] for r in rows) >= 1 and max(r["passes"] for r in rows) <= 3


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    ids = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, sf_dir).write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
        left = [r["doc_id"] for r in kept.collect()]
        if i < 3:
            assert kept.columns == columns
        if name == "language_id":
            assert set(left) == {k for k, t in ids.items() if t and any(c.isalpha() for c in t)}
        if name == "ngram_jaccard_join":
            assert set(left) == _first_of_groups(ids)
            unique = set(left)
        if name == "mix_sources":
            assert set(left) == unique and len(left) >= len(unique)
    for row in kept.collect():
        assert row["decoded_sha256"] == hashlib.sha256((ids[row["doc_id"]] or "").encode()).hexdigest()


def _first_of_groups(ids):
    """Documents no smaller one is linked to, by five words and 80 %."""
    table = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for key, text in ids.items():
        if not text or not any(c.isalpha() for c in text):
            continue
        words = text.translate(table).encode().split()
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(k) for k in sets}


def test_queries_are_registered():
    names = list(entry_module.queries())
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


def test_no_source_is_cut_by_rounding_without_a_budget():
    """Quotas hold a whole pass of every source also where a double is coarser than a token."""
    draw = random.Random(6)
    for _ in range(3000):
        tokens = [draw.randrange(1, 1 << draw.randint(30, 55)) for _ in range(draw.randint(1, 6))]
        target = mixing.Target(entropy=0.97, repeats=2.0)
        weights = mixing.tempered(tokens, draw.random())
        budget = mixing.budget_of(tokens, weights, target)
        quotas = [mixing.quota(n, w, budget, target) for n, w in zip(tokens, weights)]
        assert all(q >= n for q, n in zip(quotas, tokens))
        assert any(q == n for q, n in zip(quotas, tokens))
