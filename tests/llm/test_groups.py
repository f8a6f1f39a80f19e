"""Joins and near duplicates against brute force, on groups of copies and odd rows."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestry.llm import jaccard_join, near_vectors
from attestry.llm.components import connected


def _roots(count, links):
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def _texts():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(draw.choice(words) for _ in range(25))
    texts = [None, "", " \t\n", "one", "One", "two words", "a b c d", "A b C d", "é É a b"]
    base = [draw.choice(words) for _ in range(90)]
    for _ in range(60):  # one large group of near copies, linked in chains
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        texts.append(" ".join(copy))
        if draw.random() < 0.2:
            base = copy
    for _ in range(60):  # a passage that unlike texts share
        own = [draw.choice(words) for _ in range(draw.randint(3, 80))]
        texts.append(" ".join(own[:2]) + " " + passage + " " + " ".join(own[2:]))
    return texts + [texts[20]] * 15


def test_components_equal_brute_force(spark, monkeypatch):
    texts = _texts()

    def shingles(text):
        table = {i: i + 32 for i in range(65, 91)}
        words = (text or "").translate(table).encode().split()
        if len(words) < 4:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}

    sets = [shingles(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    expected = _roots(len(texts), links)
    docs = spark.createDataFrame(
        [(i, t, "clash", "clash") for i, t in enumerate(texts)],
        "doc_id bigint, text string, component_id string, set_id string",
    )
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rows = {r["doc_id"]: r for r in jaccard_join.components(docs).collect()}
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [rows[i]["component_id"] for i in range(len(texts))] == expected


def test_components_go_by_rows_not_by_keys(spark):
    """Rows that share an id, or have none, keep their own texts and links."""
    base = [f"word{i}" for i in range(40)]
    other = [f"else{i}" for i in range(40)]
    a, b, c = " ".join(base), " ".join(other), " ".join(f"third{i}" for i in range(40))
    rows = [(1, a), (1, b), (3, " ".join(other[1:])), (None, c), (4, c.rsplit(" ", 1)[0]), (None, "alone here"), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(jaccard_join.components(docs).select("doc_id", "component_id").collect(), key=str)
    assert [tuple(r) for r in found] == sorted(
        [(1, 1), (1, 1), (3, 1), (None, 4), (4, 4), (None, None), (None, None), (5, 5)], key=lambda r: str(spark_row(r))
    )


def spark_row(values):
    from pyspark.sql import Row

    return Row(doc_id=values[0], component_id=values[1])


def test_long_words_that_a_sum_cannot_tell_apart(spark):
    """Two words whose letters are summed to the same number, by the order of Thue and Morse."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one = "".join("ab"[x] for x in bits)
    two = "".join("ba"[x] for x in bits)
    words = jaccard_join.Words()
    assert words(one)[0] != words(two)[0] and words(one.upper())[0] == words(one)[0]
    docs = spark.createDataFrame([(1, one), (2, two), (3, one + " x"), (4, "y " + one.upper())], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(docs).collect()}
    assert rows == {1: 1, 2: 2, 3: 3, 4: 4}


def test_pipeline_stages_go_by_rows(spark, tmp_path):
    """Nulls, repeated ids and rows, clashing columns: no unlike text is dropped, no copy stays."""
    import corpus_pipeline

    a, b, c, d, e = (" ".join(f"{x}{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}" for i in range(30)) for x in "vwxyz")
    rows = [(1, a, "en"), (1, b, "en"), (None, c, "de"), (None, d, None), (5, e, "en"), (6, e, "en"), (6, e, "en"), (7, a, "en")]
    rows += [(8, None, "en"), (None, "", "en"), (9, "12 34 !", "de"), (None, c, "de"), (5, "... 7", "en"), (5, e.upper(), "en")]
    docs = spark.createDataFrame([(*r, "s", 1, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string")
    known = corpus_pipeline.known_language(spark, docs, "")
    assert known.columns == docs.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in known.collect()), key=str)
    assert texts == sorted(((r[0], r[1]) for r in rows if any(x.isalpha() for x in r[1] or "")), key=str)
    kept = corpus_pipeline.no_near_copies(spark, docs, "")
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    one = min(e, e.upper(), key=lambda t: __import__("hashlib").sha256(t.encode()).digest())
    assert left == sorted(
        [(1, a), (1, b), (None, c), (None, d), (5, one), (8, None), (None, ""), (9, "12 34 !"), (5, "... 7")], key=str
    )


def test_components_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.components(docs).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_similar_sets_share_a_possible_signature(percent):
    """The guarantee of the prefixes, whatever shingles are frequent."""
    draw = np.random.default_rng(2)
    for _ in range(300):
        size = int(draw.integers(2, 400))
        a = np.unique(draw.integers(0, 1 << 62, size).astype(np.uint64))
        lost = int(draw.integers(0, max(1, size // 6) + 1))
        fresh = draw.integers(0, 1 << 62, int(draw.integers(0, lost + 1))).astype(np.uint64)
        b = np.unique(np.r_[draw.permutation(a)[lost:], fresh])
        shared = len(np.intersect1d(a, b))
        if not shared or 100 * shared < percent * (len(a) + len(b) - shared) or np.array_equal(a, b):
            continue
        union = np.union1d(a, b)
        frequent = np.sort(draw.permutation(union)[: int(draw.integers(0, len(union) + 1))])
        ranks = draw.permutation(len(frequent))
        found = [dict() for _ in range(2)]
        for own, side in zip((a, b), found):
            for key, need in zip(*jaccard_join.signatures(own, ranks, frequent, percent)):
                side[key] = min(need, side.get(key, need))
        assert any(
            jaccard_join.possible(len(a), len(b), found[0][key], found[1][key], percent)
            for key in found[0].keys() & found[1].keys()
        )


@pytest.mark.parametrize("percent", [80, 85])
def test_members_of_a_bucket_meet_only_where_sizes_and_prefixes_allow(spark, monkeypatch, percent):
    """All possible pairs of different components meet; guests do not go to every block."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    draw = random.Random(3)
    rows = []
    for i in range(600):
        size = draw.randint(100, 110) if i % 2 else draw.randint(10, 2000)
        need = draw.randint(1, jaccard_join.losses(size, percent) + 1)
        rows.append((7, i, size, need, 0 if i % 5 == 0 else i, 0))
    members = spark.createDataFrame(
        rows, "key bigint, set_id bigint, size int, need int, root bigint, hub bigint"
    )
    buckets = spark.createDataFrame([(7, 0, len(rows))], "key bigint, _largest bigint, _rows bigint")
    met, guests = set(), 0
    groups = {}
    for r in jaccard_join.dealt(jaccard_join.in_blocks(members, buckets, percent)).collect():
        groups.setdefault(r["pair"], []).append((r["side"], r["set_id"]))
        guests += r["side"] == 1
    for group in groups.values():
        hosts = [i for side, i in group if side != 1]
        assert len(hosts) <= 48
        among = [(a, b) for a in hosts for side, b in group if side != 0]
        met |= {(min(x), max(x)) for x in among}
    for (_, a, size_a, need_a, root_a, _), (_, b, size_b, need_b, root_b, _) in itertools.combinations(rows, 2):
        if root_a != root_b and jaccard_join.possible(size_a, size_b, need_a, need_b, percent):
            assert (a, b) in met
    everywhere = sum(r[4] != 0 for r in rows) * -(-len(rows) // 16)
    assert guests < everywhere / 4


def test_sketches_join_the_dealt_rows_last(spark):
    members = spark.createDataFrame(
        [(k, i, 100, 3, i, 0) for k in range(3) for i in range(20)],
        "key bigint, set_id bigint, size int, need int, root bigint, hub bigint",
    )
    buckets = members.groupBy("key").agg(F.max("root").alias("_largest"), F.count("*").alias("_rows"))
    rows = jaccard_join.dealt(jaccard_join.in_blocks(members, buckets, 85))
    assert "sketch" not in rows.columns
    bins = bytes([1] * 100 + [0] * (jaccard_join.BINS - 100))
    sketches = spark.createDataFrame([(i, bytearray(bins)) for i in range(20)], "set_id bigint, sketch binary")
    found = jaccard_join.block_pairs(members, sketches, 85, forest=False)
    pairs = {(r["a"], r["b"]) for r in found.where("a is not null").collect()}
    assert pairs == {(a, b) for a in range(1, 20) for b in range(a + 1, 20)}


def test_connected_on_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 300)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in connected(frame).collect()}
    assert roots == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(80)}


def _vectors():
    draw = np.random.default_rng(5)
    rows = [list(map(float, v)) for v in draw.standard_normal((150, 16))]
    center = draw.standard_normal(16)
    rows += [list(map(float, center + 0.05 * draw.standard_normal(16))) for _ in range(60)]
    rows += [list(map(float, np.array(rows[i]) + 0.05 * draw.standard_normal(16))) for i in range(30)]
    rows += [rows[0]] * 4 + [[2 * x for x in rows[1]]]
    return rows + [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rows = _vectors()
    frame = spark.createDataFrame(
        [(i, v, "clash", "clash") for i, v in enumerate(rows)],
        "vec_id bigint, embedding array<double>, id string, n_links string",
    )
    found = {r["vec_id"]: r for r in near_vectors.near_duplicates(frame).collect()}
    good = [i for i, v in enumerate(rows) if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i] for i in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    links = [(good[i], good[j]) for i, j in zip(*np.nonzero(near)) if i != j]
    expected = _roots(len(rows), links)
    counts = [sum(a == i for a, _ in links) for i in range(len(rows))]
    assert [found[i]["n_links"] for i in range(len(rows))] == counts
    assert [found[i]["component_id"] for i in range(len(rows))] == expected
    assert all(found[i]["kept"] == (expected[i] == i) for i in range(len(rows)))


def _linked(x):
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    return near.sum(axis=1).tolist(), _roots(len(x), list(zip(*np.nonzero(near))))


def _two_groups():
    """Two groups with more near members each than a list holds, and all links across."""
    draw = np.random.default_rng(3)
    axes = np.linalg.qr(draw.standard_normal((32, 32)))[0]
    turn = 0.37
    centers = [axes[0], np.cos(turn) * axes[0] + np.sin(turn) * axes[1]]
    x = np.concatenate([c + 0.01 * draw.standard_normal((30, 32)) for c in centers])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("block", [8, 128])
def test_links_between_dense_groups_count(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    x = _two_groups()
    counts, roots = _linked(x)
    assert (x[:30] @ x[30:].T).min() >= 0.9 and set(counts) == {59}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {r["vec_id"]: r for r in near_vectors.near_duplicates(frame).collect()}
    assert [found[i]["n_links"] for i in range(len(x))] == counts
    assert [found[i]["component_id"] for i in range(len(x))] == roots


def test_audit_goes_on_and_reports(spark, monkeypatch):
    """Links of short lists that two descents lose beside a hot group come back; a missed target raises."""
    draw = np.random.default_rng(4)
    hot = draw.standard_normal(16) + 0.02 * draw.standard_normal((25, 16))
    some = draw.standard_normal((20, 16))
    x = np.concatenate([hot, some, some + 0.02 * draw.standard_normal((20, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    descend, calls = near_vectors.descend, []

    def losing(nodes, lists, limit, count, *rest):
        calls.append(limit)
        made = descend(nodes, lists, limit, count, *rest)
        many = made.where("sim >= 0.9").groupBy("u").count().where("count >= 10").select("u")
        return made.join(many, "u", "left_semi") if len(calls) < 3 else made

    monkeypatch.setattr(near_vectors, "descend", losing)
    found = {r["vec_id"]: r for r in near_vectors.near_duplicates(frame).collect()}
    counts, roots = _linked(x)
    assert [found[i]["n_links"] for i in range(len(x))] == counts
    assert [found[i]["component_id"] for i in range(len(x))] == roots
    monkeypatch.setattr(near_vectors, "AUDITS", 1)
    calls.clear()
    with pytest.raises(RuntimeError, match="recall"):
        near_vectors.near_duplicates(frame)


def test_near_vectors_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert near_vectors.near_duplicates(frame).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_spanning_pairs_connect_what_all_pairs_connect(seed):
    from attestry.llm.jaccard_join import spanning

    rng = np.random.default_rng(seed)
    left, right = rng.integers(0, 60, (2, 80))
    apart = left != right
    left, right, weight = left[apart], right[apart], rng.integers(0, 4, apart.sum())

    def roots(places):
        root = {int(x): int(x) for x in np.concatenate([left, right])}
        changed = True
        while changed:
            changed = False
            for i in places:
                least = min(root[int(left[i])], root[int(right[i])])
                for x in (int(left[i]), int(right[i])):
                    changed |= root[x] != least
                    root[x] = least
        return root

    few = spanning(left, right, weight)
    assert roots(few) == roots(range(len(left)))
    assert len(few) < len(left)


def test_word_hashes_do_not_depend_on_pieces():
    """Words are the same wherever they stand, also at the ends of pieces and beyond them."""
    long = jaccard_join.PIECE
    texts = [
        "", " \t\n", "a", "A a", "a\x0bb\x1cc", "é É ß", "x" * (long - 1), "x" * long, "x" * long + " y",
        "y " + "X" * long, "y " * 20000 + "x" * long + " y y z", " " * (3 * long), " " * long + "z",
        "x" * (long - 1) + " " + "x" * (long - 1) + " b c", ("é" * 3 * long + " ") * 2 + "z",
    ]
    words, names = jaccard_join.Words(), {}
    for text in texts:
        expected = text.encode().lower().split()
        hashes = words(text).tolist()
        assert len(hashes) == len(expected)
        for word, value in zip(expected, hashes):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_places_of_words_count():
    shingles = jaccard_join.Shingles(8)
    made = {tuple(shingles(" ".join(words)).tolist()) for words in itertools.product("ab", repeat=8)}
    assert len(made) == 2**8


def test_members_meet_their_places_in_one_join(spark):
    """Rows of crowded buckets are joined once; before, once for their counts and twice for themselves."""
    members = spark.createDataFrame(
        [(7, i, 100, 3, i, 0) for i in range(700)],
        "key bigint, set_id bigint, size int, need int, root bigint, hub bigint",
    )
    buckets = spark.createDataFrame([(7, 0, 700)], "key bigint, _largest bigint, _rows bigint")
    placed = jaccard_join.in_blocks(members, buckets, 85)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2  # reaches with their bucket, members with their reach
    rows = placed.collect()
    assert len(rows) == 700 and {r["inner"] for r in rows if r["root"] == 0} == {True}
    assert sum(r["inner"] for r in rows) == 1 and {r["block"] for r in rows} == {0, 1}
