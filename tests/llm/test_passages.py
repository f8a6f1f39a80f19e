"""Hard negatives, removal of repeats and collocations against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from attestry.llm import collocations, hard_negatives, suffix_dedup

# ---- hard negatives ----


def _hard_negatives(rows, every, positives, negatives, low, high):
    import math

    held = []
    for number, (key, label, vector) in enumerate(rows):
        if key is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((number, key, label, [math.floor(256 * x) for x in vector]))
    out = []
    for number, key, label, q in held:
        if key % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, other)), k, other_label == label)
            for n, k, other_label, other in held
            if n != number
        )
        same = [(-s, k) for s, k, alike in scored if alike][:positives]
        unlike = [(-s, k) for s, k, alike in scored if not alike]
        for p, positive in same:
            fit = [(s, k) for s, k in unlike if low * p <= 100 * s <= high * p][:negatives]
            out += [(key, positive, i + 1, k, p, s) for i, (s, k) in enumerate(fit)]
    return sorted(out)


SCHEMA = "vec_id bigint, label int, embedding array<float>, member int, score string"


def _vector_rows():
    draw = random.Random(5)
    rows = []
    for i in range(400):
        centre = i % 3
        vector = [draw.gauss(1.0 if d % 3 == centre else 0.0, 0.6) for d in range(8)]
        rows.append((i, draw.randrange(4), vector))
    common = [0.5] * 8
    rows += [(1000 + i, i % 3, common) for i in range(150)]  # a vector many rows share
    rows += [(10, 1, common), (10, 1, common), (20, 2, rows[20][2])]  # repeated keys
    rows += [(2000, None, common), (2001, 1, None), (None, 1, common), (2010, 1, [0.0] * 8)]
    rows += [(2020, 2, [float("nan")] * 8), (2030, 2, [float("inf")] + [0.0] * 7), (2040, 2, [None] * 8)]
    rows += [(2050, 3, [-x for x in common]), (2060, 3, [1.0, 1.0]), (2070, 3, [])]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:  # many clusters, segments and blocks
        monkeypatch.setattr(hard_negatives, "ANCHORS_PER_CLUSTER", 8)
        monkeypatch.setattr(hard_negatives, "FIRST_SEGMENT", 16)
        monkeypatch.setattr(hard_negatives, "GROWTH", 3)
        monkeypatch.setattr(hard_negatives, "LIST_BLOCK", 50)
        monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 5)
        monkeypatch.setattr(hard_negatives, "STEP", 7)
    rows = _vector_rows()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = hard_negatives.mine(frame, anchor_every=10, negatives=4)
    assert sorted(tuple(r) for r in found.collect()) == _hard_negatives(rows, 10, 5, 4, 30, 90)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty).collect() == []
    no_anchor = spark.createDataFrame([(1, 1, [1.0], 0, ""), (2, 2, [1.0], 0, "")], SCHEMA)
    assert hard_negatives.mine(no_anchor).collect() == []


def test_scores_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(100, 1, [1e30], 0, "")], SCHEMA)
    with pytest.raises(ArithmeticError):
        hard_negatives.mine(frame)


# ---- repeats ----


def _without_repeats(rows, length):
    """Rows in the order of documents; every string is looked up among all earlier ones."""
    given = [(i, d, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    given.sort(key=lambda r: (r[1] is None, r[1] or 0, hashlib.sha256(r[2]).digest()))
    seen, out = set(), []
    for _, doc_id, text in given:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            string = text[i : i + length]
            if string in seen:
                gone[i : i + length] = [True] * length
            seen.add(string)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _texts(seed, length):
    draw = random.Random(seed)
    words = ["é", "ab", "ba", "the", "of", "é" * 3, "x", "yy", "zzz"] + [f"w{i}" for i in range(40)]
    passage = " ".join(draw.choice(words) for _ in range(length))
    texts = [None, "", "a", "a" * (3 * length), "ab" * (2 * length), "a" * (length - 1), "é" * length]
    base = [draw.choice(words) for _ in range(3 * length)]
    for _ in range(25):
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        texts.append(" ".join(copy))
    for _ in range(25):
        own = [draw.choice(words) for _ in range(draw.randint(0, 2 * length))]
        texts.append(" ".join(own) + draw.choice(["", " "]) + passage[draw.randint(0, 9) :] + " ".join(own[::-1]))
    texts += [texts[10]] * 6 + [passage * 3]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [(None, texts[10]), (None, texts[12] + "q"), (3, passage), (3, passage), (4, passage + "b"), (4, "b" + passage)]


DOCS = "doc_id bigint, text string, rank int, digest string, block string"


@pytest.mark.parametrize(("length", "hot"), [(100, 8192), (100, 4), (20, 8192), (20, 3), (7, 9), (1, 5), (2, 100)])
def test_removal_equals_brute_force(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffix_dedup, "SLICE", 137)
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "SOLVE_ROWS", 30)
    monkeypatch.setattr(suffix_dedup, "REMEMBERED", 200)
    rows = _texts(length, max(4, length // 3))
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS).repartition(3)
    found = suffix_dedup.remove_repeats(frame, length, hot=hot, block_bytes=2000)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(_without_repeats(rows, length), key=key)


def test_a_long_text_and_an_empty_table(spark):
    draw = random.Random(2)
    part = "".join(draw.choice("abcdefgh ") for _ in range(400))
    long = "".join(draw.choice("abcdefgh ") for _ in range(300_000)) + part + "|" + part
    frame = spark.createDataFrame([(1, long, 0, "", ""), (2, part, 0, "", "")], DOCS)
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame).collect()}
    assert found[1]["n_removed"] == 400 and found[1]["n_spans"] == 1 and found[2]["n_removed"] == 400
    spans = suffix_dedup.repeated_spans(frame).orderBy("doc_id").collect()
    assert [tuple(r) for r in spans] == [(1, 300_401, 300_801), (2, 0, 400)]
    assert suffix_dedup.remove_repeats(frame.limit(0)).collect() == []


# ---- collocations ----


def _collocations(rows, min_count, top):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        covered = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 80 * f[p[i : i + k]]:
                        covered.add(p[i : i + k])
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, cut = min((2_000_000 * a // (f[p[:c]] + f[p[c:]]), c) for c in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("flush", [40, 1000, 1 << 22])
def test_collocations_equal_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(collocations, "FLUSH_BYTES", flush)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 3000)
    draw = random.Random(11)
    words = ["the", "of", "The", "é", "É", "new", "york", "city", "a\x0bb", "x;y", " ", "-", "it's"] + [f"w{i}" for i in range(12)]
    rows = [(None, "en"), ("", "en"), (" \t", None), ("new york city hall " * 30, "de"), ("...", "fr"), ("one", None)]
    for _ in range(120):
        picked = [draw.choice(words) for _ in range(draw.randint(1, 60))]
        if draw.random() < 0.5:
            picked += ["new", "york", "city", "of", "the"]
        text = "".join(w + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for w in picked)
        rows.append((text, draw.choice(["en", "en", "de", None, "und"])))
    rows += [rows[10]] * 5
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "text string, lang string, k int, phrase string").repartition(3)
    for top in (2000, 7):
        found = collocations.mine(frame, min_count=6, top=top)
        assert sorted(tuple(r) for r in found.collect()) == _collocations(rows, 6, top)


def test_collocations_of_nothing(spark):
    frame = spark.createDataFrame([(None, "en"), ("a b", "en")], "text string, lang string")
    assert collocations.mine(frame).collect() == []
    assert collocations.mine(frame.limit(0)).collect() == []


def test_copies_of_a_text_are_not_sorted_before_they_are_sent(spark, monkeypatch):
    """Texts are sorted once, where they meet their owner; other copies end there."""
    plans, stored = {}, suffix_dedup.stored

    def watched(frame, label):
        plans[label] = frame._jdf.queryExecution().executedPlan().toString()
        return stored(frame, label)

    monkeypatch.setattr(suffix_dedup, "stored", watched)
    text = " ".join(str(i) for i in range(60))
    rows = [(i, text) for i in (3, 1, 1, 2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["n_removed"] == r["n_bytes"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert found == {(1, False), (1, True), (2, True), (3, True), (None, True)}
    below = plans["texts"].split("Join", 1)[1]
    assert "Aggregate" not in below
