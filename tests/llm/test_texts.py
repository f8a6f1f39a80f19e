"""Language, tokens and fingerprints against plain computations of the same thing."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from attestry.llm import bpe, edit_embedding, language, unigram
from attestry.llm.queries import vocabulary

SCHEMA = "doc_id bigint, text string, lang string, score string, n_tokens string"
ODD = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "don't  stop",
    "12345 !!",
    "é漢字 مرحبا😀",
    "x" * 3000,
    " a  b\t\nc ",
    "The same words again and again.",
    "The same words again and again.",
]


def _docs(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else None, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    import tiktoken

    path, pattern = vocabulary()
    with open(path, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _random_texts(count):
    draw = random.Random(3)
    alphabet = "aeiothnsr éñ漢字مر\n\t  12'sÇ😀ßtheing-_=/\x1c\x85\u3000"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(count)]


def test_bpe_equals_the_library_and_decodes_to_the_text(spark, tokenizer):
    texts = ODD + _random_texts(400)
    found = bpe.encode_decode(_docs(spark, texts), *vocabulary(), outputs=tuple(o for o in bpe.OUTPUTS if o != "n_tokens"))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = tokenizer.encode_ordinary(text or "")
        packed = b"".join(t.to_bytes(4, "little") for t in ids)
        assert rows[i]["ids"] == ids
        assert rows[i]["decoded"] == (text or "")
        assert rows[i]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_counts_and_refuses_a_clashing_key(spark, tokenizer):
    rows = bpe.encode_decode(_docs(spark, ODD), *vocabulary(), outputs=("n_tokens",)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        i: len(tokenizer.encode_ordinary(t or "")) for i, t in enumerate(ODD)
    }
    with pytest.raises(ValueError):
        bpe.encode_decode(_docs(spark, ODD), *vocabulary(), key="n_tokens")
    assert bpe.encode_decode(_docs(spark, []), *vocabulary()).count() == 0


def test_transducer_with_a_full_memory(monkeypatch, tokenizer):
    for name in ("MAX_STATES", "MAX_PAIRS", "MAX_PIECES", "MAX_CHUNKS"):
        monkeypatch.setattr(bpe, name, 5)
    with open(vocabulary()[0], "rb") as file:
        chunks, _ = bpe.machinery(file.read(), vocabulary()[1])
    for text in _random_texts(200):
        chunks.prepare([text])
        packed = chunks.encode(text)
        ids = [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]
        assert ids == tokenizer.encode_ordinary(text)


def test_long_text_in_parts(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "CHUNK", 7)
    with open(vocabulary()[0], "rb") as file:
        chunks, tokens = bpe.machinery(file.read(), vocabulary()[1])
    text = "Some  words é漢 \n\n and 'll more. " * 20
    packed = chunks.encode(text)
    ids = [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]
    assert ids == tokenizer.encode_ordinary(text)
    assert "".join(t for _, t in bpe.decode_ids(ids, tokens)) == text


def test_utf8_machine_at_every_cut():
    data = "aé漢😀ß".encode()
    for size in range(1, len(data) + 1):
        machine = bpe.Utf8Machine()
        parts = [machine.feed(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + machine.finish() == data.decode()
    machine = bpe.Utf8Machine("replace")
    assert machine.feed(b"\xe6") + machine.finish() == "\ufffd"


def _segment(piece: bytes, costs):
    best = [(0, 0)]
    for end in range(1, len(piece) + 1):
        best.append(
            min(
                (best[s][0] + costs[piece[s:end]], best[s][1] + 1)
                for s in range(end)
                if piece[s:end] in costs
            )
        )
    return best[-1]


def test_unigram_counts_equal_plain_segmentation(spark):
    import regex

    path, pattern = vocabulary()
    texts = [t if t is None or len(t) < 500 else t[:80] for t in ODD] + _random_texts(60)
    with open(path, "rb") as file:
        costs = unigram.rank_costs(bpe.parse_ranks(file.read()))
    rows = {r["doc_id"]: r for r in unigram.count_tokens(_docs(spark, texts), path, pattern).collect()}
    for i, text in enumerate(texts):
        found = [_segment(p.encode(), costs) for p in regex.findall(pattern, text or "")]
        assert rows[i]["n_pretokens"] == len(found)
        assert rows[i]["n_tokens"] == sum(n for _, n in found)
        assert rows[i]["cost"] == sum(c for c, _ in found)
    assert unigram.count_tokens(_docs(spark, []), path, pattern).count() == 0


def test_unigram_model_must_cover_bytes():
    with pytest.raises(ValueError):
        unigram.Trie({b"a": 1})


def test_grams_of_words_and_parts(monkeypatch):
    from collections import Counter

    grams = language.Grams()

    def plain(text):
        found, words, word = Counter(), [], ""
        for c in text.lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                words.append(word)
                word = ""
        for w in words:
            found.update(w)
        joined = "\x01" + "\x01".join(words) + "\x01"
        found.update(joined[i : i + 2] for i in range(len(joined) - 1))
        found.update(joined[i : i + 3] for i in range(len(joined) - 2) if joined[i + 1] != "\x01")
        return {k: n for k, n in found.items() if k != "\x01"}

    def name(code):
        return "".join(chr(c) for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c)

    for part in (language.PART, 4):
        monkeypatch.setattr(language, "PART", part)
        for text in ("Ab b!", "don't 12 STOP,now", "é漢字 x", "a", "  a b c d e f g  "):
            codes, counts = grams.counts(text)
            assert {name(c): n for c, n in zip(codes.tolist(), counts.tolist())} == plain(text), text
    assert len(grams.counts("12 !")[0]) == 0 and len(grams.counts(None)[0]) == 0


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    unseen = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.95 * len(unseen)


def test_language_odd_cases(spark):
    texts = [*ODD, "hello the there", "über die brücke"]
    langs = [None] * len(ODD) + ["en", "de"]
    rows = {r["doc_id"]: r for r in language.identify(_docs(spark, texts, langs)).collect()}
    for i in (0, 1, 2, 3, 6):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[10]["lang_pred"] == rows[11]["lang_pred"] != "und"
    assert language.identify(_docs(spark, [])).count() == 0
    nothing = language.identify(_docs(spark, ["words"])).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_edit_probe_equals_plain_order(spark):
    texts = ODD[:8] + ["z" * 40, "abc" * 50, "abd" * 50]
    rows = {r["doc_id"]: r for r in edit_embedding.edit_probe(_docs(spark, texts)).collect()}
    assert len(rows) == len(texts)
    prints = edit_embedding.embed([t or "" for t in texts])
    likeness = edit_embedding.Likeness()
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        part = len(text) // 3
        changed = text[: len(text) - part] + following[:part]
        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert rows[i]["fingerprint"] == prints[i]
        assert rows[i]["near_next"] == likeness(prints[i], prints[i - 1])
        assert 0 <= rows[i]["near_edited"] <= 1
    assert edit_embedding.edit_probe(_docs(spark, [])).count() == 0


def test_edit_embedding_tells_near_from_far(spark):
    draw = random.Random(4)
    base = "".join(draw.choice("abcdefgh ") for _ in range(2000))
    other = "".join(draw.choice("abcdefgh ") for _ in range(2000))
    near = base[:700] + "x" + base[701:1200] + base[1203:]
    likeness = edit_embedding.Likeness()
    a, b, c, d = edit_embedding.embed([base, near, other, ""])
    assert likeness(a, a) == 1 and likeness(d, a) == 0 and likeness(d, d) == 1
    assert likeness(a, b) > 0.8 > 0.4 > likeness(a, c)
    docs = _docs(spark, [base, near, other, base, None, ""])
    prints = edit_embedding.fingerprint(docs)
    groups = {r["fingerprint"]: r["near_group"] for r in edit_embedding.near_groups(prints).collect()}
    assert [groups[p] for p in (a, b, c, d)] == [0, 0, 2, 4]


@pytest.mark.parametrize("block", [4, 512])
def test_near_groups_equal_brute_force(spark, monkeypatch, block):
    draw = random.Random(12)
    letters = "abcdefghij é"

    def changed(text, edits):
        chars = list(text)
        for _ in range(edits):
            chars[draw.randrange(len(chars))] = draw.choice(letters)
        return "".join(chars)

    base = "".join(draw.choice(letters) for _ in range(700))
    texts = [None, "", base, base, "a" * 170, "a" * 171, "short", "short", "shorter"]
    for _ in range(60):  # near copies in chains
        texts.append(changed(base, draw.randint(0, 12)))
        if draw.random() < 0.3:
            base = texts[-1]
    for size in (80, 83, 84, 90, 340, 343, 345):  # on both sides of steps of the level
        own = "".join(draw.choice(letters) for _ in range(size))
        texts += [own, own + "z", changed(own, 2)]
    keys = list(range(len(texts)))
    draw.shuffle(keys)
    rows = [*zip(keys, texts), (None, texts[2]), (None, "nobody else"), (3, texts[12])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = edit_embedding.fingerprint(docs).cache()
    found = {r["fingerprint"]: r["near_group"] for r in edit_embedding.near_groups(prints, block=block).collect()}
    prints_ = edit_embedding.embed([t or "" for _, t in rows])
    likeness, places = edit_embedding.Likeness(), edit_embedding.band_places(16, 6)
    bands = {p: set(edit_embedding.bands_of(p, places, likeness)) for p in set(prints_)}
    group = {p: {p} for p in bands}
    for p in bands:
        for q in bands:
            if p < q and bands[p] & bands[q] and likeness(p, q) >= 0.8 and group[p] is not group[q]:
                group[p] |= group[q]
                for member in group[q]:
                    group[member] = group[p]
    least = {}
    for (key, _), p in zip(rows, prints_):
        name = min(group[p])
        if key is not None:
            least[name] = min(key, least.get(name, key))
    assert found == {p: least.get(min(group[p])) for p in bands}
    assert len(set(map(id, group.values()))) < len(bands) - 40


def test_fingerprints_of_one_text_in_any_company():
    texts = ["ab" * n for n in (1, 50, 400, 3000)]
    alone = [edit_embedding.embed([t])[0] for t in texts]
    assert edit_embedding.embed(texts) == alone


def test_texts_are_split_once_and_chunks_in_use_survive(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "MAX_CHUNKS", 3)
    monkeypatch.setattr(bpe, "SPLIT", 40, raising=False)
    with open(vocabulary()[0], "rb") as file:
        chunks, _ = bpe.machinery(file.read(), vocabulary()[1])
    encoded, encode = [], chunks.pieces.transducer.encode
    chunks.pieces.transducer.encode = lambda piece: encoded.append(piece) or encode(piece)
    chunks.prepare(["a qwzu trlk mnop"])
    encoded.clear()
    chunks.prepare(["a qwzu trlk vxyj"])
    assert encoded == [b" vxyj"]
    texts = ["", *_random_texts(60)]
    found = [
        [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]
        for packed in chunks.encode_all(texts)
    ]
    assert found == [tokenizer.encode_ordinary(text) for text in texts]
