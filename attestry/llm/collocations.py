"""Phrase collocations from a weighted graph of overlapping word sequences.

At every word of a piece starts one sequence: the word and up to three more, fewer
at the end of the piece. A full one is an edge of a de Bruijn graph, from the node
of its first three words to that of its last three, weighted by how often it
occurs; the shorter ones are the ends of pieces. A phrase of one to three words
occurs as often as the sequences that begin with it: the flow out of its node, plus
the piece ends there. So only the longest sequences are counted, once per
position, and every shorter count is derived from them.

Sequences are counted inside each task first. Their keys are numbers of words in a
dictionary that travels with them, one row for each bucket of nodes, so what is
shuffled are few rows of packed columns. A bucket holds all edges out of its nodes:
sorted by their words, the edges of one node lie next to each other, and a sum over
each run gives its flow. A node with one way on (a unary path) is one run, whatever
its weight. The pairs that begin its nodes leave a bucket packed, with the part of
their flow that it saw, and are summed up in buckets of pairs: a pair that begins a
third of all sequences is one entry per bucket. Single words are summed likewise.

Only phrases that reach the least count leave the buckets; parts of a phrase occur
at least as often as the phrase, so all that scores need is among them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import stored

UNKNOWN_LANG = "und"
LONGEST = 4
# Text that a task counts at once, and text whose sequences one bucket is meant for.
FLUSH_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
# What ends a piece, and what parts words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
_PACKED = "lang string, bucket int, kind int, words binary, ids binary, counts binary"
_COUNTED = f"k int, phrase string, f bigint, {_PACKED}"
# Kinds of packed rows: counts of words, of pairs, of sequences.
WORDS, PAIRS, EDGES = 1, 2, 4


def count_phrases(docs: DataFrame, min_count: int = 30) -> DataFrame:
    """(lang, k, phrase, f): all phrases of 1 to 4 words with f >= ``min_count``.

    Rows with k = 0 hold counts of all words; their sum by lang is n. Words of a
    phrase are joined by a space. A null lang counts as ``und``, a null text as
    empty.
    """
    given = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), F.col("text").alias("text")
    ).where(F.length("text") > 0)
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    packed = given.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(
        _packing(buckets), _PACKED
    )
    keys = ["lang", "bucket", "kind"]
    merge = _merging(min_count, max(1, buckets // 4))
    first = stored(packed.groupBy(*keys).applyInArrow(merge, _COUNTED), "edges")
    pairs = first.where("kind is not null").select(*_names(_PACKED))
    second = pairs.groupBy(*keys).applyInArrow(merge, _COUNTED)
    columns = ["lang", "k", "phrase", "f"]
    return first.where("k is not null").select(*columns).unionByName(second.select(*columns))


def mine(
    docs: DataFrame, min_count: int = 30, top: int = 2000, covered: int = 80
) -> DataFrame:
    """The ``top`` collocations of each lang: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased in A-Z and split into pieces at ``.,;:!?`` and line ends,
    pieces into words at blanks and tabs. A phrase of 2 to 4 words with a = f(phrase)
    >= ``min_count`` is cut after each of its words into parts with counts l and r;
    its score is the least floor(2000000 a / (l + r)), ties to the first cut. A phrase
    inside a longer one with 100 f(longer) >= ``covered`` a is dropped. Order: score
    and a descending, then the bytes of the phrase.

    Null and empty texts hold no words, a null lang is ``und``; repeated rows count
    each time. An empty table gives no rows. All arithmetic is on integers.
    """
    counted = stored(count_phrases(docs, min_count), "phrases")
    known = counted.where("k > 0").select("lang", "phrase", "f")
    phrases = counted.where("k > 1").withColumn("words", F.split("phrase", " "))
    cuts = phrases.select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"),
        "words",
        "k",
    ).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("_first"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("_rest"),
    )
    first = known.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    score = F.expr(
        "cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div cast(l + r as decimal(20,0))"
    )
    scored = (
        cuts.join(first, ["lang", "_first"])
        .join(rest, ["lang", "_rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("_least"))
        .select("lang", "phrase", "a", "_least.l", "_least.r", "_least.score")
    )
    # Every phrase that lies inside a longer one, with the largest count of such a one.
    spans = F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),"
        " s -> array_join(slice(words, s, m), ' '))))"
    )
    inside = (
        phrases.where("k > 2")
        .select("lang", F.explode(spans).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_longer"))
    )
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < covered * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = counted.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _tables():
    """Lower case of A-Z by byte, and the class of a byte: 0 word, 1 blank, 2 end of piece."""
    import numpy as np

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(BLANKS)] = 1
    kind[list(PIECE_ENDS)] = 2
    return lower, kind


def split_words(data: bytes):
    """Words of ``data`` as a dictionary and numbers in it, and how many follow in the piece.

    Returns (words, ids, left): ``left`` counts the words from a word to the end of
    its piece, itself included.
    """
    import numpy as np
    import pyarrow as pa

    lower, kind = _tables()
    raw = lower[np.frombuffer(data, dtype=np.uint8)]
    classes = kind[raw]
    in_word = np.zeros(len(raw) + 2, dtype=np.int8)
    in_word[1:-1] = classes == 0
    step = np.diff(in_word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = np.ascontiguousarray(raw[classes == 0])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    ).dictionary_encode()
    piece = np.cumsum(classes == 2, dtype=np.int32)[starts] if len(starts) else starts
    change = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    last = np.append(change, len(starts)) - 1
    runs = np.diff(np.concatenate([[0], change, [len(starts)]]))
    left = np.repeat(last, runs) - np.arange(len(starts)) + 1
    return words.dictionary, words.indices.to_numpy(), left


def _unique_rows(grams, counts, size: int):
    """Distinct rows of numbers below ``size``, sorted, with the sums of ``counts``."""
    import numpy as np

    keys = [
        grams[:, k].astype(np.uint64) * np.uint64(size) + grams[:, k + 1]
        for k in range(0, grams.shape[1], 2)
    ]
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    order = order.astype(np.uint32)
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    del keys
    at = np.flatnonzero(new)
    sums = np.diff(np.append(at, len(new))) if counts is None else np.add.reduceat(counts[order], at)
    return grams[order[at]], sums


def _word_hashes(words):
    """A 64-bit hash of each word that does not depend on the task."""
    import xxhash
    import numpy as np

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def _bucket_of(grams, hashes, words: int, buckets: int):
    """The bucket of each row, by its first ``words`` words."""
    import numpy as np

    padded = np.append(np.uint64(0), hashes)
    mixed = np.zeros(len(grams), dtype=np.uint64)
    for k in range(words):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + padded[grams[:, k]]
        mixed ^= mixed >> np.uint64(32)
    return mixed % np.uint64(buckets)


def _id_width(words: int) -> int:
    """Bytes of a number of one of so many words, or of none."""
    return 2 if words < 1 << 16 else 4


def _packed_rows(lang, kind: int, bucket, grams, counts, spelled):
    """One row for each bucket: words, numbers of words by column, counts."""
    import numpy as np

    order = np.argsort(bucket, kind="stable")
    bucket, grams, counts = bucket[order], grams[order], counts[order]
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    number = np.zeros(len(spelled) + 1, dtype=np.uint32)
    for start, stop in zip(edges, np.append(edges[1:], len(bucket))):
        part = grams[start:stop]
        used = np.zeros(len(spelled) + 1, dtype=bool)
        used[part.ravel()] = True
        used[0] = False
        here = np.flatnonzero(used)
        number[here] = np.arange(1, len(here) + 1)
        most = int(counts[start:stop].max())
        width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
        yield (
            lang,
            int(bucket[start]),
            kind,
            b"\n".join([spelled[i - 1] for i in here]),
            number[part].astype(f"<u{_id_width(len(here))}").T.tobytes(),
            counts[start:stop].astype(f"<u{width}").tobytes(),
        )


def _packing(buckets: int):
    def rows_of(lang, data):
        import numpy as np

        words, ids, left = split_words(data)
        if not len(ids):
            return
        size = len(words) + 1
        spelled = words.to_pylist()
        hashes = _word_hashes(spelled)
        grams = np.zeros((len(ids), LONGEST), dtype=np.uint32)
        for k in range(min(LONGEST, len(ids))):
            fits = np.flatnonzero(left > k)
            grams[fits, k] = ids[fits + k] + 1
        singles = np.bincount(ids, minlength=size - 1)
        grams, counts = _unique_rows(grams, None, size)
        bucket = _bucket_of(grams, hashes, LONGEST - 1, buckets)
        yield from _packed_rows(lang, EDGES, bucket, grams, counts, spelled)
        alone = np.arange(1, size, dtype=np.uint32)[:, None]
        bucket = _bucket_of(alone, hashes, 1, buckets)
        yield from _packed_rows(lang, WORDS, bucket, alone, singles, spelled)

    def pieces_of(text):
        """``text`` in parts of about FLUSH_BYTES that end where a piece ends."""
        start = 0
        while len(text) - start > FLUSH_BYTES:
            window = text[start : start + FLUSH_BYTES]
            cut = max(window.rfind(bytes([c])) for c in PIECE_ENDS) + 1
            if not cut:  # a piece longer than that: up to its end
                ends = [text.find(bytes([c]), start + FLUSH_BYTES) for c in PIECE_ENDS]
                cut = min((e for e in ends if e >= 0), default=len(text) - 1) + 1 - start
            yield text[start : start + cut]
            start += cut
        yield text[start:]

    def pack(batches):
        import pyarrow as pa

        names = _names(_PACKED)
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def table(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def flush(lang):
            rows = list(rows_of(lang, b"\n".join(held.pop(lang))))
            sizes.pop(lang)
            if rows:
                yield table(rows)

        held, sizes = {}, {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in pieces_of(text.as_py()):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    if sizes[lang] >= FLUSH_BYTES:
                        yield from flush(lang)
        for lang in list(held):
            yield from flush(lang)

    return pack


def _merging(min_count: int, pair_buckets: int):
    """Counts of one bucket: sequences of all tasks, and from them those of their beginnings.

    Phrases come out with their counts; the pairs of an edge bucket, of which other
    buckets hold their part, come out packed.
    """

    def merge(packed):
        import numpy as np
        import pyarrow as pa

        lang, kind = packed.column("lang")[0].as_py(), packed.column("kind")[0].as_py()
        spelled = packed.column("words").to_pylist()
        sizes = [w.count(b"\n") + 1 for w in spelled]
        raw = np.frombuffer(b"\n".join(spelled), dtype=np.uint8)
        del spelled
        ends = np.append(np.flatnonzero(raw == 10), len(raw))
        offsets = np.zeros(len(ends) + 1, dtype=np.int64)
        np.cumsum(np.diff(np.append(-1, ends)) - 1, out=offsets[1:])
        letters = np.ascontiguousarray(raw[raw != 10])
        words = pa.Array.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        del raw, letters
        merged = words.indices.to_numpy().astype(np.uint32) + np.uint32(1)
        grams, counts, base = [], [], 0
        for ids, number, size in zip(packed.column("ids"), packed.column("counts"), sizes):
            own = np.concatenate([np.zeros(1, dtype=np.uint32), merged[base : base + size]])
            rows = own[np.frombuffer(ids.as_py(), dtype=f"<u{_id_width(size)}").reshape(kind, -1).T]
            raw = number.as_py()
            grams.append(rows)
            counts.append(np.frombuffer(raw, dtype=f"<u{len(raw) // len(rows)}").astype(np.int64))
            base += size
        grams, counts = np.concatenate(grams), np.concatenate(counts)
        names = words.dictionary

        out_k, out_phrase, out_f, partial = [], [], [], []

        def keep(k, rows, f):
            often = f >= min_count
            numbers = rows[often][:, :k].astype(np.int64) - 1
            spelled = names.take(pa.array(numbers.ravel())).to_pylist()
            out_phrase.extend(
                b" ".join(spelled[i : i + k]).decode("utf-8", "replace")
                for i in range(0, len(spelled), k)
            )
            out_f.extend(f[often].tolist())
            out_k.extend([k] * int(often.sum()))

        if kind == WORDS:
            sums = np.zeros(len(names) + 1, dtype=np.int64)
            np.add.at(sums, grams[:, 0].astype(np.int64), counts)
            keep(1, np.arange(1, len(names) + 1)[:, None], sums[1:])
            out_k.append(0)
            out_phrase.append("")
            out_f.append(int(counts.sum()))
        else:
            grams, counts = _unique_rows(grams, counts, len(names) + 1)
            for k in range(grams.shape[1], 1, -1):
                # Runs of sequences that begin with the same k words.
                new = np.ones(len(grams), dtype=bool)
                new[1:] = (grams[1:, :k] != grams[:-1, :k]).any(axis=1)
                at = np.flatnonzero(new)
                flow = np.add.reduceat(counts, at)
                full = grams[at, k - 1] > 0
                rows, flow = grams[at[full]], flow[full]
                if k > PAIRS or kind == PAIRS:
                    keep(k, rows, flow)
                elif len(rows):
                    spelled = names.to_pylist()
                    bucket = _bucket_of(rows, _word_hashes(spelled), PAIRS, pair_buckets)
                    pairs = np.ascontiguousarray(rows[:, :PAIRS])
                    partial = list(_packed_rows(lang, PAIRS, bucket, pairs, flow, spelled))
        n, m = len(out_k), len(partial)
        packed_columns = list(zip(*partial)) if partial else [[]] * 6
        columns = [
            pa.array(out_k + [None] * m, pa.int32()),
            pa.array(out_phrase + [None] * m, pa.string()),
            pa.array(out_f + [None] * m, pa.int64()),
            pa.array([lang] * (n + m), pa.string()),
            *(
                pa.array([None] * n + list(column), type_)
                for column, type_ in zip(
                    packed_columns[1:], (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                )
            ),
        ]
        return pa.table(columns, names=_names(_COUNTED))

    return merge
