"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (1 to 3 letters, words padded
with a blank at both ends, A to Z and all other letters lower-cased) by falling
count, equal counts by code. A document goes to the language whose profile is
nearest by out-of-place distance: for each n-gram of the document's own profile
the difference of the two ranks, or the full profile size where it is missing.

Cases: null text and text without letters give ``und`` with score 0, and so does
every text when nothing was learned (an empty table, no labels). Equal distances
go to the language first in order of its name. Repeated rows are learned from and
judged each for itself. Null languages are never learned from. A null key counts
as not held out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROFILE = 300
# Languages are a closed label set; profiles are PROFILE rows for each.
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
# Counts a task holds back before it sums them up, characters of a text that are taken at a
# time, and rows that are judged at a time.
FLUSH = 500_000
PART = 1_000_000
ROWS = 256
BLANK = 1


class Grams:
    """Distinct n-grams of texts with their counts: 21 bits for each character."""

    def __init__(self):
        import numpy as np

        self.letters = np.array([chr(i).isalpha() for i in range(0x110000)])

    def counts(self, text: str | None):
        import numpy as np

        codes = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype="<u4")
        letters = self.letters[codes]
        # Runs of other characters become one blank, with one at both ends.
        marked = np.concatenate([[BLANK], np.where(letters, codes, BLANK), [BLANK]]).astype(np.int64)
        kept = np.concatenate([[True], letters | np.concatenate([[True], letters[:-1]]), [True]])
        if len(letters) == 0 or not letters.any():
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        kept[1] = letters[0]
        kept[-1] = letters[-1]
        marked = marked[kept]
        found = []
        for start in range(0, len(marked), PART):
            c = marked[start : start + PART + 2]
            first, word = c[:PART] << 42, c != BLANK
            pairs = first[: len(c) - 1] | (c[1 : PART + 1] << 21)
            triples = pairs[: len(c) - 2] | c[2:]
            found.append(
                np.unique(
                    np.concatenate([first[word[:PART]], pairs, triples[word[1 : len(triples) + 1]]]),
                    return_counts=True,
                )
            )
        if len(found) == 1:
            return found[0]
        codes, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)


def ranked(codes, counts, size: int):
    """The ``size`` most frequent codes, by falling count and then by code."""
    import numpy as np

    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:size]]


def learn_profiles(
    labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE
) -> DataFrame:
    """(lang, rank, code): the profile of every language in ``labelled``, over all its rows."""
    rows = labelled.select(lang, text).where(F.col(lang).isNotNull() & F.col(text).isNotNull())

    def count(batches):
        import numpy as np
        import pyarrow as pa

        grams, held, total = Grams(), {}, 0

        def summed(parts):
            codes = np.concatenate([c for c, _ in parts])
            counts = np.concatenate([n for _, n in parts])
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
            return codes[starts], np.add.reduceat(counts[order], starts) if len(codes) else counts

        def flush():
            for name, parts in held.items():
                codes, sums = summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(sums)],
                    names=["lang", "code", "n"],
                )
            held.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    codes, counts = grams.counts(value)
                    held.setdefault(name, []).append((codes, counts))
                    total += len(codes)
                    if total > FLUSH:
                        # Few codes are new in a further text: sums stay small for long.
                        for known, parts in held.items():
                            held[known] = [summed(parts)]
                        total = sum(len(parts[0][0]) for parts in held.values())
                        if total > FLUSH // 2:
                            yield from flush()
                            total = 0
        yield from flush()

    counted = (
        rows.mapInArrow(count, "lang string, code bigint, n bigint")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    return (
        counted.withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("rank") < size)
        .select("lang", "rank", "code")
    )


def predict(
    documents: DataFrame,
    profiles: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = PROFILE,
    with_text: bool = False,
) -> DataFrame:
    """``key``, lang_pred and score for every row of ``documents``; its text too, if asked for.

    The score is one minus the distance as a share of the largest possible one.
    Profiles are fetched and sent to the tasks: at most MAX_LANGUAGES of ``size`` rows.
    """
    fetched = profiles.limit(MAX_LANGUAGES * size + 1).toPandas()
    if len(fetched) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    tables = []
    for name in sorted(fetched["lang"].unique()):
        own = fetched[fetched["lang"] == name].sort_values("code")
        tables.append((name, own["code"].to_numpy("int64"), own["rank"].to_numpy("int64")))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        grams = Grams()

        def judge(value):
            codes, counts = grams.counts(value)
            if not len(codes) or not tables:
                return UNKNOWN, 0.0
            own = ranked(codes, counts, size)
            place = np.arange(len(own))
            best, name = None, UNKNOWN
            for lang, theirs, ranks in tables:
                at = np.minimum(np.searchsorted(theirs, own), len(theirs) - 1)
                far = np.where(theirs[at] == own, np.abs(ranks[at] - place), size)
                distance = int(far.sum())
                if best is None or distance < best:
                    best, name = distance, lang
            return name, 1.0 - best / (size * len(own))

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [judge(value) for value in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        *([part.column(1)] if with_text else []),
                    ],
                    names=schema.names,
                )

    schema = T.StructType(
        [
            T.StructField(key, documents.schema[key].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            *([documents.schema[text]] if with_text else []),
        ]
    )
    return documents.select(key, text).mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Documents that are never learned from: CRC-32 of the key as text, modulo 3, is 1."""
    digest = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(digest % 3 == 1, F.lit(False))


def identify(
    documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Learn from the labelled rows that are not held out, then judge every row.

    Returns ``key``, held_out, lang_pred, score.
    """
    profiles = learn_profiles(documents.where(~held_out(key)), text, lang)
    found = predict(documents, profiles, key, text)
    return found.select(key, held_out(key).alias("held_out"), "lang_pred", "score")
