"""Document fingerprints by a randomised edit embedding, banding and verification.

A shared random walk reads a text: at step ``j`` it outputs the character it
stands on, and moves on by one if the shared random bit of (j, character) is set.
Texts a few edits apart fall into step again, so edit distance becomes Hamming
distance of the outputs. The walk goes over the whole text and ends with it.

A fingerprint keeps a sample of the steps: step ``j`` is in it if its random level
is high enough for the length of the walk, so that 256 to 512 steps are kept at
any length, and texts of unlike lengths still share steps. Each step gives four
bits of its character. Likeness is the share of agreeing steps among those both
fingerprints were sampled from, steps after the end of both left out.

Walks of all texts of a batch advance together, so a step costs one vector
operation, whatever the number of texts.

Cases: null text counts as empty; equal texts have equal fingerprints; two empty
texts have likeness 1, an empty and another text 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.common import partitions, runs, stored, whole_groups, worker_memory
from attestry.llm.components import connected
from attestry.llm.jaccard_join import spanning

PERIOD = 8_192  # steps after which the random bits repeat
SYMBOLS = 256
SAMPLED = 256
SEED = 20_240_117
# Characters whose walks advance together.
BATCH_CHARS = 4_000_000
# Characters of texts that a task works on at once, beside the batch it was handed.
SLICE_CHARS = 3_000_000
BANDS = 16
BAND_STEPS = 6
# Likeness from which two fingerprints are near, and members of one block of a bucket.
LEAST = 0.8
BLOCK = 512
# Comparisons that a task remembers, as a pair often shares several bands.
REMEMBERED = 500_000


def walk_bits():
    """Move or stay, for each step of a period and each symbol; symbol 0 is the end and stays."""
    import numpy as np

    bits = np.random.default_rng(SEED).integers(0, 2, (PERIOD, SYMBOLS), dtype=np.int64)
    bits[:, 0] = 0
    return bits.astype(np.int8)


def levels(count: int):
    """Level of steps 0 to count - 1: level ``v`` or more has probability 2 ** -v."""
    import numpy as np

    x = np.arange(count, dtype=np.uint64) + np.uint64(SEED)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    low = (x & (~x + np.uint64(1))).astype(np.float64)
    return np.where(low == 0, 64, np.log2(np.maximum(low, 1))).astype(np.int64)


def level_for(length: int) -> int:
    """Level at which about SAMPLED to 2 * SAMPLED of the walk's steps are kept."""
    level = 0
    while 3 * length >> (level + 1) >= SAMPLED:
        level += 1
    return level


def symbols(text: str):
    """One of 255 symbols for each code point."""
    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    mixed = codes * np.uint32(0x9E3779B1)
    return ((mixed >> np.uint32(16)) % np.uint32(SYMBOLS - 1) + np.uint32(1)).astype(np.uint8)


def nibbles():
    import numpy as np

    table = np.random.default_rng(SEED + 1).integers(0, 16, SYMBOLS, dtype=np.uint8)
    return table


def embed(texts: list[str]) -> list[str]:
    """Fingerprints ``length:level:hex``, a digit for each kept step up to the end of the text.

    ``length`` is the number of code points.
    """
    import numpy as np

    out: list = [None] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    bits, table = worker_memory("walk bits", walk_bits), nibbles()
    digits = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)
    start = 0
    while start < len(order):
        # Longest first, so the texts still walking are always the first ones.
        chosen, size = [], 0
        while start < len(order) and (not chosen or size < BATCH_CHARS):
            chosen.append(order[start])
            size += len(texts[order[start]]) + 1
            start += 1
        lengths = np.array([len(texts[i]) for i in chosen])
        flat = np.zeros(size, dtype=np.uint8)
        at = np.zeros(len(chosen), dtype=np.int64)
        place = 0
        for k, i in enumerate(chosen):
            flat[place : place + lengths[k]] = symbols(texts[i])
            at[k] = place
            place += lengths[k] + 1
        steps = 3 * lengths
        level = [level_for(int(n)) for n in lengths]
        level_of = levels(int(steps[0]))
        kept: list = []
        active = len(chosen)
        for j in range(int(steps[0])):
            while active and steps[active - 1] <= j:
                active -= 1
            now = flat[at[:active]]
            # The shortest text still walking has the lowest level.
            if active and level_of[j] >= level[active - 1]:
                kept.append((j, now))
            at[:active] += bits[j % PERIOD][now]
            if j % 512 == 0 and not now.any():
                break  # all walks have ended
        for k, i in enumerate(chosen):
            own = [now[k] for j, now in kept if k < len(now) and level_of[j] >= level[k]]
            codes = table[np.array(own, dtype=np.uint8)] if own else np.empty(0, dtype=np.uint8)
            ended = np.array(own, dtype=np.uint8) == 0
            hexed = np.where(ended, ord("-"), digits[codes]).astype(np.uint8)
            kept_hex = hexed.tobytes().decode().rstrip("-")
            out[i] = f"{lengths[k]}:{level[k]}:{kept_hex}"
    return out


class Likeness:
    """Likeness of two fingerprints, 0 to 1."""

    def __init__(self):
        self.steps = {}

    def parse(self, fingerprint: str):
        import numpy as np

        length, level, kept = fingerprint.split(":")
        return int(length), int(level), np.frombuffer(kept.encode(), dtype=np.uint8)

    def at_level(self, length: int, level: int, wanted: int, kept):
        """Those kept at ``level`` that are kept at the higher level ``wanted`` too."""
        if level == wanted:
            return kept
        own = self.levels(3 * length)
        return kept[own[own >= level][: len(kept)] >= wanted]

    def levels(self, count: int):
        """Levels of the first ``count`` steps, computed once for the next power of two."""
        size = 1 << max(10, (count - 1).bit_length())
        if size not in self.steps:
            self.steps = {k: v for k, v in self.steps.items() if k < size}
            self.steps[size] = levels(size)
        return self.steps[size][:count]

    def __call__(self, one: str, other: str) -> float:
        import numpy as np

        if one == other:
            return 1.0
        (n, v, a), (m, w, b) = self.parse(one), self.parse(other)
        if not n or not m:
            return float(n == m)
        level = max(v, w)
        a, b = self.at_level(n, v, level, a), self.at_level(m, w, level, b)
        end = ord("-")
        steps = max(len(a), len(b))
        x, y = np.full(steps, end, dtype=np.uint8), np.full(steps, end, dtype=np.uint8)
        x[: len(a)], y[: len(b)] = a, b
        open_ = (x != end) | (y != end)
        return int(((x == y) & open_).sum()) / max(1, int(open_.sum()))


def dealt_in_order(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(range, guest, _key, _text): documents dealt by falling key, to be read by ``followed``.

    After the last comes the first. Documents are dealt by ranges of the key; the
    first of each range is also sent to the range before it, so texts move once
    and no range sees more than its own. Equal keys follow each other by text; a
    null key counts as the smallest. Each range is streamed in order.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    parts = partitions(spark)
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("_key", shares, 10_000).alias("c")).first()["c"] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    # Range 0 holds the largest keys.
    ascending = cuts[::-1]

    def place(key_):
        from bisect import bisect_right

        return len(ascending) if key_ is None else len(ascending) - bisect_right(ascending, key_)

    @F.arrow_udf("int")
    def range_of(keys):
        import pyarrow as pa

        return pa.array([place(k) for k in keys.to_pylist()], pa.int32())

    slim = rows.select("_key", range_of("_key").alias("_range"))
    tops = slim.groupBy("_range").agg(F.max("_key").alias("top")).collect()
    tops = {row["_range"]: row["top"] for row in tops}  # at most one for each partition
    present = sorted(tops)
    # The first of a range is a guest in the range before it, that of the first in the last.
    hosts = {r: present[i - 1] for i, r in enumerate(present)}

    @F.arrow_udf("int")
    def host_of(keys):
        import pyarrow as pa

        ranges = [place(k) for k in keys.to_pylist()]
        return pa.array(
            [hosts[r] if k == tops[r] else None for k, r in zip(keys.to_pylist(), ranges)],
            pa.int32(),
        )

    dealt = rows.select("*", range_of("_key").alias("_range"), host_of("_key").alias("_host"))
    places = F.filter(
        F.array(
            F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest")),
            F.struct(F.col("_host").alias("range"), F.lit(True).alias("guest")),
        ),
        lambda p: p["range"].isNotNull(),
    )
    return (
        dealt.withColumn("_place", F.explode(places))
        .select("_place.*", "_key", "_text")
        .repartition(parts, "range")
        .sortWithinPartitions(
            "range", "guest", F.col("_key").desc_nulls_last(), "_text"
        )
    )


def followed(batches):
    """(key, text, next) of every row of a range dealt by ``dealt_in_order``, in order."""
    waiting = None  # (range, key, text) whose next is not known yet
    done = None
    for batch in batches:
        for place, is_guest, key_, text_ in zip(*(c.to_pylist() for c in batch.columns)):
            if place == done:
                continue
            if waiting and waiting[0] == place:
                yield waiting[1], waiting[2], text_
            waiting = None if is_guest else (place, key_, text_)
            if is_guest:
                done = place


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the beginning of ``following``."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def fingerprint(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and fingerprint of every whole text."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(embed(texts), pa.string())], names=[key, "fingerprint"]
            )

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint string")


def edit_probe(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text and the next one, with their likenesses.

    Returns ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    kind = documents.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )

    names = [f.split()[0].strip("`") for f in schema.split(", ")]

    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        likeness = Likeness()

        def made(rows, key_type):
            keys, texts, nexts = zip(*rows)
            changed = [edited(a, b) for a, b in zip(texts, nexts)]
            # In order, the next of a row is the text of the row after it: embed each text once.
            wanted = list(dict.fromkeys([*texts, *changed, *nexts]))
            prints = dict(zip(wanted, embed(wanted)))
            own, other, after = ([prints[t] for t in ts] for ts in (texts, changed, nexts))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, key_type),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array(own, pa.string()),
                    pa.array(other, pa.string()),
                    pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
                    pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
                ],
                names=names,
            )

        kinds = []

        def watched():
            for batch in batches:
                kinds[:] = [batch.schema.field(2).type]
                yield batch

        rows, size = [], 0
        for row in followed(watched()):
            rows.append(row)
            size += len(row[1])
            if size >= SLICE_CHARS:
                yield made(rows, kinds[0])
                rows, size = rows[:0], 0
        if rows:
            yield made(rows, kinds[0])

    return dealt_in_order(documents, key, text).mapInArrow(run, schema)


def band_places(bands: int, band_steps: int) -> list[list[int]]:
    """The sampled steps that make up each band."""
    return [
        [(SEED * (b + 1) + 7_919 * (s + 1) * (b + 3)) % SAMPLED for s in range(band_steps)]
        for b in range(bands)
    ]


def bands_of(fingerprint: str, places, likeness: Likeness) -> list[str]:
    """Names of the bands of a fingerprint.

    At its own level bands draw from all steps that every text of the level has, and
    from the first half of them, as they do at the next higher level: texts whose
    lengths lie on either side of a step of the level share those.
    """
    length, level, kept = likeness.parse(fingerprint)
    names = []
    for wanted, most in ((level, SAMPLED), (level, SAMPLED // 2), (level + 1, SAMPLED // 2)):
        own = likeness.at_level(length, level, wanted, kept)
        for band, row in enumerate(places):
            values = "".join(chr(own[p % most]) if p % most < len(own) else "-" for p in row)
            names.append(f"{wanted}/{most}/{band}/{values}")
    return names


def near_groups(
    prints: DataFrame,
    key: str = "doc_id",
    least: float = LEAST,
    bands: int = BANDS,
    band_steps: int = BAND_STEPS,
    block: int = BLOCK,
) -> DataFrame:
    """(fingerprint, near_group): the smallest key reachable over near fingerprints.

    ``prints`` is (key, fingerprint). A band is a draw of sampled steps; fingerprints
    that agree on all steps of a band share a bucket, and near ones among them (a
    likeness of at least ``least``) are linked. Equal texts have one fingerprint and
    so one row; empty texts are near each other only.

    In each bucket all members are first compared with one of them. Buckets that
    still hold different groups are cut into blocks, whose members are compared with
    those outside the largest group of the bucket; each block gives only links that
    span what it found. So a bucket of any size gives about as many links as members,
    and none that could join two groups is lost.
    """

    def name_bands(batches):
        import pyarrow as pa
        import xxhash

        likeness, places = Likeness(), band_places(bands, band_steps)
        for batch in batches:
            prints_ = batch.column(0).to_pylist()
            keys = [
                [xxhash.xxh3_64_intdigest(name) - (1 << 63) for name in bands_of(p, places, likeness)]
                for p in prints_
            ]
            nodes = [int.from_bytes(xxhash.xxh3_128_digest(p)[:8], "big") - (1 << 63) for p in prints_]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(nodes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["fingerprint", "_key", "node", "bands"],
            )

    kind = prints.schema[key].dataType.simpleString()
    one = prints.groupBy("fingerprint").agg(F.min(key).alias("_key"))
    named = stored(
        one.mapInArrow(name_bands, f"fingerprint string, _key {kind}, node bigint, bands array<bigint>"),
        "bands",
    )
    rows = named.select("node", F.explode("bands").alias("band")).distinct()
    shared = rows.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("_n"))
    members = stored(rows.join(shared.where("_n > 1").drop("_n"), "band"), "members")
    spelled = named.select("node", "fingerprint")
    by_hub = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = by_hub.join(
        spelled.select(F.col("node").alias("a"), F.col("fingerprint").alias("left")), "a"
    ).join(spelled.select(F.col("node").alias("b"), F.col("fingerprint").alias("right")), "b")

    def verify(batches):
        import pyarrow as pa

        likeness = Likeness()
        for batch in batches:
            near = [
                likeness(x, y) >= least
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            out = pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"])
            yield out.filter(pa.array(near, pa.bool_()))

    links = stored(
        pairs.select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint"), "links"
    )
    first = stored(connected(links), "roots").withColumnRenamed("node", "_node")
    placed = members.join(first, members["node"] == first["_node"], "left").select(
        "band", "node", F.coalesce("root", "node").alias("root")
    )
    held = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("_n"))
    open_ = (
        held.groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("_groups"),
            F.max_by("root", F.struct("_n", "root")).alias("_largest"),
            F.ceil(F.sum("_n") / block).cast("int").alias("_blocks"),
        )
        .where("_groups > 1")
    )
    left = placed.join(open_, "band").join(spelled, "node")
    own = F.pmod(F.xxhash64("node", F.lit(31)), F.col("_blocks")).cast("int")
    hosts = left.withColumns({"block": own, "side": F.lit(0)})
    guests = left.where("root <> _largest").withColumns(
        {"block": F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)), "side": F.lit(1)}
    )
    columns = [F.xxhash64("band", "block").alias("pair"), "side", "node", "root", "fingerprint"]
    dealt = (
        hosts.select(*columns)
        .unionByName(guests.select(*columns))
        .repartition(partitions(prints.sparkSession), "pair")
        .sortWithinPartitions("pair")
    )

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        likeness, tried = Likeness(), {}
        for batch in whole_groups(batches):
            keys, side, nodes, root = (batch.column(i).to_numpy() for i in range(4))
            prints_ = batch.column(4).to_pylist()
            found = set()
            for start, end in runs(keys):
                part = np.arange(start, end)
                left, right = part[side[start:end] == 0], part[side[start:end] == 1]
                x, y, weight = [], [], []
                for j in right.tolist():
                    for i in left[root[left] != root[j]].tolist():
                        pair = (min(nodes[i], nodes[j]), max(nodes[i], nodes[j]))
                        if pair not in tried:
                            if len(tried) >= REMEMBERED:
                                tried.clear()
                            tried[pair] = likeness(prints_[i], prints_[j])
                        if tried[pair] >= least:
                            x.append(i)
                            y.append(j)
                            weight.append(1.0 - tried[pair])
                if x:
                    x, y = np.array(x), np.array(y)
                    few = spanning(root[x], root[y], np.array(weight))
                    found.update(zip(nodes[x[few]].tolist(), nodes[y[few]].tolist()))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    more = stored(dealt.mapInArrow(compare, "a bigint, b bigint"), "links")
    roots = connected(links.unionByName(more)).withColumnRenamed("node", "_node")
    rooted = named.join(roots, named["node"] == roots["_node"], "left").select(
        "fingerprint", "_key", F.coalesce("root", "node").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("_key").alias("near_group"))
    return rooted.join(smallest, "root").select("fingerprint", "near_group")
