"""Self-join of documents by Jaccard similarity of their word n-grams.

Token-combination prefixes. All shingles have one order: rare ones by hash, then the
frequent classes by falling rarity. Of two sets with enough overlap, each can miss
only ``size - overlap`` shingles of the other, so a beginning of each set long enough
to survive that many losses must hold a common signature:

* a rare shingle is a signature by itself and adds one to what the prefix survives;
* frequent shingles are split into classes by hash, and pairs of one class are the
  signatures, so a class of ``c`` shingles adds ``c - 1``: the prefix is extended
  until the sum is reached. The number of classes grows with the set, which keeps
  the pairs in proportion to the size. Pairs of sets are matched under the classes
  of the smaller one; sets near a bound of sizes give signatures under both.

A signature carries the sum at which it enters, so a pair of given sizes uses only
the part of the prefix that these sizes need. Candidates are verified on whole texts.

Groups of copies: sets that are equal are one node. In each bucket every member is
first compared with one hub, the member that needs the shortest prefix; components
of these links are formed. Only buckets whose members are not yet of one component
are looked at again, in blocks: members of the bucket that lie outside its largest
component meet all members of the blocks that sizes and prefixes leave open, as no pair
inside one component can join components. Pairs of different components count whose
sizes, prefixes and sketches (numbers of shingles by hash bin, whose differences
cannot exceed those of the sets) allow a link. Of these, each pair of blocks first
gives a spanning forest, the nearest sketches before others; these are verified and
the components formed anew. Where the forest left pairs out, those of them that are
still between different components come out in a second pass. So no bucket's pairs
are emitted, and no link that could join components is lost.

Cases: null or empty text, or text without words, has no shingles and no links; a
text of fewer than ``n`` words is one shingle; equal texts are linked; repeated rows
are equal texts; rows that share a key, or have none, are rows of their own; an empty
table gives an empty one. Sets and shingles are told apart by 64-bit hashes.
Component ids are the smallest key, null where no row of the component has one.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import dropped, partitions, runs, stored, whole_groups
from attestry.llm.components import connected

WORDS = 4
PERCENT = 85
# A shingle is frequent if this many sets have it in their prefix; the most frequent
# MAX_FREQUENT are told to all tasks. Both only steer the order, not the result.
FREQUENT = 4
MAX_FREQUENT = 262_144
MAX_SEEN = 300_000
# Bytes of text that are hashed at a time.
PIECE = 1 << 15
# Words of this many bytes are hashed by themselves: sums over that many bytes can be
# made to agree.
LONG_WORD = 64
# Bins of the sketch that bounds how much two sets differ, and rows of a block.
BINS = 256
BLOCK = 512
# Partners of a set up to which they meet in a join, and those of a hub in one part.
FEW_PAIRS = 16
HUB_PAIRS = 256
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def mix(x):
    """A one-to-one scramble of 64-bit numbers."""
    import numpy as np

    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of the words of a text, in order.

    A word is a polynomial in its bytes, each of which stands for a fixed random number,
    blanks for zero: one sum over a piece of text gives the hashes of all words in it.
    Pieces end at blanks; words of LONG_WORD bytes and more are hashed by themselves.
    """

    def __init__(self):
        import re

        import numpy as np

        self.blank = re.compile(rb"[\x09-\x0D\x20]")
        kinds = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8).astype(np.uint64)
        self.letters = mix(mix((kinds + np.uint64(1)) * np.uint64(FACTORS[0])) + np.uint64(FACTORS[1]))
        self.inside = np.ones(256, dtype=np.int8)
        for code in (*range(0x09, 0x0E), 0x20):
            self.letters[code], self.inside[code] = 0, 0
        base = FACTORS[2] | 3
        self.powers = self._powers(base)
        self.inverse = self._powers(pow(base, -1, 1 << 64))

    @staticmethod
    def _powers(base: int):
        import numpy as np

        factors = np.full(2 * PIECE, base, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def _piece(self, raw: bytes):
        import numpy as np

        codes = np.frombuffer(raw, dtype=np.uint8)
        inside = self.inside[codes]
        steps = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        starts = np.flatnonzero(steps > 0)
        if not len(starts):
            return np.empty(0, dtype=np.uint64)
        terms = self.letters[codes] * self.powers[: len(codes)]
        hashes = np.add.reduceat(terms, starts) * self.inverse[starts]
        ends = np.flatnonzero(steps < 0)
        for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
            hashes[i] = self.whole(raw[starts[i] : ends[i]])
        return hashes

    @staticmethod
    def whole(word: bytes):
        import xxhash

        return xxhash.xxh3_64_intdigest(word.lower())

    def __call__(self, text: str | None):
        import numpy as np

        raw = text.encode() if text else b""
        if len(raw) < PIECE:
            return self._piece(raw)
        found, at = [], 0
        while at < len(raw):
            cut = self.blank.search(raw, at + PIECE)
            end = cut.start() if cut else len(raw)
            # Only the last word of a piece can be so long.
            last = end - len(b"".join(raw[at:end].rsplit(None, 1)[-1:]))
            if end - last >= PIECE:
                found.append(self._piece(raw[at:last]))
                found.append(np.array([self.whole(raw[last:end])], dtype=np.uint64))
            else:
                found.append(self._piece(raw[at:end]))
            at = end
        return np.concatenate(found)


class Shingles:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, n: int):
        import numpy as np

        self.n, self.words = n, Words()
        # An odd factor of its own for each place: the order of words counts.
        self.factors = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(FACTORS[0])) | np.uint64(1)

    def __call__(self, text: str | None):
        import numpy as np

        hashes = self.words(text)
        n, count = self.n, len(hashes)
        if not count:
            return hashes
        width = min(n, count)
        total = np.full(max(1, count - n + 1), width, dtype=np.uint64)
        hashes = mix(hashes)
        for i in range(width):
            total += hashes[i : i + len(total)] * self.factors[i]
        total = np.sort(mix(total))
        return total[np.r_[True, total[1:] != total[:-1]]]


def losses(size: int, percent: int) -> int:
    """Most shingles of a set of ``size`` that a similar set may lack."""
    return size - -(-percent * size // 100)


def classes(band: int) -> int:
    """Number of frequent classes for smaller sets of ``2 ** band`` shingles and more."""
    return max(1, (1 << band) // 16)


def signatures(shingles, ranks, frequent, percent: int) -> tuple[list, list]:
    """Signatures of a set and the sums at which they enter its prefix.

    ``frequent`` are sorted hashes, ``ranks`` their places in the order.
    """
    import numpy as np

    size = len(shingles)
    if -(-percent * size // 100) == size and percent * (size + 1) > 100 * size:
        return [], []  # only equal sets are similar
    need = losses(size, percent) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        known = frequent[at] == shingles
        rare = shingles[~known][:need]
    else:
        known, rare = None, shingles[:need]
    keys = rare.view(np.int64).tolist()
    needs = list(range(1, len(keys) + 1))
    if len(keys) >= need:
        return keys, needs
    common = shingles[known][np.argsort(ranks[at[known]], kind="stable")]
    bands = {size.bit_length() - 1, (-(-percent * size // 100)).bit_length() - 1}
    for band in bands:
        count = classes(band)
        salt = np.uint64(0x632BE59BD9B4E019 * (band + 1) % (1 << 64))
        members, total = {}, len(rare)
        for shingle, own in zip(common, (common % np.uint64(count)).tolist()):
            earlier = members.setdefault(own, [])
            if earlier:
                total += 1
                pair = mix(np.array(earlier, dtype=np.uint64) * np.uint64(FACTORS[0]) + mix(shingle ^ salt))
                keys += pair.view(np.int64).tolist()
                needs += [total] * len(earlier)
                if total >= need:
                    break
            earlier.append(shingle)
    return keys, needs


def possible(a, b, need_a, need_b, percent: int):
    """Whether sizes and prefixes allow a pair; for columns and for arrays alike.

    With the least overlap of similar sets of these sizes, both sides must need the
    signature.
    """
    # percent * (a + b) / (100 + percent), rounded up
    overlap = (percent * (a + b) + 99 + percent - (percent * (a + b) + 99 + percent) % (100 + percent)) / (
        100 + percent
    )
    return (
        (a * 100 >= b * percent)
        & (b * 100 >= a * percent)
        & (need_a <= a - overlap + 1)
        & (need_b <= b - overlap + 1)
    )


def sketch(shingles) -> bytes:
    """Number of shingles in each hash bin, up to 255."""
    import numpy as np

    counts = np.bincount((shingles >> np.uint64(7)).astype(np.int64) % BINS, minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def spanning(left, right, weight):
    """Places of pairs that connect all that the pairs connect, the lightest ones first.

    Each round takes the lightest pair that leaves each component and joins the two.
    """
    import numpy as np

    names, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    u, v = ends[: len(left)], ends[len(left) :]
    order = np.argsort(weight, kind="stable")
    label, chosen = np.arange(len(names)), []
    while True:
        order = order[label[u[order]] != label[v[order]]]
        if not len(order):
            return np.unique(np.concatenate(chosen)) if chosen else order
        _, first = np.unique(np.concatenate([label[u[order]], label[v[order]]]), return_index=True)
        taken = np.unique(order[first % len(order)])
        chosen.append(taken)
        x, y = u[taken], v[taken]
        while (label[x] != label[y]).any():
            # Hang the larger of two labels on the smaller one, then follow the labels to their ends.
            a, b = label[x], label[y]
            to = np.arange(len(names))
            np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
            while (to[to] != to).any():
                to = to[to]
            label = to[label]


def across_blocks(batches, percent: int, forest: bool):
    """Rows (pair, side, set_id, size, need, root, hub, sketch, key) sorted by pair -> possible pairs.

    Side 0 are the members of a block, side 1 the guests that each of them meets, side 2
    members that meet each other too. With ``forest``, only pairs that connect what the
    possible ones of a block pair connect, and a row with the key alone where others are
    left out.
    """
    import numpy as np
    import pyarrow as pa

    for batch in whole_groups(batches):
        keys, side, ids, size, need, root, hub = (batch.column(i).to_numpy() for i in range(7))
        bins = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype=np.uint8).reshape(-1, BINS)
        bucket = batch.column(8).to_numpy()
        out, again = [], []
        for start, end in runs(keys):
            part = np.arange(start, end)
            left, right = part[side[start:end] != 1], part[side[start:end] != 0]
            a, b = left[:, None], right[None, :]
            good = (root[a] != root[b]) & (ids[a] != hub[a]) & (ids[b] != hub[b])
            good &= (side[b] == 1) | (ids[a] < ids[b])
            if not good.any():
                continue
            good &= possible(size[a], size[b], need[a], need[b], percent)
            i, j = np.nonzero(good)
            i, j = left[i], right[j]
            found = ([], [], [])
            for at in range(0, len(i), 1 << 16):
                x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                apart = (np.maximum(bins[x], bins[y]) - np.minimum(bins[x], bins[y])).sum(axis=1)
                # size_a + size_b - 2 * overlap, with the least overlap of similar sets
                most = (size[x] + size[y]) * (100 - percent) / (100 + percent)
                near = apart <= most + 1e-6
                for column, item in zip(found, (x[near], y[near], (apart / most.clip(1e-6))[near])):
                    column.append(item)
            if not found[0]:
                continue
            x, y, weight = map(np.concatenate, found)
            if forest and len(x) > 1:
                few = spanning(root[x], root[y], weight)
                if len(few) < len(x):
                    again.append(bucket[start])
                x, y = x[few], y[few]
            out.append(np.stack([np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])]))
        if out:
            pairs = np.unique(np.concatenate(out, axis=1), axis=1)
            nulls = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([*map(pa.array, pairs), nulls], names=["a", "b", "again"])
        if again:
            again = np.unique(again)
            nulls = pa.nulls(len(again), pa.int64())
            yield pa.RecordBatch.from_arrays([nulls, nulls, pa.array(again)], names=["a", "b", "again"])


def shingle_sets(documents: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(key, digest, n_shingles, set_id, head): each row's set, and the shortest prefix by hash.

    ``digest`` is that of the text (null counts as empty).
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import xxhash

        shingles = Shingles(n)
        for batch in batches:
            sizes, ids, heads = [], [], []
            for value in batch.column(2).to_pylist():
                own = shingles(value)
                sizes.append(len(own))
                ids.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
                heads.append(own[: losses(len(own), percent) // 2 + 1].view("int64"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(heads, pa.list_(pa.int64())),
                ],
                names=[key, "digest", "n_shingles", "set_id", "head"],
            )

    return documents.select(key, text_digest(text).alias("digest"), text).mapInArrow(
        run, f"`{key}` {kind}, digest binary, n_shingles bigint, set_id bigint, head array<bigint>"
    )


def text_digest(text: str) -> Column:
    """The first half of the SHA-256 digest of a text, null as empty."""
    whole = F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    return F.substring(whole, 1, 16)


def set_signatures(documents: DataFrame, text: str, n: int, percent: int, frequent) -> DataFrame:
    """(set_id, size, keys, needs, sketch), at most once for each set and task."""
    import numpy as np

    order = np.argsort(np.array(frequent, dtype=np.int64).view(np.uint64), kind="stable")
    hashes = np.array(frequent, dtype=np.int64).view(np.uint64)[order]
    packed = documents.sparkSession.sparkContext.broadcast((hashes.tobytes(), order.tobytes()))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        shingles = Shingles(n)
        common = np.frombuffer(packed.value[0], dtype=np.uint64)
        ranks = np.frombuffer(packed.value[1], dtype=np.int64)
        seen = set()
        for batch in batches:
            columns = ([], [], [], [], [])
            for value in batch.column(0).to_pylist():
                own = shingles(value)
                name = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
                if name in seen:
                    continue
                if len(seen) < MAX_SEEN:
                    seen.add(name)
                keys, needs = signatures(own, ranks, common, percent)
                if keys:
                    for column, item in zip(columns, (name, len(own), keys, needs, sketch(own))):
                        column.append(item)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.list_(pa.int64())),
                    pa.array(columns[3], pa.list_(pa.int32())),
                    pa.array(columns[4], pa.binary()),
                ],
                names=["set_id", "size", "keys", "needs", "sketch"],
            )

    return documents.select(text).mapInArrow(
        run, "set_id bigint, size int, keys array<bigint>, needs array<int>, sketch binary"
    )


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of sets whose texts really are similar.

    A set with few partners meets them in a join. The partners of a hub come to it in
    parts of about HUB_PAIRS, each part with one copy of the text of the hub, so its
    text is sent once per part and not once per pair.
    """
    counts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n"))
    hubs = counts.where(F.col("_n") > FEW_PAIRS).select(
        "b", F.ceil(F.col("_n") / HUB_PAIRS).cast("int").alias("_parts")
    )
    of_a = texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    columns = ["b", "part", "a", "text"]

    few = pairs.join(hubs, "b", "left_anti").join(of_a, "a").join(of_b, "b")
    few = few.select("a", "b", "text_a", "text_b").mapInArrow(
        partial(similar_pairs, n=n, percent=percent), "a bigint, b bigint"
    )

    part = F.pmod(F.xxhash64("a", F.lit(47)), F.col("_parts")).cast("int")
    partners = (
        pairs.join(hubs, "b")
        .select("b", part.alias("part"), "a")
        .join(of_a, "a")
        .select("b", "part", "a", F.col("text_a").alias("text"))
    )
    own = (
        hubs.select("b", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"))
        .join(of_b, "b")
        .select("b", "part", F.lit(None).cast("bigint").alias("a"), F.col("text_b").alias("text"))
    )
    many = (
        own.select(*columns)
        .unionByName(partners.select(*columns))
        .repartition(partitions(pairs.sparkSession), "b", "part")
        .sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
        .mapInArrow(partial(similar_to_hub, n=n, percent=percent), "a bigint, b bigint")
    )
    return few.unionByName(many)


def similar(one, other, percent: int) -> bool:
    import numpy as np

    small, large = sorted((one, other), key=len)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(small) + len(large) - shared)


def similar_pairs(batches, n: int, percent: int):
    """Rows (a, b, text_a, text_b), those of one b together -> similar pairs."""
    import pyarrow as pa

    shingles, last, own = Shingles(n), None, None
    for batch in batches:
        good = ([], [])
        names = (batch.column(i).to_pylist() for i in range(2))
        for a, b, text_a, text_b in zip(*names, batch.column(2), batch.column(3)):
            if b != last:
                last, own = b, shingles(text_b.as_py())
            if similar(own, shingles(text_a.as_py()), percent):
                good[0].append(a)
                good[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in good], names=["a", "b"])


def similar_to_hub(batches, n: int, percent: int):
    """Rows (b, part, a, text), the hub of a part first, with a null a -> similar pairs."""
    import pyarrow as pa

    shingles, own = Shingles(n), None
    for batch in batches:
        good = ([], [])
        for b, a, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            theirs = shingles(text.as_py())
            if a is None:
                own = theirs
            elif similar(own, theirs, percent):
                good[0].append(a)
                good[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in good], names=["a", "b"])


def still_open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with their root, of buckets that hold different ones."""
    rooted = members.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    keys = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("_least"), F.max("root").alias("_most"))
        .where("_least < _most")
        .select("key")
    )
    return rooted.join(keys, "key")


def reach(size: Column, need: Column, percent: int) -> Column:
    """Size of the largest set that may be similar, given the prefix needed here.

    Two members are ``possible`` where each one's size is within the reach of the other.
    """
    size, need = size.cast("bigint"), need.cast("bigint")
    return F.floor((size - need + 1) * (100 + percent) / F.lit(percent)) - size


def in_blocks(members: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Members of crowded buckets with ``inner``, ``reach`` and ``block``.

    ``inner`` members are those of the largest component. Inner and other members are cut
    into blocks of about BLOCK rows each, in order of reach, those of one reach by a hash.
    """
    sized = members.withColumn("reach", reach(F.col("size"), F.col("need"), percent))
    counts = sized.groupBy("key", "root", "reach").agg(F.count(F.lit(1)).alias("_n"))
    inner = F.col("root") == F.col("_largest")
    # One row for each reach of a bucket, so that the members are joined only once.
    cells = (
        counts.join(buckets.where(F.col("_rows") > BLOCK).select("key", "_largest"), "key")
        .groupBy("key", "_largest", "reach")
        .agg(
            F.sum(F.when(inner, F.col("_n")).otherwise(0)).alias("_inner"),
            F.sum(F.when(inner, 0).otherwise(F.col("_n"))).alias("_outer"),
        )
    )
    before = Window.partitionBy("key").orderBy("reach").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns(
        {f"{kind}_start": F.coalesce(F.sum(kind).over(before), F.lit(0)) for kind in ("_inner", "_outer")}
    )
    start = F.when(inner, F.col("_inner_start")).otherwise(F.col("_outer_start"))
    count = F.when(inner, F.col("_inner")).otherwise(F.col("_outer"))
    place = start + F.pmod(F.xxhash64("set_id", F.lit(31)), count)
    return sized.join(cells, ["key", "reach"]).select(
        *members.columns, inner.alias("inner"), "reach", F.floor(place / BLOCK).cast("int").alias("block")
    )


def dealt(placed: DataFrame) -> DataFrame:
    """Rows of ``in_blocks`` as hosts of their block and as guests of others.

    Members outside the largest component go as guests to the blocks of it, and to later
    blocks of their own kind, where sizes and reaches leave a possible pair.
    """
    blocks = placed.groupBy("key", "inner", "block").agg(
        F.min("size").alias("_least"), F.max("reach").alias("_most")
    )
    of = F.xxhash64("key", "inner", "block").alias("pair")
    columns = ["set_id", "size", "need", "root", "hub", "key"]
    hosts = placed.select(of, F.when(F.col("inner"), 0).otherwise(2).alias("side"), *columns)
    visiting = placed.where(~F.col("inner")).select(*columns, "reach", F.col("block").alias("_own"))
    guests = visiting.join(blocks, "key").where(
        (F.col("size") <= F.col("_most"))
        & (F.col("_least") <= F.col("reach"))
        & (F.col("inner") | (F.col("block") > F.col("_own")))
    )
    return hosts.unionByName(guests.select(of, F.lit(1).alias("side"), *columns))


def block_pairs(members: DataFrame, sketches: DataFrame, percent: int, forest: bool) -> DataFrame:
    """``across_blocks`` of all buckets, dealt by blocks, stored.

    A bucket of one block needs no guests. Sketches join the dealt rows last, as they are
    most of the bytes: only the shuffle by pair carries them.
    """
    held = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("_n"))
    buckets = held.groupBy("key").agg(
        F.max_by("root", F.struct("_n", "root")).alias("_largest"), F.sum("_n").alias("_rows")
    )
    placed = stored(in_blocks(members, buckets, percent), "placed")
    alone = members.join(buckets.where(F.col("_rows") <= BLOCK), "key").select(
        F.xxhash64("key").alias("pair"), F.lit(2).alias("side"), "set_id", "size", "need", "root", "hub", "key"
    )
    found = (
        alone.unionByName(dealt(placed))
        .join(sketches, "set_id")
        .select(
            "pair", "side", "set_id", F.col("size").cast("bigint"), F.col("need").cast("bigint"),
            "root", "hub", "sketch", "key",
        )
        .repartition(partitions(members.sparkSession), "pair")
        .sortWithinPartitions("pair")
        .mapInArrow(
            partial(across_blocks, percent=percent, forest=forest), "a bigint, b bigint, again bigint"
        )
    )
    found = stored(found, "tried")
    dropped(placed)
    return found


def pairs_of(found: DataFrame) -> DataFrame:
    return found.where("a is not null").select("a", "b").distinct()


def components(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``key``, n_shingles, component_id of every document.

    Two documents link when 100 * intersection >= percent * union of their sets;
    component_id is the smallest key reachable by links.
    """
    return rooted(documents, key, text, n, percent).select(key, "n_shingles", "component_id")


def rooted(documents: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """``components`` with the ``digest`` of the text and the ``root`` of the component.

    The root names a component whatever the keys of its rows; it is null for rows
    without shingles.
    """
    sets = stored(shingle_sets(documents, key, text, n, percent), "sets")
    # The most frequent shingles, counted once for each different set.
    frequent = (
        sets.where("n_shingles > 0")
        .groupBy("set_id")
        .agg(F.first("head").alias("head"))
        .select(F.explode("head").alias("shingle"))
        .groupBy("shingle")
        .count()
        .where(F.col("count") >= FREQUENT)
        .orderBy("count", "shingle")
    )
    top = frequent.orderBy(F.col("count").desc(), "shingle").limit(MAX_FREQUENT).collect()
    ordered = [row["shingle"] for row in reversed(top)]  # the rarest of them first

    signed = stored(set_signatures(documents, text, n, percent, ordered), "signatures")
    rows = signed.select(
        "set_id", "size", F.explode(F.arrays_zip("keys", "needs")).alias("s")
    ).select(F.col("s.keys").alias("key"), "set_id", "size", F.col("s.needs").alias("need"))
    # Most signatures occur once: only what is left without them is carried further.
    repeated = rows.groupBy("key").count().where("count > 1").select("key")
    rows = stored(rows.join(repeated, "key", "left_semi").distinct(), "shared")
    # The hub of a bucket needs the shortest prefix to be in it.
    rank = F.col("need").cast("bigint") * (1 << 40) + F.pmod(F.col("set_id"), F.lit(1 << 40))
    buckets = (
        rows.groupBy("key")
        .agg(
            F.min("set_id").alias("_least"),
            F.max("set_id").alias("_most"),
            F.min_by("set_id", rank).alias("hub"),
            F.min_by("size", rank).alias("hub_size"),
            F.min("need").alias("hub_need"),
        )
        .where("_least < _most")
        .drop("_least", "_most")
    )
    members = stored(rows.join(buckets, "key"), "members")
    nodes = members.select("set_id").distinct()
    sketches = stored(
        signed.groupBy("set_id").agg(F.first("sketch").alias("sketch")).join(nodes, "set_id"), "sketches"
    )
    dropped(rows, signed)
    chosen = sets.groupBy("set_id").agg(F.min("digest").alias("digest")).join(nodes, "set_id")
    # One text for each set that is in a bucket with another.
    texts = stored(
        documents.select(text_digest(text).alias("digest"), F.col(text).alias("text"))
        .dropDuplicates(["digest"])
        .join(chosen, "digest")
        .select("set_id", "text"),
        "texts",
    )
    by_hub = (
        members.where(F.col("set_id") != F.col("hub"))
        .where(possible(*(F.col(c) for c in ("size", "hub_size", "need", "hub_need")), percent))
        .select(F.col("set_id").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )
    by_hub = stored(by_hub, "pairs")
    hub_links = stored(verified(by_hub, texts, n, percent), "links")
    first = stored(connected(hub_links), "roots")

    # Buckets that still hold members of different components: first the pairs that suffice
    # to connect what may be near, then, where pairs were left out, all that are still open.
    open_ = stored(still_open(members, first), "open")
    dropped(members)
    tried = block_pairs(open_, sketches, percent, forest=True)
    near = stored(pairs_of(tried), "pairs")
    links = hub_links.unionByName(stored(verified(near, texts, n, percent), "links"))
    second = stored(connected(links), "roots")
    again = tried.select(F.col("again").alias("key")).where("key is not null").distinct()
    left = still_open(open_.drop("root").join(again, "key", "left_semi"), second)
    rest = stored(pairs_of(block_pairs(left, sketches, percent, forest=False)), "pairs")
    more = stored(verified(rest, texts, n, percent), "links")
    dropped(open_, sketches, tried, texts)
    roots = connected(links.unionByName(more)).withColumnRenamed("node", "set_id")

    placed = sets.select(key, "digest", "n_shingles", "set_id").join(roots, "set_id", "left")
    root = F.when(F.col("n_shingles") > 0, F.coalesce("root", "set_id"))
    placed = placed.withColumn("_root", root)
    least = placed.where("_root is not null").groupBy("_root").agg(F.min(key).alias("_component"))
    return placed.join(least, "_root", "left").select(
        key,
        "digest",
        "n_shingles",
        F.col("_root").alias("root"),
        F.coalesce("_component", key).alias("component_id"),
    )
