"""Removal of repeated passages by a sparse suffix array.

A byte goes when a string of ``length`` bytes covers it that also starts earlier.
Sorting every suffix of the corpus would shuffle many times its size, so each
string is stood for by one suffix that begins inside it: the place, among the first
``spread`` bytes of the string, whose next ``gram`` bytes have the least hash (the
leftmost of equals). Equal strings choose equal places, so strings are equal if and
only if they choose equally and agree in what lies before and behind the place. One
suffix stands for all strings in a row that choose it.

1. Equal texts are one text, of the earliest row; later rows lose all bytes.
2. Leading grams that occur once in the corpus cannot repeat; the others are sent
   back to the blocks of texts that hold them.
3. The suffixes left, with the bytes before and behind that their strings reach, are
   parted by ranges of their leading bytes (Spark samples the splitters) and sorted.
   Groups of equal leading bytes are sorted on by multikey quicksort, eight bytes at a
   time, in both directions. A string is a class of equal heads in both orders; all of
   a class but the earliest are marked. Groups are compared whole across the borders
   of batches, and equal leading bytes never lie in two ranges.
4. Marks meet their text again.

The hash only chooses; equality is decided by bytes. Suffixes of a gram that occurs
very often are replaced by their single strings, each its own key, after a task has
merged the equal ones it holds; so a passage that any number of texts share is a
stream of one row per task, whatever surrounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import stored

LENGTH = 100
# Text of one block, and text worked on at once.
BLOCK_BYTES = 8 << 20
FLUSH_BYTES = 4 << 20
# A gram that occurs this often is split into single strings.
HOT = 8_192
# Rows of whole groups that are compared at once.
SOLVE_ROWS = 16_384
# Strings that a task remembers to merge equal ones; forgetting costs rows only.
REMEMBERED = 100_000
# Window starts hashed at once; positions inside must fit in 16 bits.
SLICE = 60_000
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def spread_of(length: int) -> int:
    """How many first places of a string are looked at: at most 64, the bits of a mask."""
    return max(1, min(64, 2 * length // 3))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    Texts are UTF-8 bytes, null is empty. Earlier is: smaller doc_id (null last),
    among rows of one id the smaller digest of the text, inside a text the earlier
    start. Rows equal in id and text are as many documents, the first one earliest.
    Texts shorter than ``length`` lose nothing. An empty table gives no rows.
    """
    rows, owners, marked, texts = _marks(docs, length, hot, block_bytes)
    mark_rows = marked.select("rank", F.lit(0).alias("kind"), "off", "mask", F.lit(None).cast("binary").alias("text"))
    text_rows = texts.select(
        "rank", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("off"), F.lit(None).cast("bigint").alias("mask"), "text"
    )
    judged = (
        mark_rows.unionByName(text_rows)
        .repartition("rank")
        .sortWithinPartitions("rank", "kind", "off")
        .mapInArrow(_removing(length), "rank bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )
    judged = stored(judged, "removed")
    first = owners.join(judged, "rank").select(
        F.col("digest").alias("_digest"), F.col("doc_id").alias("_id"), "n_removed", "n_spans", "kept_sha256"
    )
    met = rows.join(
        first, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left"
    )
    met = met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    long = F.col("n_bytes") >= length
    owned = F.col("_digest").isNotNull() & (F.col("_copy") == 1)
    return met.select(
        "doc_id",
        "n_bytes",
        F.when(~long, F.lit(0)).when(owned, F.col("n_removed")).otherwise(F.col("n_bytes")).cast("bigint").alias("n_removed"),
        F.when(~long, F.lit(0)).when(owned, F.col("n_spans")).otherwise(F.lit(1)).cast("bigint").alias("n_spans"),
        F.when(~long, F.lower(F.hex("digest")))
        .when(owned, F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
        .otherwise(F.lit(EMPTY_SHA))
        .alias("kept_sha256"),
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, start, stop): byte ranges to remove, from the first row of each text.

    Later rows of an equal text are removed whole and have no row here.
    """
    _, owners, marked, _ = _marks(docs, length, hot, block_bytes)
    starts = marked.select(
        "rank", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda a: F.bit_get("mask", a) == 1)).alias("_a"), "off"
    ).select("rank", (F.col("off") - F.col("_a")).alias("start"))
    before = Window.partitionBy("rank").orderBy("start")
    runs = starts.withColumn("_new", F.coalesce((F.col("start") - F.lag("start").over(before) > length).cast("int"), F.lit(1)))
    runs = runs.withColumn("_run", F.sum("_new").over(before))
    spans = runs.groupBy("rank", "_run").agg(F.min("start").alias("start"), (F.max("start") + length).alias("stop"))
    return spans.join(owners, "rank").select("doc_id", "start", "stop")


def _marks(docs: DataFrame, length: int, hot: int, block_bytes: int):
    """(rows, owners, marks, texts): what is repeated, as bits of strings around a place.

    A mark (rank, off, mask) says: of the text ``rank``, the string that starts at
    ``off - a`` starts earlier too, for every bit a of ``mask``.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    given = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = stored(
        given.groupBy("doc_id", "digest").agg(
            F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).cast("bigint").alias("n_bytes")
        ),
        "rows",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"))
    first = (
        rows.where(F.col("n_bytes") >= length)
        .groupBy("digest")
        .agg(F.min(order).alias("_first"), F.max("n_bytes").alias("n_bytes"))
        .orderBy("_first", "digest")
        .select("digest", "_first.doc_id", "n_bytes", F.monotonically_increasing_id().alias("_id"))
    )
    first = stored(first, "first")
    # The row number in the whole order: one count per partition of the sorted table.
    part, spark = F.shiftright("_id", 33), docs.sparkSession
    sizes = first.groupBy(part.alias("part")).agg(F.count(F.lit(1)), F.sum("n_bytes")).orderBy("part").collect()
    before, total, bytes_ = [], 0, 0
    for number, size, held in sizes:
        before.append((number, total))
        total, bytes_ = total + size, bytes_ + held
    shifts = spark.createDataFrame(before, "_part bigint, _before bigint")
    owners = first.join(shifts, part == F.col("_part")).select(
        "digest", "doc_id", (F.col("_before") + F.col("_id").bitwiseAND(2**33 - 1)).alias("rank")
    )
    owners = stored(owners, "owners")

    blocks = max(1, -(-bytes_ // block_bytes))
    # Only the row that owns a text is kept, so copies need not be sorted before they are sent; rows
    # equal in id and text are made one in the order of the join.
    named = F.when(F.col("doc_id").isNotNull(), F.concat(F.lit("="), F.col("doc_id").cast("string")))
    row = F.concat("digest", F.coalesce(named, F.lit("")).cast("binary")).alias("_row")
    held = given.where(F.octet_length("text") >= length).select(row, "text")
    unique = held.join(owners.select(row, "rank"), "_row").dropDuplicates(["_row"])
    texts = unique.select(
        "rank", F.pmod(F.xxhash64("rank"), F.lit(blocks)).cast("int").alias("block"), "text"
    )
    texts = stored(texts, "texts")

    grams = texts.select("block", "text").mapInArrow(_grams(length), "hash bigint, block int, n int")
    total = F.sum("n").over(Window.partitionBy("hash"))
    met = grams.withColumn("_total", total).where("_total > 1")
    met = stored(met.select("block", "hash", (F.col("_total") >= hot).alias("hot")), "grams")

    places = met.select(
        "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("rank"), "hash", "hot", F.lit(None).cast("binary").alias("text")
    )
    holders = texts.select(
        "block", F.lit(1).alias("kind"), "rank", F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("boolean").alias("hot"), "text"
    )
    suffixes = (
        places.unionByName(holders)
        .repartition("block")
        .sortWithinPartitions("block", "kind", "rank")
        .mapInArrow(
            _suffixes(length),
            "lead binary, rank bigint, off int, least int, most int, ahead binary, behind binary, mask bigint",
        )
    )
    suffixes = stored(suffixes, "suffixes")
    solved = (
        suffixes.where(F.col("lead").isNotNull())
        .drop("mask")
        .repartitionByRange("lead")
        .sortWithinPartitions("lead", "rank", "off")
        .mapInArrow(_comparing(length), "rank bigint, off int, mask bigint")
    )
    done = suffixes.where(F.col("lead").isNull()).select("rank", "off", "mask")
    return rows, owners, stored(solved.unionByName(done), "marks"), texts


def anchors(blob, text_ends, length: int):
    """Places that stand for the strings of ``blob``, slice by slice.

    ``blob`` holds texts one after the other, ``text_ends`` their ends. Yields
    arrays (place, first, last, hash): the strings that start at first..last, all
    inside one text, are those the place stands for. A slice border may part one
    row of strings in two.
    """
    import numpy as np

    spread = spread_of(length)
    gram = length - spread + 1
    if len(blob) < length:
        return
    valid = np.ones(len(blob), dtype=bool)
    tails = text_ends[:, None] - np.arange(1, length)[None, :]
    valid[np.maximum(tails.ravel(), 0)[tails.ravel() >= 0]] = False
    base = 0x9E3779B97F4A7C15
    size = SLICE + length
    powers = np.full(size, base, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(size, pow(base, -1, 2**64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    within = np.uint64(0xFFFF)
    step = 1
    while step * 2 <= spread:
        step *= 2
    for start in range(0, len(blob) - length + 1, SLICE):
        stop = min(start + SLICE, len(blob) - length + 1)
        here = valid[start:stop]
        if not here.any():
            continue
        data = blob[start : stop + length - 1].astype(np.uint64)
        data += np.uint64(1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(data * powers[: len(data)], out=sums[1:])
        mixed = (sums[gram:] - sums[:-gram]) * inverse[: len(sums) - gram]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        key = (mixed & ~within) | np.arange(len(mixed), dtype=np.uint64)
        width = 1
        while width < step:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        count = stop - start
        least = np.minimum(key[:count], key[spread - step : spread - step + count])
        place = (least & within).astype(np.int64)
        same = place[1:] == place[:-1]
        opens, closes = here.copy(), here.copy()
        opens[1:] &= ~(here[:-1] & same)
        closes[:-1] &= ~(here[1:] & same)
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        at = place[first]
        yield at + start, first + start, last + start, mixed[at].view(np.int64)


def _flushes(batches, names, limit=FLUSH_BYTES):
    """Rows of ``batches`` gathered to lists whose texts hold about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for row in zip(*columns):
            values = [v.as_py() for v in row]
            held.append(values)
            size += len(values[-1])
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _grams(length: int):
    def find(batches):
        import numpy as np
        import pyarrow as pa

        for held in _flushes(batches, ["block", "text"]):
            ends = np.cumsum([len(t) for _, t in held])
            blob = np.frombuffer(b"".join(t for _, t in held), dtype=np.uint8)
            blocks = np.array([b for b, _ in held], dtype=np.int64)
            hashes, of = [], []
            for at, _, _, mixed in anchors(blob, ends, length):
                new = np.append(True, at[1:] != at[:-1])
                hashes.append(mixed[new])
                of.append(blocks[np.searchsorted(ends, at[new], side="right")])
            if not hashes:
                continue
            hashes, of = np.concatenate(hashes), np.concatenate(of)
            order = np.lexsort((of, hashes))
            hashes, of = hashes[order], of[order]
            first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])))
            n = np.diff(np.append(first, len(hashes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[first]), pa.array(of[first], pa.int32()), pa.array(n, pa.int32())],
                ["hash", "block", "n"],
            )

    return find


def _suffixes(length: int):
    """Suffixes of the grams that a block was told to repeat, with the bytes around them."""
    spread = spread_of(length)
    gram = length - spread + 1

    def find(batches):
        import numpy as np
        import pyarrow as pa

        names = ["lead", "rank", "off", "least", "most", "ahead", "behind", "mask"]
        kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
        seen: dict = {}

        def table(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
            )

        def is_later(key, where):
            """Whether the string was met at an earlier place; else it is remembered here."""
            known = seen.get(key)
            if known is not None and known < where:
                return True
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen[key] = where
            return False

        def signed(mask):
            return mask - 2**64 if mask >= 2**63 else mask

        def rows_of(texts, known, hot):
            ranks = [r for r, _ in texts]
            lengths = np.array([len(t) for _, t in texts])
            ends = np.cumsum(lengths)
            data = b"".join(t for _, t in texts)
            blob = np.frombuffer(data, dtype=np.uint8)
            for at, first, last, mixed in anchors(blob, ends, length):
                place = np.searchsorted(known, mixed)
                place[place == len(known)] = 0
                met = np.flatnonzero(known[place] == mixed)
                owner = np.searchsorted(ends, at[met], side="right")
                offset = at[met] - (ends[owner] - lengths[owner])
                for p, i, j, o, off, often in zip(
                    at[met].tolist(), first[met].tolist(), last[met].tolist(),
                    owner.tolist(), offset.tolist(), hot[place[met]].tolist(),
                ):
                    least, most, where = p - j, p - i, (ranks[o], off)
                    mask = 0
                    if often:
                        for a in range(least, most + 1):
                            string = data[p - a : p - a + length]
                            if is_later(string, where):
                                mask |= 1 << a
                            else:
                                yield (string, ranks[o], off, a, a, b"", b"", None)
                    else:
                        around = data[i : j + length]
                        if is_later((around, least, most), where):
                            mask = ((1 << (most - least + 1)) - 1) << least
                        else:
                            yield (
                                data[p : p + gram], ranks[o], off, least, most,
                                data[p + gram : j + length], data[i:p][::-1], None,
                            )
                    if mask:
                        yield (None, ranks[o], off, None, None, None, None, signed(mask))

        def work(texts, known, hot):
            rows = []
            for row in rows_of(texts, known, hot):
                rows.append(row)
                if len(rows) >= 20_000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)

        block, hashes, hots, known, hot = None, [], [], None, None
        texts, size, last_rank = [], 0, None
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("block", "kind", "rank", "hash", "hot", "text")]
            for b, kind, rank, mixed, often, text in zip(*(c.to_pylist() for c in columns)):
                if b != block:
                    if texts:
                        yield from work(texts, known, hot)
                    block, hashes, hots, known = b, [], [], None
                    texts, size, last_rank = [], 0, None
                if kind == 0:
                    hashes.append(mixed)
                    hots.append(often)
                    continue
                if known is None:
                    known, index = np.unique(np.array(hashes, dtype=np.int64), return_index=True)
                    hot = np.array(hots, dtype=bool)[index]
                if not len(known) or rank == last_rank:
                    continue
                last_rank = rank
                texts.append((rank, text))
                size += len(text)
                if size >= FLUSH_BYTES:
                    yield from work(texts, known, hot)
                    texts, size = [], 0
        if texts:
            yield from work(texts, known, hot)

    return find


def _padded(column, width: int):
    """A binary column as a matrix of bytes, filled up with zeros."""
    import numpy as np

    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros((len(column), width), dtype=np.uint8), np.zeros(len(column), dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    sizes = np.diff(offsets).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.uint8)
    row = np.repeat(np.arange(len(column)), sizes)
    flat = data[offsets[0] : offsets[-1]]
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out, sizes


def multikey_order(groups, matrix):
    """Order of rows by group and then by their bytes, and the bytes neighbours share.

    Multikey quicksort with eight bytes as a key: only rows that are equal so far
    are sorted on by the next eight. Returns (order, shared); ``shared[i]`` is the
    number of first bytes that row i of the order has in common with the row before,
    -1 where the group is another one.
    """
    import numpy as np

    count, width = matrix.shape
    wide = np.zeros((count, -(-width // 8) * 8), dtype=np.uint8)
    wide[:, :width] = matrix
    words = wide.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    run = np.zeros(count, dtype=np.int64)  # runs of rows equal so far, along the order
    run[1:] = np.cumsum(groups[order][1:] != groups[order][:-1])
    for k in range(words.shape[1]):
        size = np.bincount(run)
        open_ = np.flatnonzero(size[run] > 1)
        if not len(open_):
            break
        rows = order[open_]
        word = words[rows, k]
        inner = np.lexsort((word, run[open_]))
        order[open_] = rows[inner]
        word = words[order, k]
        run = np.concatenate([[0], np.cumsum((run[1:] != run[:-1]) | (word[1:] != word[:-1]))])
    shared = np.full(count, -1, dtype=np.int64)
    alike = np.flatnonzero(groups[order][1:] == groups[order][:-1]) + 1
    unlike = matrix[order[alike]] != matrix[order[alike - 1]]
    shared[alike] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    return order, shared


def marks_of(groups, least, most, ahead, behind, spread: int):
    """Masks of the strings that an earlier row of the group holds too.

    Rows stand in order of place inside a group. The string a of a row is its first
    ``spread - 1 - a`` bytes ahead and its first a bytes behind.
    """
    import numpy as np

    count = len(groups)
    forth, shared_forth = multikey_order(groups, ahead)
    back, shared_back = multikey_order(groups, behind)
    masks = np.zeros(count, dtype=np.uint64)
    of_forth, of_back = np.empty(count, dtype=np.int64), np.empty(count, dtype=np.int64)
    for a in range(spread):
        rows = np.flatnonzero((least <= a) & (a <= most))
        if len(rows) < 2:
            continue
        of_forth[forth] = np.cumsum(shared_forth < spread - 1 - a)
        of_back[back] = np.cumsum(shared_back < a)
        string = of_forth[rows] * (count + 1) + of_back[rows]
        order = np.argsort(string, kind="stable")
        later = np.flatnonzero(string[order][1:] == string[order][:-1]) + 1
        masks[rows[order[later]]] |= np.uint64(1) << np.uint64(a)
    return masks


def _comparing(length: int):
    spread = spread_of(length)

    def compare(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def found(table, masks):
            at = np.flatnonzero(masks)
            taken = pa.array(at)
            return pa.RecordBatch.from_arrays(
                [
                    table.column("rank").take(taken).combine_chunks(),
                    table.column("off").take(taken).combine_chunks(),
                    pa.array(masks[at].view(np.int64)),
                ],
                ["rank", "off", "mask"],
            )

        def column(table, name):
            chunk = table.column(name).combine_chunks()
            return chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk

        def changes(table):
            """Whether a row's leading bytes differ from those of the row before; the first one's do."""
            lead, sizes = _padded(column(table, "lead"), length)
            new = np.ones(len(lead), dtype=bool)
            new[1:] = (sizes[1:] != sizes[:-1]) | (lead[1:] != lead[:-1]).any(axis=1)
            return new, sizes

        def solve(table, new):
            ahead, _ = _padded(column(table, "ahead"), max(1, spread - 1))
            behind, _ = _padded(column(table, "behind"), max(1, spread - 1))
            return marks_of(
                np.cumsum(new), table.column("least").to_numpy(), table.column("most").to_numpy(),
                ahead, behind, spread,
            )

        before = None  # leading bytes of the single string met last
        rest, parts = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            # Single strings: the first row of equal leading bytes is the earliest.
            whole = pc.equal(pc.binary_length(table.column("lead")), length)
            single, other = table.filter(whole), table.filter(pc.invert(whole))
            if single.num_rows:
                new, _ = changes(single)
                if before is not None and single.column("lead")[0].as_py() == before:
                    new[0] = False
                before = single.column("lead")[-1].as_py()
                bit = np.uint64(1) << single.column("least").to_numpy().astype(np.uint64)
                masks = np.where(new, np.uint64(0), bit)
                yield found(single, masks)
            if not other.num_rows:
                continue
            rest = other if rest is None else pa.concat_tables([rest, other])
            if rest.num_rows - parts < SOLVE_ROWS:
                continue
            rest = rest.combine_chunks()
            new, _ = changes(rest)
            cut = int(np.flatnonzero(new)[-1])
            if cut:
                ready = rest.slice(0, cut)
                yield found(ready, solve(ready, new[:cut]))
                rest = rest.slice(cut).combine_chunks()
            parts = rest.num_rows  # a group that goes on is not looked at after every batch
        if rest is not None and rest.num_rows:
            rest = rest.combine_chunks()
            yield found(rest, solve(rest, changes(rest)[0]))

    return compare


def _removing(length: int):
    """What is left of every text, from its marks, which come before it."""

    def remove(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        bits = np.arange(64, dtype=np.uint64)

        def judge(text, offsets, masks):
            masks = np.array(masks, dtype=np.int64).view(np.uint64)
            row, a = np.nonzero((masks[:, None] >> bits[None, :]) & np.uint64(1))
            starts = np.array(offsets, dtype=np.int64)[row] - a
            change = np.zeros(len(text) + 1, dtype=np.int32)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            return int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()

        of, offsets, masks = None, [], []
        for batch in batches:
            out = []
            for rank, kind, off, mask, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if rank != of:
                        of, offsets, masks = rank, [], []
                    offsets.append(off)
                    masks.append(mask)
                elif rank == of and offsets:
                    out.append((rank, *judge(text, offsets, masks)))
                    offsets, masks = [], []
                else:
                    out.append((rank, 0, 0, None))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    ["rank", "n_removed", "n_spans", "kept_sha256"],
                )

    return remove
