"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

The merge table is a set of byte strings with ranks. The encoding of a byte
string is the one chain of tokens of which every neighbouring pair encodes to
itself, so a left-to-right machine can follow all beginnings of a chain at once:

* A state is the last emitted token and the bytes read since. These fix the
  chains that are still open, one for each position from which a longer token
  could start.
* Reading a byte finds the one token that ends the chain there, drops positions
  whose rest begins no token, and emits what all open chains agree on. The
  lookahead is bounded by the longest token.
* States and transitions are built when first met and then looked up.

Decoding runs over chunks of ids and passes bytes through an incremental UTF-8
state machine, so no character is cut where a chunk ends.

Cases: null text counts as empty (no ids); texts of any length are cut only at
match boundaries of the pattern; lone surrogates cannot occur in a string column.
Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame

from attestry.llm.common import worker_memory

# Bounds of what a worker remembers. Full states, pairs and pieces keep what they have, full
# chunks are emptied; what is not remembered is computed when met, so results do not change.
MAX_STATES = 200_000
MAX_PAIRS = 400_000
MAX_PIECES = 300_000
MAX_CHUNKS = 500_000
# Bytes of a match that are taken in one step once they have been met.
STRIDE = 6
# What a byte string may be: a token, the beginning of a longer one, or both.
TOKEN, BEGINS = 1, 2
# Characters of texts that are split at a time.
SPLIT = 4_000_000
# Matches taken from a text at a time, and ids decoded at a time.
CHUNK = 200_000

OUTPUTS = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "ids_sha256": "string",
    "decoded": "string",
    "decoded_sha256": "string",
}


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank from the lines of a rank file."""
    pairs = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(piece: bytes, ranks: dict[bytes, int], below: float = float("inf")) -> list[bytes]:
    """Plain merging: join the neighbours of lowest rank, leftmost first, while it is under ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and rank < best:
                best, at = rank, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class State:
    __slots__ = ("chains", "last", "next", "rest")

    def __init__(self, last, rest, chains):
        self.last = last  # last emitted token, None before the first
        self.rest = rest  # bytes read since
        self.chains = chains  # (open position in ``rest``, chain of tokens up to it), ascending
        self.next = {}  # byte -> (state, emitted ids), or None: met once


class Transducer:
    """Encodes one pattern match at a time."""

    def __init__(self, ranks: dict[bytes, int], remember: float = 1.0):
        self.ranks = ranks
        self.remember = remember
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.starts = {token[:i] for token in ranks for i in range(1, len(token))}
        self.kinds = dict.fromkeys(self.starts, BEGINS)
        for token in ranks:
            self.kinds[token] = self.kinds.get(token, 0) | TOKEN
        self.made: dict[bytes, list[bytes]] = {}
        self.pairs: dict[tuple, bool] = {}
        self.start = State(None, b"", [(0, ())])
        self.states = {(None, b""): self.start}
        self.jumps = {}  # first STRIDE bytes of a match -> where they lead

    def halves(self, token: bytes) -> list[bytes]:
        """The two parts whose merge made ``token``; empty for one byte or if no merge makes it."""
        parts = self.made.get(token)
        if parts is None:
            parts = merge(token, self.ranks, self.ranks[token]) if len(token) > 1 else ()
            parts = self.made[token] = parts if len(parts) == 2 else ()
        return parts

    def fits(self, left: bytes | None, right: bytes) -> bool:
        """Whether ``right`` may follow ``left``: together they encode to just these two.

        Merges are undone from the last one back. The two byte strings that touch
        at the border then stood side by side until the merge undone last; they
        must not have been mergeable before it.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = len(right) == 1 or bool(self.halves(right))
            if known and left is not None:
                known = self.stays_apart(left, right)
            if len(self.pairs) < MAX_PAIRS * self.remember:
                self.pairs[left, right] = known
        return known

    def stays_apart(self, left: bytes, right: bytes) -> bool:
        ranks, until = self.ranks, float("inf")
        while True:
            if ranks.get(left + right, until) < until:
                return False
            made_left = ranks[left] if len(left) > 1 else -1
            made_right = ranks[right] if len(right) > 1 else -1
            if made_left > made_right:
                # Of equal ranks the leftmost merge comes first, so an equal one is harmless here
                until, left = made_left, self.halves(left)[1]
            elif made_right >= 0:
                # and not here.
                until, right = made_right + 1, self.halves(right)[0]
            else:
                return True

    def closing(self, chains, last: bytes | None, rest: bytes) -> tuple[bytes, ...]:
        """The chain that covers ``rest``, which is one byte longer than the open ``chains``."""
        ranks, pairs = self.ranks, self.pairs
        for position, chain in chains:  # the longest last token first
            token = rest[position:]
            if token in ranks:
                left = chain[-1] if chain else last
                known = pairs.get((left, token))
                if known or known is None and self.fits(left, token):
                    return (*chain, token)
        raise ValueError(f"byte {rest[-1]} cannot be encoded")

    def finish(self, state: State, left: bytes) -> bytes:
        """All packed ids still to come when ``left`` ends the match; builds no states."""
        if not left:
            return b"".join([self.packed[t] for t in state.chains[-1][1]])
        kinds, pairs, chains = self.kinds, self.pairs, state.chains
        rest, until = state.rest + left, len(state.rest) + len(left)
        for end in range(len(state.rest) + 1, until + 1):
            still, closed = [], None
            for opened in chains:  # the longest last token first
                token = rest[opened[0] : end]
                kind = kinds.get(token)
                if kind is None:
                    continue
                if closed is None and kind & TOKEN:
                    chain = opened[1]
                    before = chain[-1] if chain else state.last
                    known = pairs.get((before, token))
                    if known or known is None and self.fits(before, token):
                        closed = (*chain, token)
                        if end == until:
                            break
                if kind & BEGINS:
                    still.append(opened)
            if closed is None:
                raise ValueError(f"byte {rest[end - 1]} cannot be encoded")
            still.append((end, closed))
            chains = still
        return b"".join([self.packed[t] for t in closed])

    def step(self, state: State, byte: int) -> tuple[State, bytes]:
        """The transition of ``state`` by ``byte``, built once."""
        rest, starts = state.rest + bytes((byte,)), self.starts
        chains = [(p, chain) for p, chain in state.chains if rest[p:] in starts]
        chains.append((len(rest), self.closing(state.chains, state.last, rest)))
        first, agreed = chains[0][1], 0
        for token in first:
            for _, chain in chains:
                if len(chain) <= agreed or chain[agreed] is not token:
                    break
            else:
                agreed += 1
                continue
            break
        last, emitted = state.last, b""
        if agreed:
            cut, last = sum(map(len, first[:agreed])), first[agreed - 1]
            emitted = b"".join([self.packed[t] for t in first[:agreed]])
            rest, chains = rest[cut:], [(p - cut, c[agreed:]) for p, c in chains]
        target = self.states.get((last, rest))
        if target is None:
            target = self.states[last, rest] = State(last, rest, chains)
        arc = state.next[byte] = (target, emitted)
        return arc

    def encode(self, piece: bytes) -> bytes:
        """Packed ids: little-endian, 32 bits each."""
        whole = self.packed.get(piece)
        if whole is not None:
            return whole
        head, at = piece[:STRIDE], STRIDE
        begun = self.jumps.get(head)
        if begun is None:
            begun, at = (self.start, b""), 0
        state, ids = begun
        end = len(piece) - 1
        for i in range(at, len(piece)):
            byte = piece[i]
            arc = state.next.get(byte)
            if arc is None:
                # Built when met for the second time: most ends of rare words are met once.
                if i == end or byte not in state.next or len(self.states) >= MAX_STATES * self.remember:
                    state.next[byte] = None
                    return ids + self.finish(state, piece[i:])
                arc = self.step(state, byte)
            state, emitted = arc
            ids += emitted
            if i == STRIDE - 1:
                self.jumps[head] = state, ids
        return ids + self.finish(state, b"")


class Pieces(dict):
    """Match of the pattern -> its ids as little-endian 32-bit numbers, computed when first met."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        packed = self.transducer.encode(piece.encode())
        if len(self) < MAX_PIECES * self.transducer.remember and len(piece) <= 64:
            self[piece] = packed
        return packed


class Uneven(Exception):
    """A run of white space other than one space: the text has to be matched as a whole."""


class Chunks(dict):
    """What stands between two single spaces -> ids of its matches, the space before included.

    A space between two characters that are no white space always begins a match,
    so a text can be cut there and every distinct chunk be matched once.
    """

    def __init__(self, pieces: Pieces, pattern):
        super().__init__()
        self.pieces, self.pattern = pieces, pattern

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha():  # one match
            packed = self.pieces.transducer.encode(b" " + chunk.encode())
        elif chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":  # two matches
            packed = self[chunk[:-1]] + self.pieces[chunk[-1]]
        elif not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Uneven
        else:
            found = self.pattern.findall(" " + chunk)
            packed = b"".join(map(self.pieces.__getitem__, found))
        if len(chunk) <= 64:
            self[chunk] = packed
        return packed

    def prepare(self, texts: list[str]) -> None:
        """Encode the new chunks of these texts."""
        self.learn([text.split(" ") for text in texts])

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the new chunks of these split texts in order, so that neighbours share their states."""
        met = set().union(*texts)
        if len(self) > MAX_CHUNKS * self.pieces.transducer.remember:
            # What these texts hold is likely to be met again.
            kept = {chunk: self[chunk] for chunk in met if chunk in self}
            self.clear()
            self.update(kept)
        for chunk in sorted(met.difference(self)):
            if chunk.isalpha() or chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
                self[chunk]

    def encode(self, text: str, split: list[str] | None = None) -> bytes:
        """Packed ids of a whole text; ``split`` is the text split at single spaces."""
        first, *rest = text.split(" ") if split is None else split
        if first and not first[-1].isspace():
            try:
                packed = b"".join(map(self.__getitem__, rest))
                return self.match(first) + packed
            except Uneven:
                pass
        return self.match(text)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text; each is split once, some texts together."""
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= SPLIT):
                size += len(texts[stop])
                stop += 1
            split = [text.split(" ") for text in texts[start:stop]]
            self.learn(split)
            yield from map(self.encode, texts[start:stop], split)
            start = stop

    def match(self, text: str) -> bytes:
        lookup = self.pieces.__getitem__
        if len(text) <= CHUNK:
            return b"".join(map(lookup, self.pattern.findall(text)))
        matches = (m.group() for m in self.pattern.finditer(text))
        out = []
        while part := list(islice(matches, CHUNK)):
            out.append(b"".join(map(lookup, part)))
        return b"".join(out)


class Utf8Machine:
    """Incremental UTF-8: bytes in, whole characters out, the begun one kept.

    The state is the begun character. Malformed input raises, or becomes U+FFFD
    with ``errors="replace"``.
    """

    def __init__(self, errors: str = "strict"):
        self.begun = b""
        self.errors = errors

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                break
            if byte >= 0xC0:
                wanted = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                if wanted > back:
                    cut -= back
                break
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", self.errors)

    def finish(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", self.errors)


def decode_ids(ids: Iterable[int], tokens, errors: str = "strict") -> Iterator[tuple[bytes, str]]:
    """Bytes and text of ids, chunk by chunk."""
    machine, ids = Utf8Machine(errors), iter(ids)
    while part := list(islice(ids, CHUNK)):
        data = b"".join(map(tokens.__getitem__, part))
        yield data, machine.feed(data)
    if tail := machine.finish():
        yield b"", tail


def machinery(rank_lines: bytes, pattern: str, remember: float = 1.0) -> tuple[Chunks, dict[int, bytes]]:
    """The encoder of a rank file, and the bytes of each id."""
    import regex

    ranks = parse_ranks(rank_lines)
    chunks = Chunks(Pieces(Transducer(ranks, remember)), regex.compile(pattern))
    return chunks, {rank: token for token, rank in ranks.items()}


def encode_decode(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
    remember: float = 1.0,
) -> DataFrame:
    """``key`` and the wanted ``outputs`` (see ``OUTPUTS``) for every document.

    ``ids`` and ``decoded`` are the real results; the digests are over the ids as
    little-endian unsigned 32-bit numbers and over the decoded bytes. ``rank_file``
    is read by the driver and broadcast: a vocabulary, under a few MB. ``remember``
    scales what a worker remembers: less memory, more time, the same result.
    """
    spark = documents.sparkSession
    with open(rank_file, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    if key in OUTPUTS:
        raise ValueError(f"{key} is the name of an output")
    wanted = tuple(outputs)
    rows = documents.select(key, text)
    kind = documents.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", *(f"{name} {OUTPUTS[name]}" for name in wanted)])

    def run(batches):
        import gc

        import numpy as np
        import pyarrow as pa

        gc.disable()  # the memory below is many small objects without cycles
        name = f"bpe {hashlib.sha256(content.value).hexdigest()} {pattern} {remember}"
        chunks, tokens = worker_memory(name, lambda: machinery(content.value, pattern, remember))
        decoding = "decoded" in wanted or "decoded_sha256" in wanted
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns = {name: [] for name in wanted}
                texts_ = [value or "" for value in part.column(1).to_pylist()]
                for packed in chunks.encode_all(texts_):
                    ids = np.frombuffer(packed, dtype="<u4")
                    row = {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(packed).hexdigest()}
                    if "ids" in columns:
                        row["ids"] = ids.astype("int32")
                    if decoding:
                        digest, texts = hashlib.sha256(), []
                        for data, piece in decode_ids(ids.tolist(), tokens):
                            digest.update(data)
                            texts.append(piece)
                        row["decoded_sha256"] = digest.hexdigest()
                        row["decoded"] = "".join(texts)
                    for name in wanted:
                        columns[name].append(row[name])
                kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)]
                    + [pa.array(columns[n], type=kinds.get(n, pa.string())) for n in wanted],
                    names=[key, *wanted],
                )

    return rows.mapInArrow(run, schema)
