"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A model is a set of byte strings with integer costs. The best segmentation of a
pre-token has the least total cost, then the fewest tokens. Its forward scores
depend on the bytes read so far only, so the distinct pre-tokens of a batch are
walked as a trie in depth-first order: a shared beginning is scored once, and the
count at each terminal is stored for all texts that hold the pre-token.

Costs are integers (1/1024 bit), so results do not depend on the order of sums.
Where no unigram model is at hand, ``rank_costs`` takes token shares that fall as
one over the rank (Zipf's law) from a vocabulary's ranks; nothing is trained.

Cases: null or empty text has no pre-tokens and counts 0; texts are read whole;
repeated rows give repeated results; an empty table gives an empty one. A model
must cover all single bytes, else ValueError.
"""

from __future__ import annotations

import hashlib
from math import log2

from pyspark.sql import DataFrame

from attestry.llm.bpe import parse_ranks
from attestry.llm.common import worker_memory

# Terminals a worker remembers; a full memory is emptied, results do not change.
MAX_TERMINALS = 1_000_000
ROWS = 512


def rank_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Bits, in 1/1024, of a token whose share falls as one over its rank."""
    total = sum(1 / (rank + 1) for rank in ranks.values())
    return {token: round(1024 * log2((rank + 1) * total)) for token, rank in ranks.items()}


class Trie:
    """Counts of pre-tokens; ``terminals`` maps a pre-token to (tokens, cost)."""

    def __init__(self, costs: dict[bytes, int]):
        missing = [b for b in range(256) if bytes((b,)) not in costs]
        if missing:
            raise ValueError(f"the model has no token for byte {missing[0]}")
        self.costs = costs
        self.ends = {token[i:] for token in costs for i in range(len(token))}
        self.terminals: dict[str, tuple[int, int]] = {}

    def insert(self, pretokens) -> None:
        """Score the pre-tokens that have no terminal yet, in depth-first order."""
        new = sorted((p.encode(), p) for p in pretokens if p not in self.terminals)
        costs, ends = self.costs, self.ends
        before, forward = b"", [(0, 0)]  # the path from the root: least cost and tokens per node
        for piece, name in new:
            shared, most = 0, min(len(before), len(piece))
            while shared < most and before[shared] == piece[shared]:
                shared += 1
            del forward[shared + 1 :]
            for end in range(shared + 1, len(piece) + 1):
                best = None
                for start in range(end - 1, -1, -1):
                    token = piece[start:end]
                    if token not in ends:
                        break
                    cost = costs.get(token)
                    if cost is not None:
                        total, count = forward[start]
                        found = (total + cost, count + 1)
                        if best is None or found < best:
                            best = found
                forward.append(best)
            before = piece
            total, count = forward[-1]
            self.terminals[name] = (count, total)


def count_tokens(
    documents: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, n_pretokens, n_tokens and cost (1/1024 bit) of every whole text.

    ``rank_file`` is read by the driver and broadcast: a vocabulary, under a few MB.
    """
    with open(rank_file, "rb") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())
    kind = documents.schema[key].dataType.simpleString()

    def run(batches):
        import gc

        import pyarrow as pa
        import regex

        gc.disable()  # many small objects without cycles
        matches = regex.compile(pattern).findall
        name = f"unigram {hashlib.sha256(content.value).hexdigest()}"
        trie = worker_memory(name, lambda: Trie(rank_costs(parse_ranks(content.value))))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                if len(trie.terminals) > MAX_TERMINALS:
                    trie.terminals.clear()
                rows = [matches(value or "") for value in part.column(1).to_pylist()]
                trie.insert(set().union(*rows))
                look = trie.terminals.__getitem__
                found = [list(map(look, row)) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(f) for f in found], pa.int64()),
                        pa.array([sum(n for n, _ in f) for f in found], pa.int64()),
                        pa.array([sum(c for _, c in f) for f in found], pa.int64()),
                    ],
                    names=[key, "n_pretokens", "n_tokens", "cost"],
                )

    schema = f"`{key}` {kind}, n_pretokens bigint, n_tokens bigint, cost bigint"
    return documents.select(key, text).mapInArrow(run, schema)
