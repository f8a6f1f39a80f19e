"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered. For a cluster with centre c, whose anchors lie within the
angle w of it, no anchor a scores a candidate v above

    |a| |v| cos(max(0, angle(v, c) - w))

so one order of all candidates, by ``|v| cos(...)``, serves every anchor of the
cluster. The list is cut into segments at places that a histogram of all bounds
gives; a segment is made and sorted once, when the first anchor reaches it. An
anchor walks the list until the bound says that nothing behind can matter to it,
so its result is certain. Positives are walked for first; their scores fix the
windows in which negatives are searched, over the same lists.

Rows equal in vector and label tie for every anchor, so ties by key pick the
smallest keys. Of such a group only as many keys are carried as one result can
hold; that loses nothing, and a vector that a third of all rows share costs no
more than others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import stored

# Anchors the centres are fitted on, at most. Centres decide how long the lists
# are that an anchor walks, not what it finds.
FIT_ANCHORS = 4096
MAX_CLUSTERS = 64
ANCHORS_PER_CLUSTER = 64
# Length of the first segment of a list; each further one is eight times as long.
FIRST_SEGMENT = 16_384
GROWTH = 8
# Candidates and anchors that meet in one task, at most.
LIST_BLOCK = 32_768
ANCHOR_BLOCK = 2_048
# Scores worked out at once.
STEP = 2_048
BINS = 2_048
# Bounds are widened by this, far above the error of doubles.
SLACK = 1e-9


def usable(key: str, label: str, vector: str) -> Column:
    """Rows that take part: key, label and vector given, all components finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite


def mine(
    vectors: DataFrame,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of every anchor: rows whose key is divisible by ``anchor_every``.

    Components become ``floor(scale * x)``; scores are integer inner products,
    higher first, ties by smaller key. For an anchor and each of its first
    ``positives`` other rows of its label, the first ``negatives`` rows of other
    labels with ``low * p <= 100 * score <= high * p``, p the positive's score.
    Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).

    Rows with a null key, label or vector, or a component that is null or not
    finite, take no part. A shorter vector counts as filled up with zeros. Rows
    with equal keys are rows of their own. An empty table gives no rows. Scores
    that may pass 64 bits are an error.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(key, label, vector)).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    widest = F.max(F.coalesce(F.array_max(F.transform("v", lambda c: F.abs(c * scale))), F.lit(0.0)))
    dim, largest = rows.agg(F.max(F.size("v")), widest).first()
    if dim is None:
        return _no_rows(spark)
    dim, largest = max(1, dim), math.ceil(largest) + 1
    if dim * largest * largest >= 2**63:
        raise ArithmeticError(f"scores of {dim} components up to {largest} may pass 64 bits")
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<i8"

    packed = rows.mapInArrow(_packing(dim, scale, kind), "id bigint, label bigint, q binary")
    in_class = Window.partitionBy("q", "label").orderBy("id")
    first = packed.withColumn("_place", F.row_number().over(in_class))
    keep = max(positives + 1, negatives)
    classes = (
        first.where(F.col("_place") <= keep)
        .groupBy("q", "label")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    classes = stored(classes, "classes")
    anchors = packed.where(F.col("id") % anchor_every == 0)
    asking = stored(
        anchors.select("q", "label").distinct().withColumn("member", F.monotonically_increasing_id()),
        "asking",
    )
    lists = Lists(classes, asking, dim, kind, spark)
    if lists.clusters is None:
        return _no_rows(spark)

    # Positives of a class, its own rows among them. No window fits a score below zero.
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("lo"), F.lit(2**63 - 1).alias("hi")))
    nearest = lists.walk(
        lists.members.select("member", whole.alias("windows")), same=True, need=positives + 1
    )
    windows = nearest.select("member", "score").distinct().select(
        "member",
        F.expr(f"cast(({low} * cast(score as decimal(30,0)) + 99) div 100 as bigint)").alias("lo"),
        F.expr(f"cast({high} * cast(score as decimal(30,0)) div 100 as bigint)").alias("hi"),
        "score",
    )
    windows = stored(windows, "windows")
    found = lists.walk(
        windows.groupBy("member").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("windows")),
        same=False,
        need=negatives,
    )

    # An anchor's own row stands among the positives of its class with its own score.
    order = Window.partitionBy("_row").orderBy(F.desc("score"), "id")
    owned = asking.select("q", "label", "member")
    each = stored(
        anchors.join(owned, ["q", "label"]).select("member", F.col("id").alias("anchor_id"), "q"),
        "anchors",
    ).withColumn("_row", F.monotonically_increasing_id())
    each = each.mapInArrow(_own_score(dim, kind), "member bigint, anchor_id bigint, _row bigint, own bigint")
    met = each.join(nearest.select("member", "id", "score"), "member")
    is_own = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))
    own_place = F.row_number().over(Window.partitionBy("_row", is_own).orderBy(F.desc("score"), "id"))
    others = met.withColumn("_nth", own_place).where(~(is_own & (F.col("_nth") == 1)))
    chosen = others.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= positives)
    chosen = chosen.select(
        "member", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    by_window = found.select("member", "lo", "hi", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "place")
    of_score = windows.select("member", "lo", "hi", F.col("score").alias("positive_score"))
    return (
        chosen.join(of_score, ["member", "positive_score"])
        .join(by_window, ["member", "lo", "hi"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )


def _no_rows(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
        " positive_score bigint, negative_score bigint",
    )


def _packing(dim: int, scale: int, kind: str):
    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            v = batch.column(2)
            offsets = v.offsets.to_numpy()
            sizes = np.diff(offsets)
            flat = v.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            q = np.zeros((len(sizes), dim), dtype=kind)
            at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
            q[np.repeat(np.arange(len(sizes)), sizes), at] = np.floor(flat * scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in q], pa.binary())],
                ["id", "label", "q"],
            )

    return pack


def _matrix(column, dim: int, kind: str):
    import numpy as np

    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=kind).reshape(-1, dim)


def _own_score(dim: int, kind: str):
    def score(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            q = _matrix(batch.column(2), dim, kind).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array((q * q).sum(axis=1))],
                ["member", "anchor_id", "_row", "own"],
            )

    return score


def fit_centres(sample, clusters: int, rounds: int = 8):
    """Unit centres of the rows of ``sample`` by k-means on directions."""
    import numpy as np

    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    centres = unit[np.linspace(0, len(unit) - 1, clusters).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-300), centres)
    lost = np.linalg.norm(centres, axis=1) < 0.5  # rows of zeros have no direction
    centres[lost] = np.eye(centres.shape[1])[0]
    return centres


class Lists:
    """The shared lists of all clusters, made segment by segment."""

    def __init__(self, classes: DataFrame, asking: DataFrame, dim: int, kind: str, spark):
        self.classes, self.dim, self.kind, self.spark = classes, dim, kind, spark
        self.clusters = None
        sample = asking.orderBy(F.xxhash64("q", "label")).limit(FIT_ANCHORS).select("q").collect()
        if not sample:
            return
        import numpy as np

        held = np.stack([np.frombuffer(r["q"], dtype=kind) for r in sample]).astype(float)
        asked = asking.count()
        count = max(1, min(MAX_CLUSTERS, asked // ANCHORS_PER_CLUSTER, len(held)))
        self.centres = fit_centres(held, count)
        self.members = stored(
            asking.select("member", "label", "q").mapInArrow(
                _assigning(self.centres, dim, kind),
                "member bigint, label bigint, q binary, cluster int, angle double, norm double",
            ),
            "members",
        )
        per_cluster = self.members.groupBy("cluster").agg(F.max("angle"), F.count(F.lit(1))).collect()
        self.angles = np.zeros(count)
        self.sizes = np.zeros(count, dtype=np.int64)
        for cluster, angle, size in per_cluster:
            self.angles[cluster], self.sizes[cluster] = angle, size
        self.clusters = count
        self._cut()
        self.made: dict[int, list] = {}
        self.made_for: dict[int, set] = {}

    def _cut(self) -> None:
        """Bounds that part the segments of each list, from counts of all bounds."""
        import numpy as np

        largest = self.classes.mapInArrow(_norms(self.dim, self.kind), "norm double").agg(F.max("norm")).first()[0]
        self.top = (largest or 0.0) * (1 + 1e-6) + 1e-6
        counted = (
            self.classes.select("q")
            .mapInArrow(
                _histogram(self.centres, self.angles, self.top, self.dim, self.kind),
                "cluster int, bin int, n bigint",
            )
            .groupBy("cluster", "bin")
            .agg(F.sum("n"))
            .collect()
        )  # at most MAX_CLUSTERS * BINS rows
        bins = np.zeros((self.clusters, BINS), dtype=np.int64)
        for cluster, at, n in counted:
            bins[cluster, at] = n
        behind = np.cumsum(bins[:, ::-1], axis=1)[:, ::-1]  # rows in a bin or a higher one
        self.edges, self.counts = [], []  # lower bin of each segment, rows in it
        upper, size = np.full(self.clusters, BINS), FIRST_SEGMENT
        while upper.max() > 0:
            # The highest bin down to which at least ``size`` rows lie; else all bins.
            reached = behind >= size
            lower = np.where(reached.any(axis=1), BINS - 1 - np.argmax(reached[:, ::-1], axis=1), 0)
            lower = np.minimum(lower, np.maximum(upper - 1, 0))
            padded = np.hstack([behind, np.zeros((self.clusters, 1), dtype=np.int64)])
            rows = padded[np.arange(self.clusters), lower] - padded[np.arange(self.clusters), upper]
            self.edges.append((lower, upper.copy()))
            self.counts.append(rows)
            upper, size = lower, size * GROWTH

    def segment(self, number: int, wanted: list[int]) -> DataFrame:
        """Segment ``number`` of the lists of the ``wanted`` clusters; each is made once."""
        have = self.made_for.setdefault(number, set())
        missing = [c for c in wanted if c not in have]
        if missing:
            lower, upper = self.edges[number]
            blocks = -(-self.counts[number] // LIST_BLOCK)
            made = self.classes.mapInArrow(
                _listing(self.centres, self.angles, self.top, lower, upper, blocks, missing, self.dim, self.kind),
                "cluster int, part int, bound double, label bigint, q binary, ids array<bigint>",
            )
            self.made.setdefault(number, []).append(stored(made, f"segment{number}"))
            have.update(missing)
        frames = self.made[number]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole.where(F.col("cluster").isin([int(c) for c in wanted]))

    def walk(self, windows: DataFrame, same: bool, need: int) -> DataFrame:
        """(member, lo, hi, id, score, place): the first ``need`` rows of each window.

        ``windows`` is (member, windows): for each member an array of (lo, hi). Rows
        of the member's own label count with ``same``, of other labels without.
        """
        members = stored(self.members.join(windows, "member"), "walking")
        best = None
        for number in range(len(self.edges)):
            state = members.withColumn("best", F.expr("cast(array() as array<struct<lo:bigint,hi:bigint,worst:bigint>>)"))
            if best is not None:
                full = best.groupBy("member", "lo", "hi").agg(
                    F.count(F.lit(1)).alias("_n"), F.min("score").alias("worst")
                )
                full = full.where(F.col("_n") >= need).groupBy("member").agg(
                    F.collect_list(F.struct("lo", "hi", "worst")).alias("_full")
                )
                state = members.join(full, "member", "left").withColumn(
                    "best", F.coalesce("_full", F.expr("cast(array() as array<struct<lo:bigint,hi:bigint,worst:bigint>>)"))
                )
            # What is still ahead of a member: the bound at the head of this segment.
            upper = self.edges[number][1]
            width = 2 * self.top / BINS
            heads = [float(u * width - self.top) for u in upper]
            head = F.element_at(F.array(*(F.lit(h) for h in heads)), F.col("cluster") + 1)
            reach = F.col("norm") * (head + SLACK * self.top) * (1 + SLACK) + SLACK
            # A window is open while the bound reaches what it still needs.
            state = state.withColumn(
                "windows",
                F.expr(
                    "transform(windows, w -> named_struct('lo', w.lo, 'hi', w.hi, 'least',"
                    " greatest(w.lo, coalesce(array_max(transform("
                    "filter(best, b -> b.lo = w.lo and b.hi = w.hi), b -> b.worst)), w.lo))))"
                ),
            ).drop("best", "_full")
            state = state.withColumn("_reach", reach).withColumn(
                "windows", F.expr("filter(windows, w -> w.lo <= w.hi and w.least <= _reach)")
            )
            state = stored(state.where(F.size("windows") > 0).drop("_reach"), "open")
            open_clusters = {c: n for c, n in state.groupBy("cluster").agg(F.count(F.lit(1))).collect()}
            if not open_clusters:
                break
            walked = sorted(c for c in open_clusters if self.counts[number][c] > 0)
            if not walked:
                continue
            met = self._meet(state, self.segment(number, walked), number, open_clusters, same, need)
            both = met if best is None else best.unionByName(met)
            order = Window.partitionBy("member", "lo", "hi").orderBy(F.desc("score"), "id")
            best = stored(
                both.drop("place")
                .withColumn("place", F.row_number().over(order))
                .where(F.col("place") <= need),
                "best",
            )
        if best is None:
            return self.spark.createDataFrame(
                [], "member bigint, lo bigint, hi bigint, id bigint, score bigint, place int"
            )
        return best

    def _meet(self, state, segment, number, open_clusters, same, need) -> DataFrame:
        """Blocks of members meet blocks of the segment they walk; each pair keeps its best."""
        blocks = {c: max(1, -(-int(n) // ANCHOR_BLOCK)) for c, n in open_clusters.items()}
        parts = {c: max(1, int(-(-self.counts[number][c] // LIST_BLOCK))) for c in open_clusters}

        def of(values: dict) -> Column:
            return F.element_at(
                F.create_map(*(F.lit(int(x)) for pair in values.items() for x in pair)), F.col("cluster")
            )

        rows = segment.withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks) - 1)))
        asking = state.withColumn("block", F.pmod(F.xxhash64("member"), of(blocks)).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), of(parts) - 1))
        )
        keys = ["cluster", "block", "part"]
        asking = asking.select(*keys, "member", "label", "q", "norm", "windows")
        rows = rows.select(*keys, "bound", "label", "q", "ids")
        return (
            asking.groupBy(*keys)
            .cogroup(rows.groupBy(*keys))
            .applyInArrow(
                _walking(self.dim, self.kind, same, need),
                "member bigint, lo bigint, hi bigint, id bigint, score bigint, place int",
            )
        )


def _assigning(centres, dim: int, kind: str):
    def assign(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            q = _matrix(batch.column(2), dim, kind).astype(float)
            norm = np.linalg.norm(q, axis=1)
            cosine = (q @ centres.T) / np.maximum(norm, 1e-300)[:, None]
            cluster = np.argmax(cosine, axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(q)), cluster], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster, pa.int32()), pa.array(np.where(norm > 0, angle, 0.0)), pa.array(norm)],
                ["member", "label", "q", "cluster", "angle", "norm"],
            )

    return assign


def _norms(dim: int, kind: str):
    def norms(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index("q")
            q = _matrix(batch.column(at), dim, kind).astype(float)
            if len(q):
                yield pa.RecordBatch.from_arrays([pa.array([np.linalg.norm(q, axis=1).max()])], ["norm"])

    return norms


def _bounds(q, centres, angles):
    """``|v| cos(max(0, angle(v, c) - w))`` for rows and centres, rounded up a little."""
    import numpy as np

    norm = np.linalg.norm(q, axis=1)
    cosine = (q @ centres.T) / np.maximum(norm, 1e-300)[:, None]
    apart = np.arccos(np.clip(cosine, -1, 1)) - angles[None, :] - 1e-7
    return norm[:, None] * np.cos(np.maximum(apart, 0.0))


def _bin(bounds, top: float):
    import numpy as np

    return np.clip(((bounds + top) * (BINS / (2 * top))).astype(np.int64), 0, BINS - 1)


def _histogram(centres, angles, top: float, dim: int, kind: str):
    def count(batches):
        import numpy as np
        import pyarrow as pa

        held = np.zeros((len(centres), BINS), dtype=np.int64)
        for batch in batches:
            at = _bin(_bounds(_matrix(batch.column(0), dim, kind).astype(float), centres, angles), top)
            for c in range(len(centres)):
                held[c] += np.bincount(at[:, c], minlength=BINS)
        cluster, bin_no = np.nonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(bin_no, pa.int32()), pa.array(held[cluster, bin_no])],
            ["cluster", "bin", "n"],
        )

    return count


def _listing(centres, angles, top, lower, upper, blocks, wanted, dim: int, kind: str):
    def make(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            raw = columns["q"].to_pylist()
            bounds = _bounds(_matrix(columns["q"], dim, kind).astype(float), centres, angles)
            at = _bin(bounds, top)
            spread = np.fromiter((zlib.crc32(x) for x in raw), dtype=np.int64, count=len(raw))
            for c in wanted:
                listed = np.flatnonzero((at[:, c] >= lower[c]) & (at[:, c] < upper[c]))
                if len(listed):
                    taken = pa.array(listed)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(listed), c), pa.int32()),
                            pa.array(spread[listed] % max(1, int(blocks[c])), pa.int32()),
                            pa.array(bounds[listed, c]),
                            columns["label"].take(taken),
                            columns["q"].take(taken),
                            columns["ids"].take(taken),
                        ],
                        ["cluster", "part", "bound", "label", "q", "ids"],
                    )

    return make


def _walking(dim: int, kind: str, same: bool, need: int):
    """One block of members walks one block of a list, best bounds first."""

    def walk(asking, rows):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema(
            [("member", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("place", pa.int32())]
        )
        if not asking.num_rows or not rows.num_rows:
            return schema.empty_table()
        bound = rows.column("bound").to_numpy()
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        q = _matrix(rows.column("q"), dim, kind)[order]
        labels = rows.column("label").to_numpy()[order]
        ids = rows.column("ids").to_pylist()
        anchors = _matrix(asking.column("q"), dim, kind)
        exact = float(dim) * float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(anchors.astype(float)).max(initial=0)) < 2**52
        as_type = np.float64 if exact else np.int64
        q, anchors = q.astype(as_type), anchors.astype(as_type)
        members = asking.column("member").to_numpy()
        own = asking.column("label").to_numpy()
        norms = asking.column("norm").to_numpy()
        windows = [[(w["lo"], w["hi"], w["least"]) for w in ws] for ws in asking.column("windows").to_pylist()]
        held = [[[] for _ in ws] for ws in windows]  # (-score, id), the first ``need``
        least = [[w[2] for w in ws] for ws in windows]
        active = np.arange(len(members))
        slack = SLACK * (1 + np.abs(bound).max())
        for start in range(0, len(q), STEP):
            goal = np.array([min(least[m]) for m in active])
            active = active[goal <= norms[active] * (bound[start] + slack) + slack]
            if not len(active):
                break
            scores = (anchors[active] @ q[start : start + STEP].T).astype(np.int64)
            alike = own[active][:, None] == labels[None, start : start + STEP]
            allowed = alike if same else ~alike
            for at, m in enumerate(active):
                row = scores[at]
                fit = allowed[at]
                for w, (lo, hi, _) in enumerate(windows[m]):
                    good = np.flatnonzero(fit & (row >= max(lo, least[m][w])) & (row <= hi))
                    if not len(good):
                        continue
                    if len(good) > need:
                        floor = np.partition(row[good], len(good) - need)[len(good) - need]
                        good = good[row[good] >= floor]
                    new = held[m][w] + [
                        (-int(row[g]), i) for g in good for i in ids[order[start + g]][:need]
                    ]
                    new.sort()
                    held[m][w] = new[:need]
                    if len(held[m][w]) == need:
                        least[m][w] = max(least[m][w], -held[m][w][-1][0])
        out = [
            (int(members[m]), lo, hi, i, -s, 0)
            for m, ws in enumerate(windows)
            for w, (lo, hi, _) in enumerate(ws)
            for s, i in held[m][w]
        ]
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return walk
