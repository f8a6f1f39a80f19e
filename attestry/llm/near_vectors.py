"""Near duplicates among embeddings by NN-descent.

Each vector keeps a short list of its nearest neighbours. The lists start from the
leaves of a few random-hyperplane trees and are refined in rounds: the neighbours
and reverse neighbours of a vector are compared with each other, since a neighbour
of a neighbour is likely one too, until few lists change. Pairs above the threshold
are the links.

Lists full of links may hide more of them. First such lists are enlarged and
refined again. What is still full then lies in a dense group: groups are the
components of all edges above a looser threshold. A link missing from the lists of
both its ends has two full ends, so it lies within a dense group or between two of
them. Dense groups are cut into cells of near vectors, each with a centre and the
largest angle to it; all pairs of cells that these bounds allow a link are compared
exactly by matrix products, of one group or of two. A pair of cells gives counts and
a spanning forest of its links, never its pairs.

Recall is audited on the final counts: a bounded probe of vectors, those of dense
groups included, is compared with all others. While the share of counted links is
below the target, more trees are planted and the rounds go on with longer lists;
where AUDITS do not reach it, the operator raises with what it measured.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of unlike lengths are never linked; equal vectors are
one node and linked with each other; repeated ids are rows of their own where
their vectors differ, and one component; an empty table gives an empty one. Equal
similarities are ordered by id.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.common import in_block_pairs, partitions, runs, stored, whole_groups
from attestry.llm.components import connected

THRESHOLD = 0.9
LOOSE = 0.8
NEIGHBOURS = 10
MOST_NEIGHBOURS = 20
TREES = 6
LEAF = 40
ROUNDS = 8
SETTLED = 0.01  # share of list places that may still change
PROBES = 256
RECALL = 0.98
AUDITS = 4
BLOCK = 128
CELLS = 512  # centres of cells that one task compares with as many
SLACK = 1e-6  # of angles, far above their rounding
SEED = 97

EDGE = "u bigint, v bigint, sim double"


def unit_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(key, x): the vector at length one as packed doubles, null where it links with nothing."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def unit(values):
            if not values or None in values:
                return None
            x = np.array(values, dtype=np.float64)
            if not np.isfinite(x).all():
                return None
            x = x / (np.abs(x).max() or 1.0)
            length = float(np.sqrt(x @ x))
            return (x / length).tobytes() if length else None

        for batch in batches:
            found = [unit(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=[key, "x"])

    return vectors.select(key, column).mapInArrow(run, f"`{key}` {kind}, x binary")


def matrix(column, start, end):
    import numpy as np

    part = column[start:end]
    return np.frombuffer(b"".join(part), dtype=np.float64).reshape(len(part), -1)


def best_pairs(batches, limit):
    """Local joins of sorted rows (group, id, x, least, fresh): pairs worth keeping.

    A pair counts for a vector if one of both is fresh and it is above the vector's
    ``least``; at most ``limit`` of a group are given for each vector, the best.
    """
    import numpy as np
    import pyarrow as pa

    for batch in whole_groups(batches):
        keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        vectors, least = batch.column(2).to_pylist(), batch.column(3).to_numpy()
        fresh = batch.column(4).to_numpy(zero_copy_only=False)
        out = ([], [], [])
        for start, end in runs(keys):
            if end - start < 2:
                continue
            x = matrix(vectors, start, end)
            own, new = ids[start:end], fresh[start:end]
            sims = x @ x.T
            useful = (sims > least[start:end, None]) & (new[:, None] | new[None, :])
            useful &= own[:, None] != own[None, :]
            if end - start > limit + 1:
                masked = np.where(useful, sims, -2.0)
                edge = np.partition(masked, -limit, axis=1)[:, -limit]
                useful &= sims >= edge[:, None]
            i, j = np.nonzero(useful)
            out[0].append(own[i])
            out[1].append(own[j])
            out[2].append(sims[i, j])
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(o)) for o in out], names=["u", "v", "sim"]
            )


def local_join(rows: DataFrame, limit: int) -> DataFrame:
    dealt = rows.repartition(partitions(rows.sparkSession), "grp").sortWithinPartitions("grp")
    return dealt.select("grp", "id", "x", "least", "fresh").mapInArrow(
        partial(best_pairs, limit=limit), EDGE
    )


def plant(nodes: DataFrame, count: int, limit: int, season: int = 0) -> DataFrame:
    """Edges from pairs within the leaves of random-hyperplane trees, others each ``season``."""
    from math import ceil, log2

    bits = max(0, ceil(log2(max(1, count / LEAF))))

    def leaves(batches):
        import numpy as np
        import pyarrow as pa

        planes = {}
        for batch in batches:
            ids, xs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([len(x) for x in xs])
            trees, codes, where = [], [], []
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = matrix([xs[r] for r in rows], 0, len(rows))
                if size not in planes:
                    random = np.random.default_rng([SEED, int(size), season])
                    planes[size] = random.standard_normal((x.shape[1], TREES * bits))
                sides = (x @ planes[size]).reshape(len(rows), TREES, bits) > 0
                code = (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) + (int(size) << 40)
                for tree in range(TREES):
                    trees.append(np.full(len(rows), tree))
                    codes.append(code[:, tree])
                    where.append(rows)
            if not where:
                continue
            where = np.concatenate(where)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(trees).astype("int32")), pa.array(np.concatenate(codes)), pa.array(ids[where])],
                names=["tree", "leaf", "id"],
            )

    placed = nodes.select("id", "x").mapInArrow(leaves, "tree int, leaf bigint, id bigint")
    sizes = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    # Large leaves are cut at random: their members find each other in the rounds.
    cut = F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / (2.0 * LEAF)))
    dealt = (
        placed.join(sizes, ["tree", "leaf"])
        .select(F.xxhash64("tree", "leaf", cut).alias("grp"), "id")
        .join(nodes, "id")
        .select("grp", "id", "x", F.lit(-2.0).alias("least"), F.lit(True).alias("fresh"))
    )
    return local_join(dealt, limit)


def shortened(edges: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` nearest of each vector; an edge found twice counts once, as the older."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return once.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")


def descend(nodes: DataFrame, lists: DataFrame, limit: int, count: int, rounds: int = ROUNDS) -> DataFrame:
    """Refine neighbour lists of up to ``limit`` until few of them change."""
    for _ in range(rounds):
        least = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
        floor = F.when(F.col("n") >= limit, F.col("low")).otherwise(F.lit(-2.0))
        known = nodes.join(least, nodes["id"] == least["u"], "left").select(
            "id", "x", F.coalesce(floor, F.lit(-2.0)).alias("least")
        )
        # Reverse lists are cut to the nearest as well: the rest is reached the other way round.
        order = Window.partitionBy("v").orderBy(F.col("sim").desc(), "u")
        back = (
            lists.withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= limit)
            .select(F.col("v").alias("grp"), F.col("u").alias("id"), "fresh")
        )
        around = (
            lists.select(F.col("u").alias("grp"), F.col("v").alias("id"), "fresh")
            .unionByName(back)
            .unionByName(nodes.select(F.col("id").alias("grp"), "id", F.lit(False).alias("fresh")))
            .groupBy("grp", "id")
            .agg(F.max("fresh").alias("fresh"))
        )
        found = local_join(around.join(known, "id"), limit).withColumn("fresh", F.lit(True))
        old = lists.withColumn("fresh", F.lit(False))
        lists = stored(shortened(old.unionByName(found), limit), "lists")
        changed = lists.where("fresh").count()
        if changed <= SETTLED * count * limit:
            break
    return lists


def measured_recall(nodes: DataFrame, totals: DataFrame, threshold: float) -> float:
    """Share of the links of at most PROBES vectors that ``totals`` (id, n) counts, 1 without any.

    Half of the probes have a counted link, the others are any vectors. Both sides count
    the same links: those of a probe with all other vectors, by their weights. The lower
    of two shares is given: of all links, and the mean over the probes, which a few
    probes with very many links do not decide.
    """
    import numpy as np

    counted = totals.where("n > 0").select("id", "n")
    order = F.xxhash64("id")
    some = nodes.join(counted, "id").orderBy(order).limit(PROBES // 2).select("id", "x")
    any_ = nodes.orderBy(order).limit(PROBES // 2).select("id", "x")
    probes = some.unionByName(any_).distinct().join(counted, "id", "left").collect()
    if not probes:
        return 1.0
    ids = [p["id"] for p in probes]
    packed = [bytes(p["x"]) for p in probes]

    def compare(batches):
        import pyarrow as pa

        by_size = {}
        for i, x in zip(ids, packed):
            by_size.setdefault(len(x), []).append((i, x))
        sides = {
            size: (np.array([i for i, _ in rows]), matrix([x for _, x in rows], 0, len(rows)))
            for size, rows in by_size.items()
        }
        totals_ = {i: 0 for i in ids}
        for batch in batches:
            own, xs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            weight = batch.column(2).to_numpy()
            sizes = np.array([len(x) for x in xs])
            for size, (names, probe) in sides.items():
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    sims = probe @ matrix([xs[r] for r in rows], 0, len(rows)).T
                    near = (sims >= threshold) & (names[:, None] != own[rows][None, :])
                    for i, n in zip(names.tolist(), (near @ weight[rows]).tolist()):
                        totals_[i] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals_), pa.int64()), pa.array(list(totals_.values()), pa.int64())], names=["id", "n"]
        )

    there = nodes.select("id", "x", "weight").mapInArrow(compare, "id bigint, n bigint")
    there = {r["id"]: r["n"] for r in there.groupBy("id").agg(F.sum("n").alias("n")).collect()}
    pairs = [(min(p["n"] or 0, there[p["id"]]), there[p["id"]]) for p in probes if there.get(p["id"])]
    if not pairs:
        return 1.0
    return min(sum(f for f, _ in pairs) / sum(n for _, n in pairs), sum(f / n for f, n in pairs) / len(pairs))


def block_pairs(batches, threshold: float):
    """Rows (pair, side, id, weight, x) of block pairs, sorted by pair -> counts and links."""
    import numpy as np
    import pyarrow as pa

    for batch in whole_groups(batches):
        keys = batch.column(0).to_numpy()
        side, ids = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        weight, vectors = batch.column(3).to_numpy(), batch.column(4).to_pylist()
        out = ([], [], [])
        for start, end in runs(keys):
            part = np.arange(start, end)
            left, right = part[side[start:end] != 1], part[side[start:end] != 0]
            a = matrix([vectors[i] for i in left], 0, len(left))
            b = matrix([vectors[i] for i in right], 0, len(right))
            near = (a @ b.T >= threshold) & (ids[left][:, None] != ids[right][None, :])
            out[0].append(ids[left])
            out[1].append(forest(near, ids[left], ids[right]))
            out[2].append(near @ weight[right])
            if side[start] != 2:  # two different cells: the other way too
                out[0].append(ids[right])
                out[1].append(ids[right])
                out[2].append(near.T @ weight[left])
                rows = forest(near, ids[left], ids[right], True)
                out[0].append(ids[right])
                out[1].append(rows)
                out[2].append(np.zeros(len(right), dtype=np.int64))
        if out[0]:
            u, v, n = (np.concatenate(o).astype(np.int64) for o in out)
            kept = (n > 0) | (u != v)  # most pairs of cells hold no link
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (u, v, n)], names=["u", "v", "n"])


def forest(near, left, right, of_right: bool = False):
    """For each id of one side the smallest id of its component in the bipartite graph."""
    import numpy as np

    a, b = left.copy(), right.copy()
    top = np.iinfo(np.int64).max
    while True:
        low = np.where(near, b[None, :], top).min(axis=1, initial=top)
        new_a = np.minimum(a, low)
        high = np.where(near, new_a[:, None], top).min(axis=0, initial=top)
        new_b = np.minimum(b, high)
        if (new_a == a).all() and (new_b == b).all():
            return b if of_right else a
        a, b = new_a, new_b


def celled(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(cell, id, weight, x): groups cut by hyperplanes into cells of about BLOCK near vectors."""

    def sides(batches):
        import numpy as np
        import pyarrow as pa

        planes = {}
        for batch in batches:
            ids, bits, xs = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            sizes = np.array([len(x) for x in xs])
            codes = np.zeros(len(xs), dtype=np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                if size not in planes:
                    random = np.random.default_rng([SEED + 1, int(size)])
                    planes[size] = random.standard_normal((int(size) // 8, 30))
                above = (matrix([xs[r] for r in rows], 0, len(rows)) @ planes[size]) > 0
                used = np.arange(30)[None, :] < bits[rows][:, None]
                codes[rows] = ((above & used) << np.arange(30, dtype=np.int64)).sum(axis=1) + (int(size) << 30)
            yield pa.RecordBatch.from_arrays([ids, pa.array(codes)], names=["id", "code"])

    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("_n") / BLOCK)), F.lit(0)), F.lit(30)).cast("int")
    dealt = groups.join(sizes, "grp").select("id", "grp", bits.alias("bits"))
    coded = dealt.join(nodes, "id").select("id", "bits", "x").mapInArrow(sides, "id bigint, code bigint")
    coded = stored(coded.join(groups, "id"), "cells")
    counts = coded.groupBy("grp", "code").agg(F.count(F.lit(1)).alias("_n"))
    cut = F.pmod(F.xxhash64("id", F.lit(31)), F.ceil(F.col("_n") / BLOCK))
    named = coded.join(counts, ["grp", "code"]).select(F.xxhash64("grp", "code", cut).alias("cell"), "id")
    return named.join(nodes, "id").select("cell", "id", "weight", "x")


def cell_bounds(batches):
    """Rows (cell, x), sorted by cell -> a centre of each cell and the largest angle to it."""
    import numpy as np
    import pyarrow as pa

    for batch in whole_groups(batches):
        vectors, out = batch.column(1).to_pylist(), ([], [], [], [])
        keys = batch.column(0).to_numpy()
        for start, end in runs(keys):
            x = matrix(vectors, start, end)
            centre = x.sum(axis=0)
            length = float(np.sqrt(centre @ centre))
            centre = centre / length if length > 1e-9 else x[0]
            out[0].append(int(keys[start]))
            out[1].append(len(vectors[start]))
            out[2].append(float(np.arccos(np.clip(x @ centre, -1.0, 1.0)).max()))
            out[3].append(centre.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2]), pa.array(out[3], pa.binary())],
            names=["cell", "size", "angle", "centre"],
        )


def possible_pairs(batches, threshold: float):
    """Rows (pair, side, cell, angle, centre), sorted by pair -> cells that may hold a link."""
    import numpy as np
    import pyarrow as pa

    reach = float(np.arccos(np.clip(threshold, -1.0, 1.0))) + SLACK
    for batch in whole_groups(batches):
        keys, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cells, angles = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        centres, out = batch.column(4).to_pylist(), ([], [])
        for start, end in runs(keys):
            part = np.arange(start, end)
            left, right = part[side[start:end] != 1], part[side[start:end] != 0]
            if not len(left) or not len(right):
                continue
            a = matrix([centres[i] for i in left], 0, len(left))
            b = matrix([centres[i] for i in right], 0, len(right))
            apart = np.arccos(np.clip(a @ b.T, -1.0, 1.0))
            near = apart <= angles[left][:, None] + angles[right][None, :] + reach
            if side[start] == 2:
                near &= cells[left][:, None] < cells[right][None, :]
            i, j = np.nonzero(near)
            out[0].append(cells[left][i])
            out[1].append(cells[right][j])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["a", "b"])


def dense_links(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(u, v, n): links among all vectors of groups: counts n, and edges u-v that span them.

    ``groups`` are (id, grp). Sums of n by u are exact numbers of links, within the
    groups and between them: two cells are left out only where the angle between
    their centres proves that they hold no link.
    """
    parts = partitions(nodes.sparkSession)
    cells = stored(celled(nodes, groups), "cells")
    bounds = cells.select("cell", "x").repartition(parts, "cell").sortWithinPartitions("cell")
    bounds = stored(bounds.mapInArrow(cell_bounds, "cell bigint, size int, angle double, centre binary"), "bounds")
    met = in_block_pairs(bounds, "size", "cell", CELLS).select("pair", "side", "cell", "angle", "centre")
    met = met.repartition(parts, "pair").sortWithinPartitions("pair")
    pairs = met.mapInArrow(partial(possible_pairs, threshold=threshold), "a bigint, b bigint")
    pairs = pairs.unionByName(bounds.select(F.col("cell").alias("a"), F.col("cell").alias("b")))
    side = F.when(F.col("a") == F.col("b"), F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))
    sent = pairs.select("a", "b", F.xxhash64("a", "b").alias("pair"), F.explode(side).alias("side"))
    sent = sent.select("pair", "side", F.when(F.col("side") == 1, F.col("b")).otherwise(F.col("a")).alias("cell"))
    dealt = sent.join(cells, "cell").select("pair", "side", "id", "weight", "x")
    dealt = dealt.repartition(parts, "pair").sortWithinPartitions("pair")
    return dealt.mapInArrow(partial(block_pairs, threshold=threshold), "u bigint, v bigint, n bigint")


def full_lists(lists: DataFrame, limit: int, threshold: float) -> DataFrame:
    """(u): vectors whose whole list is links, so that there may be more of them."""
    sizes = lists.where(F.col("sim") >= threshold).groupBy("u").count()
    return stored(sizes.where(F.col("count") >= limit).select("u"), "full")


def counted_links(nodes: DataFrame, lists: DataFrame, full: DataFrame, threshold: float) -> tuple:
    """Listed links (u, v), those of dense groups (u, v, n), and (id, n) of all vectors with links.

    n sums the weights of the other vectors that a vector is linked with.
    """
    links = lists.where(F.col("sim") >= threshold).select("u", "v")
    links = stored(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    loose = lists.where(F.col("sim") >= min(LOOSE, threshold)).select(F.col("u").alias("a"), F.col("v").alias("b"))
    groups = connected(loose).select(F.col("node").alias("id"), F.col("root").alias("grp"))
    dense = groups.join(full.withColumnRenamed("u", "id"), "id").select("grp").distinct()
    dense = stored(groups.join(dense, "grp"), "dense")
    counted = stored(dense_links(nodes, dense, threshold), "dense_links")
    exact = counted.groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    weights = nodes.select(F.col("id").alias("v"), "weight")
    listed = links.join(weights, "v").groupBy(F.col("u").alias("id")).agg(F.sum("weight").alias("n"))
    listed = listed.join(dense.select("id"), "id", "left_anti")
    return links, counted, stored(exact.unionByName(listed), "totals")


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key``, n_links, component_id, kept of every vector.

    ``n_links`` counts the other vectors with a cosine of ``threshold`` or more,
    ``component_id`` is the smallest key reachable by links, ``kept`` its own key.
    """
    units = stored(
        unit_vectors(vectors, key, column).withColumn("hash", F.xxhash64("x")), "units"
    )
    # Equal vectors are one node.
    nodes = stored(
        units.where("x is not null")
        .groupBy("hash", "x")
        .agg(F.min(key).cast("bigint").alias("id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    own = nodes.select("hash", F.col("x").alias("_x"), F.col("node").alias("id"), "weight")
    members = units.join(
        own.withColumnRenamed("hash", "_hash"),
        (F.col("hash") == F.col("_hash")) & (F.col("x") == F.col("_x")),
        "left",
    ).select(key, "id", "weight")
    members = stored(members, "members")
    nodes = nodes.select(F.col("node").alias("id"), "x", "weight")
    count = nodes.count()

    limit = NEIGHBOURS
    first = plant(nodes, count, limit).withColumn("fresh", F.lit(True))
    lists = descend(nodes, stored(shortened(first, limit), "lists"), limit, count)
    for season in range(1, AUDITS + 1):
        full = full_lists(lists, limit, threshold)
        if limit < MOST_NEIGHBOURS and full.limit(1).count():
            limit = MOST_NEIGHBOURS
            lists = descend(nodes, lists.withColumn("fresh", F.lit(True)), limit, count)
            full = full_lists(lists, limit, threshold)
        links, counted, totals = counted_links(nodes, lists, full, threshold)
        recall = measured_recall(nodes, totals, threshold)
        if recall >= RECALL:
            break
        if season == AUDITS:
            raise RuntimeError(f"recall of links is {recall:.4f} after {AUDITS} audits, below {RECALL}")
        limit *= 2
        more = plant(nodes, count, limit, season).withColumn("fresh", F.lit(True))
        more = lists.withColumn("fresh", F.lit(True)).unionByName(more)
        lists = descend(nodes, stored(shortened(more, limit), "lists"), limit, count)

    edges = links.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        counted.select(F.col("u").alias("a"), F.col("v").alias("b"))
    )
    roots = connected(edges).select(F.col("node").alias("id"), "root")
    joined = members.join(totals, "id", "left").join(roots, "id", "left")
    joined = joined.withColumn("_root", F.coalesce("root", "id"))
    least = joined.where("_root is not null").groupBy("_root").agg(F.min(key).alias("_least"))
    return joined.join(least, "_root", "left").select(
        key,
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("_least", key).cast("bigint").alias("component_id"),
        (F.col(key) == F.coalesce("_least", key)).alias("kept"),
    )
