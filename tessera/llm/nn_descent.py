"""Approximate nearest neighbours by inner product: NN-descent builds neighbour graphs, queries walk them greedily.

Vectors that are equal make one node (with its smallest ids), so groups of copies neither crowd a graph nor
hide each other. A hash of the node deals the nodes to shards, each of which is one task's work: its vectors go there once, and
no row is made for an edge. Shards hold SHARD nodes, and more as the table grows, with the square root of its nodes.

A shard's graph starts from random-projection leaves: TREES times, nodes are halved by random projections down to LEAF, and
each takes its best neighbours within its leaf. NN-descent then joins the edges with themselves: a node meets the neighbours of
its neighbours, in both directions, and keeps its best DEGREE. Of a round only pairs that have not met at this middle
node before, and that beat the last of a full list, go on, which loses nothing. Rounds go on until one changes no more than FEW of
the edges; lists only improve, so they end.

Each query walks the graph of every shard, with the edges in both directions, from the best STARTS of one node in DOORS, so that
clusters without edges to others have doors of their own: it expands
those of its best BEAM nodes that it has not expanded yet, STEP at a time, until there are none. The beam then doubles for each
query until a doubling changes no more than STABLE of the shard's best (up to BEAMS times BEAM). These are as many as the hash puts
into one shard of a query's k nearest, with four standard deviations to spare. Walks go by single precision of vectors that
are scaled by their largest component, which is kept beside them, so magnitudes neither overflow nor vanish (shards with nodes
below TINY of the largest go by double precision); the result's order and scores are inner products in double precision of the
original vectors.

The number of Spark jobs does not depend on the table. A node meets others only inside leaves or through lists of at most DEGREE edges
in each direction. A task holds one shard (at most LARGEST nodes and SIZE components) and BLOCK queries, which stream past it.
The build grows with the nodes, the walks with the queries times the shards, the square root of the nodes for large tables. The ids
of a vector's copies are cut to the first few by ranked limits on both sides of the shuffle before any is collected, so no
collected group grows with the data. The join that finds the copies' nodes has one row a vector on one side; a hot vector's rows
there are split by adaptive execution.

Defined cases: vectors that are null, empty, all zero, or hold a null or a non-finite component take no part;
so do rows with a null id; of rows with one id each is a candidate; vectors of different lengths are an error of
the input and raise; fewer than k candidates give all that were reached; an empty table gives an empty result.
Recall against brute force is measured in the tests, also with leaves and shards far smaller than the table.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

K = 20
DEGREE = 32
TREES = 3
LEAF = 256
FEW = 0.01
BEAM = 64
BEAMS = 32
STEP = 32
DOORS = 4
STARTS = 16
STABLE = 0.05
SEED = 7
#: Nodes of a shard in a table of up to eight shards; nodes and components of any.
SHARD = 8192
LARGEST = 1 << 17
SIZE = 1 << 24
#: Queries that walk at once, numbers that meet at once.
BLOCK = 128
MEET = 1 << 22
TINY = 1e-25


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (double components) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(F.coalesce(fine, F.lit(False)))


def _matrix(column) -> np.ndarray:
    """An Arrow list column as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """For each row of scores the columns of the k largest."""
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers in order, by a sort: np.unique's hashing takes several times as long here."""
    numbers = np.sort(numbers, axis=None)
    return numbers[np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1))]


def _held(numbers: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which numbers are among those, which are in order."""
    if not len(among):
        return np.zeros(numbers.shape, bool)
    return among[np.minimum(np.searchsorted(among, numbers), len(among) - 1)] == numbers


def _order(a: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The order by a, and of one a by s, largest first."""
    if s.dtype != np.float32:
        return np.lexsort((-s, a))
    bits = s.view(np.int32).astype(np.int64)  # as whole numbers in the order of s
    return np.argsort((a << 32) - np.where(bits < 0, -(bits & 0x7FFFFFFF), bits))


def _keys(lists: np.ndarray) -> np.ndarray:
    """The edges of lists of places as numbers, in order of the node."""
    return (np.arange(len(lists))[:, None] * len(lists) + lists)[lists >= 0]


def _lists(a: np.ndarray, b: np.ndarray, s: np.ndarray, n: int, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """The best edges from each of n nodes: places (-1 where there are fewer) and scores, best first."""
    order = _order(a, s)
    a, b, s = a[order], b[order], s[order]
    rank = np.arange(len(a)) - np.searchsorted(a, np.arange(n))[a]
    fits = rank < degree
    near, score = np.full((n, degree), -1), np.full((n, degree), -np.inf, s.dtype)
    near[a[fits], rank[fits]], score[a[fits], rank[fits]] = b[fits], s[fits]
    return near, score


def _kept(keys: np.ndarray, x: np.ndarray, y: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists that are left of these edges."""
    a, b = np.divmod(keys, len(x))
    s = np.empty(len(a), x.dtype)
    step = max(1, MEET // x.shape[1])
    for i in range(0, len(a), step):
        s[i : i + step] = np.einsum("ij,ij->i", x[a[i : i + step]], y[b[i : i + step]])
    return _lists(a, b, s, len(x), degree)


def _both(near: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Each node's edges and the best of those into it, as many at most: places, -1 for none."""
    a, at = np.nonzero(near >= 0)
    back, _ = _lists(near[a, at], a, score[a, at], len(near), near.shape[1])
    out = np.sort(np.concatenate([near, back], 1), 1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out


def _leaves(x: np.ndarray, leaf: int, draw: np.random.Generator) -> list[np.ndarray]:
    """The places by leaf: halves by random projections."""
    parts = [np.arange(len(x))]
    while len(parts[0]) > leaf:
        halves = []
        for p in parts:
            order = p[np.argsort(x[p] @ draw.standard_normal(x.shape[1]).astype(x.dtype), kind="stable")]
            halves += [order[: (len(p) + 1) // 2], order[(len(p) + 1) // 2 :]]
        parts = halves
    return parts


def descend(x: np.ndarray, y: np.ndarray, degree: int, leaf: int, trees: int, few: float) -> np.ndarray:
    """A shard's graph: for each place its neighbours in both directions, -1 for none. a ranks b by x[a] times y[b]."""
    n, draw, edges = len(x), np.random.default_rng(SEED), [np.zeros(0, np.int64)]
    for _ in range(trees):
        for p in _leaves(x, leaf, draw):
            if len(p) > 1:
                s = x[p] @ y[p].T
                np.fill_diagonal(s, -np.inf)
                edges.append((p[:, None] * n + p[_best(s, min(degree, len(p) - 1))]).ravel())
    near, score = _kept(_distinct(np.concatenate(edges)), x, y, degree)
    met, own = None, np.arange(n)[:, None]
    while True:
        group = np.concatenate([_both(near, score), own], 1)
        now = np.where(group >= 0, own * n + group, -1)
        new = group >= 0
        if met is not None:
            new &= ~_held(now, met)
        met, least, found = _distinct(now), score[:, -1], []
        live = np.flatnonzero(new.any(1))
        step = max(1, MEET // (group.shape[1] * max(group.shape[1], x.shape[1])))
        for i in range(0, len(live), step):
            # All neighbours of one node meet: the edges that are new and better than the last of the node's list.
            at, fresh = group[live[i : i + step]], new[live[i : i + step]]
            s = np.matmul(x[at], y[at].transpose(0, 2, 1))
            better = s > np.where(at >= 0, least[at], np.inf)[:, :, None]
            better &= (fresh[:, :, None] | fresh[:, None, :]) & (at >= 0)[:, None, :]
            mid, a, b = np.nonzero(better)
            a, b = at[mid, a], at[mid, b]
            found.append(_distinct((a * n + b)[a != b]))
        old = _keys(near)
        near, score = _kept(_distinct(np.concatenate([old, *found])), x, y, degree)
        if (~_held(_keys(near), np.sort(old))).sum() <= few * n * degree:
            return _both(near, score)


def _expand(q, y, near, at, seen, pool, width, step, room):
    """One step of the queries ``at``: their best open nodes of the beam are expanded. Gives those that had any."""
    places, scores, done = pool
    open_ = ~done[at, :width] & (places[at, :width] >= 0)
    at, open_ = at[open_.any(1)], open_[open_.any(1)]
    if not len(at):
        return at, pool
    row, column = np.nonzero(open_ & (np.cumsum(open_, 1) <= step))
    done[at[row], column] = True
    ahead = near[places[at[row], column]]
    row, to = np.repeat(row, ahead.shape[1]), ahead.ravel()
    fresh = ~seen[at[row], to]  # the last column stands for -1
    row, to = np.divmod(_distinct(row[fresh] * (len(y) + 1) + to[fresh]), len(y) + 1)
    seen[at[row], to] = True
    ends = np.searchsorted(row, np.arange(len(at) + 1))
    most = int(np.diff(ends).max())
    more, s = np.full((len(at), most), -1), np.full((len(at), most), -np.inf, y.dtype)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        more[i, : b - a], s[i, : b - a] = to[a:b], y[to[a:b]] @ q[at[i]]
    own = [np.concatenate([p[at], z], 1) for p, z in zip(pool, (more, s, np.zeros(s.shape, bool)))]
    if own[1].shape[1] > room:
        own = [np.take_along_axis(p, _best(own[1], room), 1) for p in own]
    order = np.argsort(-own[1], axis=1, kind="stable")
    wide = max(order.shape[1], places.shape[1])
    pool = [np.pad(p, ((0, 0), (0, wide - p.shape[1])), constant_values=z) for p, z in zip(pool, (-1, -np.inf, False))]
    for p, o in zip(pool, own):
        p[at, : order.shape[1]] = np.take_along_axis(o, order, 1)
    return at, pool


def walk(q: np.ndarray, y: np.ndarray, near: np.ndarray, k: int, most: int, beam: int, beams: int, stable: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` best nodes of a shard that each query finds (place, -1 for none, and score); walks end when the k best are stable."""
    n, rows = len(y), np.arange(len(q))
    doors = np.random.default_rng(SEED).permutation(n)[: max(64, n // DOORS)]
    s = q @ y[doors].T
    at = _best(s, STARTS)
    s = np.take_along_axis(s, at, 1)
    order = np.argsort(-s, axis=1, kind="stable")
    pool = [doors[np.take_along_axis(at, order, 1)], np.take_along_axis(s, order, 1), np.zeros(s.shape, bool)]
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, n] = True
    seen[rows[:, None], pool[0]] = True
    found, score, last, width = np.full((len(q), most), -1), np.full((len(q), most), -np.inf), None, beam
    while True:
        live = np.arange(len(rows))
        while len(live):
            live, pool = _expand(q, y, near, live, seen, pool, width, STEP, max(2 * width, most))
        m = min(most, pool[0].shape[1])
        found[rows, :m], score[rows, :m] = pool[0][:, :m], pool[1][:, :m]
        best = pool[0][:, :k]
        on = np.ones(len(rows), bool)
        if last is not None:
            on = (~(best[:, :, None] == last[:, None, :]).any(2)).sum(1) > stable * k
        if not on.any() or width >= min(n, beam * beams):
            return found, score
        # Only queries that are not stable go on.
        rows, last, q, seen, width = rows[on], best[on], q[on], seen[on], 2 * width
        pool = [p[on] for p in pool]


def light(nodes: DataFrame, top: float) -> DataFrame:
    """nodes with v in single precision, as parts of its largest component, and w, that component as a part of the table's
    largest: enough to tell who is near, whatever the vectors' magnitudes. A node ranks others by their w times the product
    of both v; its own w would not change the order."""
    scaled = nodes.withColumn("m", F.array_max(F.transform("v", F.abs)))
    return scaled.select("node", F.transform("v", lambda x: (x / F.col("m")).cast("float")).alias("v"), (F.col("m") / F.lit(top)).alias("w"))


def shards(n: int, d: int) -> int:
    """The number of shards for n nodes of d components."""
    held = min(LARGEST, SHARD * max(1.0, sqrt(n / (8 * SHARD))), max(256, SIZE // max(1, d)))
    return max(1, ceil(n / held))


def _sides(v, w) -> tuple[np.ndarray, np.ndarray]:
    """A shard's vectors as those that rank and as those that are ranked."""
    x, w = _matrix(v), w.to_numpy()
    kind = np.float32 if w.min(initial=1.0) >= TINY else np.float64
    return x.astype(kind, copy=False), (x * w[:, None]).astype(kind)


def _by_shard(batches):
    """(shard, rows) of batches in order of their first column, the shard; a shard may come in several."""
    for b in batches:
        own = b.column(0).to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        for a, z in zip(ends[:-1], ends[1:]):
            if z > a:
                yield int(own[a]), b.slice(a, z - a)


_GRAPH = "shard int, place int, node bigint, v array<float>, w double, near array<int>"


def build(nodes: DataFrame, count: int) -> DataFrame:
    """The graphs of all shards over nodes (node, v, w as light() gives them): a node's place in its shard, and near, the places
    of its neighbours in both directions."""
    degree, leaf, trees, few = DEGREE, LEAF, TREES, FEW

    def made(shard, parts):
        import pyarrow as pa

        rows = pa.Table.from_batches(parts).combine_chunks()
        node, v, w = (rows.column(c).combine_chunks() for c in ("node", "v", "w"))
        near = descend(*_sides(v, w), degree, leaf, trees, few)
        some = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(near >= 0).sum(1)]), pa.int32()), pa.array(near[near >= 0], pa.int32()))
        n = len(node)
        out = [pa.array(np.full(n, shard), pa.int32()), pa.array(np.arange(n), pa.int32()), node, v, w, some]
        yield from pa.Table.from_arrays(out, names=["shard", "place", "node", "v", "w", "near"]).to_batches(max_chunksize=4096)

    def run(batches):
        at, parts = None, []
        for shard, rows in _by_shard(batches):
            if shard != at and parts:
                yield from made(at, parts)
                parts = []
            at = shard
            parts.append(rows)
        if parts:
            yield from made(at, parts)

    dealt = nodes.select(F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(count)).cast("int").alias("shard"), "node", "v", "w")
    return dealt.repartitionById(count, "shard").sortWithinPartitions("shard", "node").mapInArrow(run, _GRAPH)


def _walks(graph: DataFrame, queries: DataFrame, count: int, k: int) -> DataFrame:
    """(a, b, score): what each query (q, vq) finds in each shard, a being the query's node."""
    spread = k / count
    share = min(k, ceil(spread + 4 * sqrt(spread)))
    most, beam, beams, stable = 2 * share + 1, BEAM, BEAMS, STABLE

    def answers(shard, ids, q):
        import pyarrow as pa

        node, y, near = shard
        for i in range(0, len(q), BLOCK):
            found, score = walk(q[i : i + BLOCK].astype(y.dtype, copy=False), y, near, share, most, beam, beams, stable)
            row, column = np.nonzero(found >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i + row]), pa.array(node[found[row, column]]), pa.array(score[row, column])], names=["a", "b", "score"])

    def held(parts):
        """A shard from its rows: nodes, ranked vectors and neighbours."""
        import pyarrow as pa

        rows = pa.Table.from_batches(parts).combine_chunks()
        near = rows.column("near").combine_chunks()
        size = np.diff(near.offsets.to_numpy())
        wide = np.full((len(rows), max(1, int(size.max(initial=0)))), -1, np.int32)
        wide[np.arange(wide.shape[1]) < size[:, None]] = near.flatten().to_numpy()
        return rows.column("node").to_numpy(), _sides(rows.column("v").combine_chunks(), rows.column("w"))[1], wide

    def run(batches):
        at, parts, shard = None, [], None
        for number, rows in _by_shard(batches):
            if number != at:
                at, parts, shard = number, [], None
            asked = rows.column("asks").to_numpy(zero_copy_only=False)
            first = int(np.searchsorted(asked, True))
            if first:
                parts.append(rows.slice(0, first))
            if first < len(asked):
                if shard is None:
                    shard, parts = held(parts), []
                own = rows.slice(first)
                yield from answers(shard, own.column("node").to_numpy(), _matrix(own.column("v")))

    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("shard")
    asks = queries.select(every, F.lit(True).alias("asks"), F.lit(0).alias("place"), F.col("q").alias("node"), F.col("vq").alias("v"), F.lit(1.0).alias("w"), F.array().cast("array<int>").alias("near"))
    rows = graph.select("shard", F.lit(False).alias("asks"), "place", "node", "v", "w", "near").unionByName(asks)
    return rows.repartitionById(count, "shard").sortWithinPartitions("shard", "asks", "place", "node").mapInArrow(run, "a bigint, b bigint, score double")


def _first(rows: DataFrame, key: str, k: int, *order) -> DataFrame:
    """The first k rows of each key. A rank's limit is applied before the shuffle too, so of a hot key each task sends k."""
    ranked = rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("__r") <= k).drop("__r")


def _top(edges: DataFrame, k: int = DEGREE) -> DataFrame:
    """The k best edges of each node, as one row a node; a hub's edges are cut before they are collected."""
    once = edges.groupBy("a", "b").agg(F.max("score").alias("score"))
    best = _first(once, "a", k, F.desc("score"), F.desc("b"))
    return best.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("score", "b")), asc=False).alias("n"))


def _scored(pairs: DataFrame, queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs (q, b) with their score: the product of q's vq and b's v, times w."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            s = np.einsum("ij,ij->i", _matrix(b.column(2)), _matrix(b.column(3))) * b.column(4).to_numpy() if len(b) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], names=["q", "b", "score"])

    joined = pairs.join(nodes.select(F.col("node").alias("b"), F.col("v").alias("vb"), "w"), "b").join(queries.select("q", "vq"), "q")
    return joined.select("q", "b", "vq", "vb", "w").mapInArrow(run, "q bigint, b bigint, score double")


def search(rows: DataFrame, every: int = 20, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    ship(rows.sparkSession)
    own = usable(rows, vec_id, vector)
    # A node holds its vector and its ids; only the k + 1 smallest can appear in a result.
    groups = own.groupBy(F.xxhash64("v").alias("h"), "v").agg(F.min("vec_id").alias("node"))
    nodes = materialize(groups.select("node", "v"), "nodes")
    members = own.join(groups.select("node", F.col("v").alias("gv"), "h"), (F.xxhash64("v") == F.col("h")) & (F.col("v") == F.col("gv"))).select("node", "vec_id")
    members = materialize(members, "members")
    table = nodes.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("d"), F.max(F.size("v")).alias("most"), F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    if table["d"] != table["most"]:
        raise ValueError(f"vectors of {table['d']} and of {table['most']} components")
    count = shards(table["n"], table["d"] or 1)
    flat = light(nodes, float(table["top"] or 1.0))
    graph = materialize(build(flat, count), "graph")
    wanted = members.where(F.col("vec_id") % every == 0).distinct()
    # Queries of one vector share their walks.
    queries = materialize(wanted.select("node").distinct().join(nodes, "node").select(F.col("node").alias("q"), F.col("v").alias("vq")), "queries")
    keys = graph.select(F.col("node").alias("q"), F.col("v").alias("vq")).join(queries.select("q"), "q", "left_semi")
    # Some more than k + 1: double precision may order them otherwise.
    found = materialize(_top(_walks(graph, keys, count, k), 2 * k + 1), "found")
    found = found.select(F.col("a").alias("q"), F.explode("n").alias("e")).select("q", F.col("e.b").alias("b")).where("q <> b")
    found = _scored(found, queries, nodes.withColumn("w", F.lit(1.0)))
    # The query's own vector is a neighbour too, for its copies.
    itself = queries.select("q", F.col("q").alias("b"), F.aggregate(F.zip_with("vq", "vq", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x).alias("score"))
    few = _first(members.distinct(), "node", k + 1, "vec_id").groupBy("node").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    near = found.select("q", "b", "score").unionByName(itself).join(few, F.col("b") == F.col("node")).groupBy("q").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "ids")).alias("found"))
    every_one = F.flatten(F.transform("found", lambda x: F.transform(x["ids"], lambda i: F.struct(x["s"].alias("s"), i.alias("i")))))
    out = wanted.join(near.select("q", every_one.alias("all")), F.col("node") == F.col("q"))
    top = F.slice(F.array_sort(F.filter("all", lambda x: x["i"] != F.col("vec_id"))), 1, k)
    return out.select(F.col("vec_id").alias("query_id"), F.posexplode(top).alias("p", "e")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.i").alias("vec_id"), (-F.col("e.s")).alias("score")
    )
