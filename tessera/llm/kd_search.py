"""Exact search of the largest inner products with integer vectors, by KD-trees per shard.

1. Equal vectors make one node, which keeps its k + 1 smallest ids: more cannot be in a result.
2. A coarse KD-tree, fitted on a sample of at most 2 * SAMPLE distinct vectors, deals all nodes to at most CELLS cells; a
   cell is cut by a hash into shards of about SHARD_ROWS nodes (fewer if vectors are long). Every node is in a shard.
3. Each shard is a row: a KD-tree by median splits of the widest component down to LEAF nodes, with a tight box at each
   tree node. Over a box an inner product is at most the sum of the components' larger products with its ends.
4. Distinct query vectors visit cells in the order of their boxes' bounds, in waves of 1, 3, 12, 48, ... cells. A cell
   is visited only if its bound reaches the query's k-th score, which is carried on from wave to wave. A wave is a join
   of shards with the queries that they have to answer, packed by up to BLOCK.
5. In a shard all queries of a block walk the tree best first: each takes its open tree node of the largest bound, goes
   down to the better leaf, leaves the siblings open, and stops when no bound reaches its k-th score. A bound that equals
   it is followed, as a smaller id may tie.

Where the table's largest component allows sums of 2^53, bounds are not trusted: all shards are then visited and scored with
whole numbers of any size; scores beyond the range of a long are taken as its ends.

Bounded: the boxes of at most CELLS cells go to the tasks that pair queries with cells; a shard and a block are a few MB each. A
query vector that many rows share is searched once; its results are joined back over SALTS parts.

Defined cases: rows with a null id, a null vector, or one with a null or non-finite component take no part; shorter vectors,
empty ones too, count as padded with zeros; repeated rows of one id and vector count once; an id is no candidate of its
own queries; equal scores go by the smaller id; fewer than k candidates give all; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

K = 5
#: Distinct vectors, about, on which the coarse tree is fitted.
SAMPLE = 8192
CELLS = 4096
SHARD_ROWS = 4096
#: Components of a shard at most, about.
SHARD_SIZE = 1 << 20
LEAF = 64
BLOCK = 1024
SALTS = 16
_LONG = (1 << 63) - 1


def scaled(vector: Column, by: int = 256) -> Column:
    """The components as floor(by * x), whole numbers in double precision (null where that is not finite)."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(by))
        fine = ~F.isnan(y) & (F.abs(y) < F.lit(float("inf")))
        return F.when(fine, F.when(F.abs(y) < F.lit(float(1 << 53)), F.floor(y).cast("double")).otherwise(y))

    return F.transform(vector, whole)


def _usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    return own.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))).distinct()


def _matrix(column, width: int) -> np.ndarray:
    """An Arrow list column as a matrix, short rows padded with zeros."""
    n = len(column)
    out = np.zeros((n, width))
    if n:
        size = np.diff(column.offsets.to_numpy())
        out[np.repeat(np.arange(n), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def split(x: np.ndarray, depth: int) -> tuple[list[np.ndarray], list[tuple[int, float]]]:
    """Rows of x by leaf of a tree of median splits of the widest component, and each inner node's component and cut."""
    level, cuts = [np.arange(len(x))], []
    for _ in range(depth):
        halves = []
        for rows in level:
            part = x[rows]
            by = int(np.argmax(part.max(0) - part.min(0))) if len(rows) else 0
            order, half = np.argsort(part[:, by], kind="stable"), len(rows) // 2
            cuts.append((by, float(part[order[half], by]) if len(rows) else 0.0))
            halves += [rows[order[:half]], rows[order[half:]]]
        level = halves
    return level, cuts


def placed(x: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each row: what equals a cut goes right."""
    at, depth = np.zeros(len(x), np.int64), (len(cuts) + 1).bit_length() - 1
    by, cut = np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts])
    for _ in range(depth):
        at = 2 * at + 1 + (x[np.arange(len(x)), by[at]] >= cut[at])
    return at - len(cuts)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box the largest inner product that the box allows."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


class Tree:
    """A shard: its vectors by leaf, the ids of each vector, and the boxes of all tree nodes in the order of a heap."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, held: np.ndarray, leaf: int = LEAF):
        depth = max(0, int(np.ceil(np.log2(max(1, len(x)) / leaf))))
        leaves, _ = split(x, depth)
        begin = np.cumsum(held) - held
        rows = np.concatenate(leaves)
        self.x, self.held = x[rows], held[rows]
        self.ids = np.concatenate([ids[begin[r] : begin[r] + held[r]] for r in rows])
        self.ends = np.cumsum([0, *map(len, leaves)])
        n = 2 * len(leaves) - 1
        self.low, self.high = np.zeros((n, x.shape[1])), np.zeros((n, x.shape[1]))
        for i in reversed(range(n)):
            own = [x[leaves[i - len(leaves) + 1]]] * 2 if i >= len(leaves) - 1 else [self.low[2 * i + 1 : 2 * i + 3], self.high[2 * i + 1 : 2 * i + 3]]
            self.low[i], self.high[i] = own[0].min(0), own[1].max(0)

    def packed(self) -> tuple[bytes, ...]:
        kind = np.float32 if np.abs(self.x).max(initial=0) < 1 << 24 else np.float64
        return self.x.astype(kind).tobytes(), self.held.astype(np.int32).tobytes(), self.ids.tobytes(), self.ends.astype(np.int32).tobytes(), self.low.tobytes(), self.high.tobytes()

    @classmethod
    def unpacked(cls, width: int, x: bytes, held: bytes, ids: bytes, ends: bytes, low: bytes, high: bytes) -> Tree:
        out = cls.__new__(cls)
        out.held, out.ids, out.ends = np.frombuffer(held, np.int32), np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int32)
        out.x = np.frombuffer(x, np.float32 if len(x) == 4 * width * len(out.held) else np.float64).reshape(-1, width).astype(np.float64)
        out.low, out.high = (np.frombuffer(b, np.float64).reshape(-1, width) for b in (low, high))
        return out

    def search(self, q: np.ndarray, least: np.ndarray, k: int, exact: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (score, id) of each query, of those that reach ``least``: scores (with -inf for none), ids, and the
        number of leaves that were scored, over all queries."""
        n, inner, visits = len(q), len(self.ends) - 2, 0
        score, found = np.full((n, k), -np.inf) if exact else np.full((n, k), -np.inf, object), np.full((n, k), _LONG)
        first = np.concatenate([[0], np.cumsum(self.held)])
        bound = bounds(q, self.low, self.high) if exact else np.full((n, len(self.low)), np.inf)
        open_ = np.full((n, len(self.low)), -np.inf)
        open_[:, 0] = bound[:, 0]
        if not exact:
            q = _whole(q)
        while True:
            node = open_.argmax(1)
            rows = np.flatnonzero((open_[np.arange(n), node] >= np.maximum(least, score[:, -1])) & (open_[np.arange(n), node] > -np.inf))
            if not len(rows):
                return score, found, visits
            node = node[rows]
            open_[rows, node] = -np.inf
            while (up := node < inner).any():
                at, left = rows[up], 2 * node[up] + 1
                better = bound[at, left + 1] > bound[at, left]
                open_[at, left + ~better] = bound[at, left + ~better]
                node[up] = left + better
            by = np.argsort(node, kind="stable")
            for same in np.split(by, np.flatnonzero(np.diff(node[by])) + 1):
                at, leaf = rows[same], int(node[same[0]]) - inner
                a, b = int(self.ends[leaf]), int(self.ends[leaf + 1])
                s = q[at] @ self.x[a:b].T if exact else np.clip(q[at] @ _whole(self.x[a:b]).T, -_LONG, _LONG)
                visits += len(at)
                s = np.repeat(s, self.held[a:b], axis=1)
                ids = np.broadcast_to(self.ids[first[a] : first[b]], s.shape)
                hit = (s >= np.maximum(least[at], score[at, -1])[:, None]).any(1)
                if hit.any():
                    at, s, ids = at[hit], np.concatenate([score[at[hit]], s[hit]], 1), np.concatenate([found[at[hit]], ids[hit]], 1)
                    best = _first(s, ids, k)
                    score[at], found[at] = np.take_along_axis(s, best, 1), np.take_along_axis(ids, best, 1)


def _whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers of any size."""
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _first(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k largest scores of each row, ties by the smaller id."""
    if s.dtype == object:
        return np.array([sorted(range(s.shape[1]), key=lambda i, r=r: (-s[r, i], ids[r, i]))[:k] for r in range(len(s))])
    return np.lexsort((ids, -s), axis=1)[:, :k]


_SHARD = "cell bigint, cut bigint, x binary, held binary, ids binary, ends binary, low binary, high binary"
_PARTS = ("x", "held", "ids", "ends", "low", "high")
_FOUND = "q bigint, s bigint, i bigint"


class Plan:
    """What tasks must know of a table: its width, the coarse tree, and whether double precision is enough."""

    def __init__(self, nodes: DataFrame, k: int):
        sizes = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max(F.array_max(F.transform("v", F.abs))).alias("m")).first()
        self.k, self.n, self.width = k, sizes["n"], max(1, sizes["d"] or 0)
        self.exact = (sizes["m"] or 0.0) ** 2 * self.width < float(1 << 53)
        self.rows = max(64, min(SHARD_ROWS, SHARD_SIZE // self.width))
        depth = min(CELLS.bit_length() - 1, max(0, int(np.ceil(np.log2(max(1, self.n) / self.rows)))))
        self.cuts: list[tuple[int, float]] = []
        if depth:
            step = max(1, self.n // SAMPLE)
            sample = nodes.where(F.pmod(F.xxhash64("v"), F.lit(step)) == 0).select("v").limit(2 * SAMPLE).toArrow()
            self.cuts = split(_matrix(sample.column(0).combine_chunks(), self.width), depth)[1]

    def located(self, rows: DataFrame, *columns: str) -> DataFrame:
        """rows (columns, v) with the cell of v."""
        width, cuts = self.width, self.cuts

        def run(batches):
            import pyarrow as pa

            for b in batches:
                cell = placed(_matrix(b.column(b.num_columns - 1), width), cuts)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

        rows = rows.select(*columns, "v")
        return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", cell bigint")


def shards(nodes: DataFrame, plan: Plan) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The shards, and the cells with their boxes."""
    width = plan.width
    cells = plan.located(nodes, "ids")
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(plan.rows)).alias("cuts"))
    blocks = cells.join(F.broadcast(sizes), "cell")  # CELLS rows at most
    blocks = blocks.select("cell", F.pmod(F.xxhash64("v"), F.col("cuts")).alias("cut"), "ids", "v")

    def plant(key, table):
        import pyarrow as pa

        ids = table.column("ids").combine_chunks()
        tree = Tree(_matrix(table.column("v").combine_chunks(), width), ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy()))
        return pa.table({"cell": [key[0].as_py()], "cut": [key[1].as_py()]} | {n: pa.array([p], pa.binary()) for n, p in zip(_PARTS, tree.packed(), strict=True)})

    out = materialize(blocks.groupBy("cell", "cut").applyInArrow(plant, _SHARD), "shards")

    def root(batches):
        import pyarrow as pa

        for b in batches:
            for cell, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([cell] * width), pa.array(np.arange(width)), pa.array(np.frombuffer(low)[:width]), pa.array(np.frombuffer(high)[:width])], names=["cell", "c", "low", "high"])

    # A cell's box is that of its shards, whose roots are their first.
    ends = out.select("cell", "low", "high").mapInArrow(root, "cell bigint, c bigint, low double, high double").groupBy("cell", "c").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    boxes = ends.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("c", "low", "high"))).alias("b")).select("cell", "b.low", "b.high").orderBy("cell").toArrow()
    many = boxes.num_rows
    low, high = (np.array(boxes.column(n).to_pylist(), np.float64).reshape(many, width) for n in ("low", "high"))
    return out, boxes.column("cell").to_numpy(), low, high


def _asked(queries: DataFrame, plan: Plan, cells: np.ndarray, low: np.ndarray, high: np.ndarray, begin: int, end: int) -> DataFrame:
    """What each cell is asked in a wave: (cell, queries, their vectors, their k-th scores), packed by up to BLOCK. The wave
    has the cells at places begin to end of each query's order of bounds, without those below its k-th score."""
    width, exact = plan.width, plan.exact

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, BLOCK):
                part = b.slice(s, BLOCK)
                q, least = _matrix(part.column(1), width), part.column(2).to_numpy(zero_copy_only=False)
                ids, least = part.column(0).to_numpy(), least if exact else np.full(len(q), -np.inf)
                bound = bounds(q, low, high) if exact else np.full((len(q), len(cells)), np.inf)
                order = np.argsort(-bound, axis=1, kind="stable")[:, begin:end]
                go = np.take_along_axis(bound, order, 1) >= least[:, None]
                for cell in np.unique(order[go]).tolist():
                    rows = np.flatnonzero((go & (order == cell)).any(1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cells[cell]], pa.int64()), *(pa.array([x[rows].tobytes()], pa.binary()) for x in (ids, q, least))], names=["cell", "qs", "qv", "least"]
                    )

    return queries.select("q", "v", "least").mapInArrow(run, "cell bigint, qs binary, qv binary, least binary")


def _answered(asked: DataFrame, trees: DataFrame, plan: Plan) -> DataFrame:
    """(q, s, i): the k best of each asked query in each shard, s being the score's negative."""
    width, k, exact = plan.width, plan.k + 1, plan.exact

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                tree = Tree.unpacked(width, *(row[p] for p in _PARTS))
                qs, least = np.frombuffer(row["qs"], np.int64), np.frombuffer(row["least"])
                s, i, _ = tree.search(np.frombuffer(row["qv"]).reshape(-1, width), least, k, exact)
                hit = s > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qs, hit.sum(1))), pa.array(-s[hit].astype(np.int64)), pa.array(i[hit])], names=["q", "s", "i"])

    return asked.join(trees, "cell").select("qs", "qv", "least", *_PARTS).mapInArrow(run, _FOUND)


def search(rows: DataFrame, every: int = 50, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k largest inner products of every row whose id is divisible by ``every``, with all rows but those of its id:
    query_id, rank, vec_id, score. Vectors hold whole numbers (see scaled)."""
    ship(rows.sparkSession)
    own = _usable(rows, vec_id, vector)
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = own.withColumn("r", rank).where(F.col("r") <= k + 1)  # a limit that Spark applies before the shuffle too
    nodes = materialize(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    plan = Plan(nodes, k)
    trees, cells, low, high = shards(nodes, plan)
    asking = own.where(F.col("vec_id") % every == 0)
    distinct = plan.located(asking.groupBy("v").agg(F.min("vec_id").alias("q")), "q").withColumn("least", F.lit(float("-inf")))
    queries = materialize(distinct.repartitionByRange(F.col("cell"), F.col("q")).select("q", "v", "least"), "queries")
    best, begin, end = None, 0, 1
    while begin < len(cells):
        found = _answered(_asked(queries, plan, cells, low, high, begin, end), trees, plan)
        found = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("s", "i"))).where(F.col("r") <= k + 1)
        found = found.groupBy("q").agg(F.collect_list(F.struct("s", "i")).alias("new"))
        merged = F.slice(F.array_sort(F.flatten(F.array("best", "new"))), 1, k + 1) if best else F.slice(F.array_sort("new"), 1, k + 1)
        if best:
            none = F.array().cast("array<struct<s:bigint,i:bigint>>")
            found = best.join(found, "q", "full").select("q", F.coalesce("best", none).alias("best"), F.coalesce("new", none).alias("new"))
        best = materialize(found.select("q", merged.alias("best")), "best")
        begin, end = end, 4 * end
        if begin < len(cells):
            last = F.when(F.size("best") > k, -F.element_at("best", k + 1)["s"]).cast("double")
            least = best.select("q", last.alias("last"))
            queries = queries.select("q", "v").join(least, "q", "left").select("q", "v", F.coalesce("last", F.lit(float("-inf"))).alias("least"))
    if best is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    results = queries.select("q", "v").join(best, "q").select("v", "best", salt)
    out = asking.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).join(results, ["v", "salt"])
    top = F.slice(F.filter("best", lambda x: x["i"] != F.col("vec_id")), 1, k)
    return out.select(F.col("vec_id").alias("query_id"), F.posexplode(top).alias("p", "e")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.i").alias("vec_id"), (-F.col("e.s")).alias("score"))
