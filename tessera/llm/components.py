"""Connected components by alternating star contractions, as Spark joins.

Every step replaces edges by edges to smaller labels with a map-side aggregated minimum and a join, so a node
with many edges is never gathered in a task, and nothing is collected. Before a step's edges are written, each
task contracts its own to stars (union-find over at most NODES nodes at a time), which saves most steps. The
lineage is cut every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, ship

#: Nodes that a task's union-find holds before it hands on its stars and begins anew.
NODES = 1 << 18


def _own_stars(batches):
    """Edges to the stars that they make within a task: u and the smallest node found connected with it."""
    import pyarrow as pa

    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(above, above)
        return x

    def stars() -> pa.RecordBatch:
        found = [(x, r) for x in up if (r := root(x)) != x]
        up.clear()
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = root(u), root(v)
            up[max(u, v)] = min(u, v)
        if len(up) > NODES:
            yield stars()
    yield stars()


def _is_stars(edges: DataFrame, rows: int) -> bool:
    """Whether every u has one edge and no v is the u of another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))
    found = ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs")).where("ups > 1 or ups = 1 and downs = 1")
    return few(found, rows).isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """For every node of the links: node and component, the smallest node that it is connected with."""
    ship(links.sparkSession)

    def written(edges: DataFrame) -> DataFrame:
        return materialize(edges.mapInArrow(_own_stars, "u bigint, v bigint"), "edges")

    edges = written(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")))
    n = edges.count()
    while not _is_stars(edges, n):
        # Large star: each node's larger neighbours go to its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = written(few(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), n))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = few(large.join(low, "u"), n).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(few(low, n).select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(few(edges.select("v").distinct(), n).select(F.col("v").alias("node"), F.col("v").alias("component")))
