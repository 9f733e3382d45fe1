"""Greedy cuts and row numbers of ordered rows, in parallel within a key, however hot it is.

A greedy cut is a fold: rows join a chunk while its sum is below a limit, and may overshoot it once. From one cut the next
is known by the prefix sums, and which rows are cuts follows from the first. Rows are sorted into range partitions;
what a partition does to the sum of the chunk that is open before it is a step function, found from its prefix sums by pointer
doubling. Such functions compose, so those of a key's partitions are composed by FAN, level by level, and the states
are handed down again the same way. Then every partition knows its state and numbers its own rows.

A partition's function has a step for each row that could be its first cut: at most the rows of one chunk. No task holds more
than a range partition, or FAN such functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import materialize, ranged, ship

FAN = 16


class Steps(NamedTuple):
    """What a stretch of rows does to an open chunk: ``before`` is the sum of the rows before each possible first cut,
    ``rest`` the open sum behind the stretch if that is the first, ``cuts`` their number; ``total`` is the sum of all rows."""

    before: np.ndarray
    rest: np.ndarray
    cuts: np.ndarray
    total: int

    def after(self, limit: int, state: tuple[int, int]) -> tuple[int, int]:
        """The state (open sum, number of its chunk) behind the stretch."""
        total, chunk = state
        first = int(np.searchsorted(self.before, limit - total))
        return (total + self.total, chunk) if first == len(self.before) else (int(self.rest[first]), chunk + int(self.cuts[first]))

    def then(self, limit: int, other: Steps) -> Steps:
        """This stretch and the one that follows as one."""
        first = np.searchsorted(other.before, limit - self.rest)
        cut = first < len(other.before)
        at = np.minimum(first, max(0, len(other.before) - 1))
        rest = np.where(cut, other.rest[at] if len(other.rest) else 0, self.rest + other.total)
        cuts = self.cuts + (np.where(cut, other.cuts[at], 0) if len(other.cuts) else 0)
        before = np.concatenate([self.before, self.total + other.before])
        keep = int(np.searchsorted(before, limit)) + 1  # no sum is negative, so none later is a first cut
        return Steps(before[:keep], np.concatenate([rest, other.rest])[:keep], np.concatenate([cuts, other.cuts])[:keep], self.total + other.total)


def _following(before: np.ndarray, limit: int, ends: np.ndarray) -> np.ndarray:
    """For each row the next cut if it is one; no further than the end of its stretch."""
    return np.minimum(np.searchsorted(before, before + limit), ends)


def steps(sizes: np.ndarray, limit: int) -> Steps:
    """The function of one stretch."""
    n, sums = len(sizes), np.cumsum(sizes)
    before = sums - sizes
    total = int(sums[-1]) if n else 0
    to, last, cuts = _following(before, limit, np.full(n, n)), np.arange(n), np.ones(n, np.int64)
    while (live := np.flatnonzero(to < n)).size:  # pointers over twice as many cuts each time
        at = to[live]
        last[live], cuts[live], to[live] = last[at], cuts[live] + cuts[at], to[at]
    keep = int(np.searchsorted(before, limit)) + 1
    return Steps(before[:keep], (total - before[last])[:keep], cuts[:keep], total)


def numbered(sizes: np.ndarray, starts: np.ndarray, states: list[tuple[int, int]], limit: int) -> np.ndarray:
    """The chunk of each row of a partition with several keys, whose rows begin at ``starts`` with the given states."""
    n, sums = len(sizes), np.cumsum(sizes)
    before, stops = sums - sizes, np.append(starts[1:], n)
    follow = _following(before, limit, np.repeat(stops, stops - starts)).tolist()
    cut = np.zeros(n, np.int64)
    for a, z, (total, _) in zip(starts.tolist(), stops.tolist(), states, strict=True):
        i = a + int(np.searchsorted(before[a:z], before[a] + limit - total)) if a < z else z
        while i < z:
            cut[i] = 1
            i = follow[i]
    chunks = np.cumsum(cut)
    base = np.array([c for _, c in states], np.int64) - (chunks - cut)[starts]
    return chunks + np.repeat(base, stops - starts)


def _keys(groups: Sequence[str]) -> list[str]:
    return [f"__g{i}" for i in range(len(groups))]


def greedy_chunks(df: DataFrame, order: str, size: str, limit: int, groups: Sequence[str] = (), opened: DataFrame | None = None) -> DataFrame:
    """df's (groups, order, size) with chunk, from 1: rows join a chunk while its sum is below limit.

    ``opened`` (groups, chunk, size) carries on from an earlier call: the last chunk of a key and its sum, as open_chunks()
    gives it. Sizes are whole; null and negative ones count as 0. The order must be total within a key; null keys
    are one key. An empty table gives an empty result.
    """
    if limit <= 0:
        raise ValueError("a chunk must be able to hold something")
    ship(df.sparkSession)
    keys = _keys(groups)
    own = [F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)]
    whole = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).cast("long")
    rows = df.select(*own, F.lit(1).alias("__kind"), F.col(order).alias("__o"), F.col(size).alias("__was"), whole.alias("__s"), F.lit(1).cast("long").alias("__base"))
    if opened is not None:  # an open chunk is a row before all others of its key
        types = dict(rows.dtypes)
        head = opened.select(*own, F.lit(0).alias("__kind"), F.lit(None).cast(types["__o"]).alias("__o"), F.lit(None).cast(types["__was"]).alias("__was"), F.col("size").cast("long").alias("__s"), F.col("chunk").cast("long").alias("__base"))
        rows = rows.unionByName(head)
    rows = ranged(rows, [*keys, "__kind", "__o"])
    states = _states(rows, keys, limit)
    light = rows.select("__part", "__row", "__s", "__base", *keys).join(states.select("__part", F.col("__total"), F.col("__chunk"), F.col("__first")), "__part", "left")

    def number(pdf):
        pdf = pdf.sort_values("__row")
        code = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy() if keys else np.zeros(len(pdf), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        state = [(limit, int(b) - 1) for b in pdf["__base"].to_numpy()[starts]]
        known = pdf.iloc[0]
        if known["__first"] == known["__row"]:  # the key began in an earlier partition
            state[0] = (int(known["__total"]), int(known["__chunk"]))
        return pdf[["__row"]].assign(chunk=numbered(pdf["__s"].to_numpy(np.int64), starts, state, limit))

    chunks = light.groupBy("__part").applyInPandas(number, "__row bigint, chunk bigint")
    out = rows.where("__kind = 1").join(chunks, "__row")
    return out.select(*(F.col(k).alias(g) for g, k in zip(groups, keys, strict=True)), F.col("__o").alias(order), F.col("__was").alias(size), F.col("chunk").cast("int").alias("chunk"))


def _states(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """For each partition whose first key began before it: that key's first row there, and the state before it."""
    kinds = dict(rows.dtypes)
    table = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "__part int, __first bigint, __base bigint, __before array<bigint>, __rest array<bigint>, __cuts array<bigint>, __sum bigint"])
    names = StructType.fromDDL(table).names

    def function(pdf):
        import pandas as pd

        pdf = pdf.sort_values("__row")
        code = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy() if keys else np.zeros(len(pdf), np.int64)
        out = []
        for c in dict.fromkeys((code[0], code[-1])):  # keys inside a partition do not reach others
            own = pdf[code == c]
            f = steps(own["__s"].to_numpy(np.int64), limit)
            out.append([*(own[k].iloc[0] for k in keys), own["__part"].iloc[0], own["__row"].iloc[0], own["__base"].iloc[0], f.before, f.rest, f.cuts, f.total])
        return pd.DataFrame(out, columns=names)

    def of(r) -> Steps:
        return Steps(np.asarray(r["__before"], np.int64), np.asarray(r["__rest"], np.int64), np.asarray(r["__cuts"], np.int64), int(r["__sum"]))

    def composed(pdf):
        pdf = pdf.sort_values("__part")
        first, *more = (of(r) for _, r in pdf.iterrows())
        for f in more:
            first = first.then(limit, f)
        out = pdf.iloc[:1].copy()
        out.at[out.index[0], "__before"], out.at[out.index[0], "__rest"], out.at[out.index[0], "__cuts"], out["__sum"] = first.before, first.rest, first.cuts, first.total
        out["__part"] = out["__part"] // FAN
        return out[names]

    level = materialize(rows.select("__part", "__row", "__s", "__base", *keys).groupBy("__part").applyInPandas(function, table), "steps")
    levels, parts = [level], (level.agg(F.max("__part")).first()[0] or 0) + 1
    while parts > 1:
        level = materialize(level.groupBy(*keys, F.floor(F.col("__part") / FAN).alias("__up")).applyInPandas(composed, table), "steps")
        levels.append(level)
        parts = -(-parts // FAN)
    # One function a key is left; before it stands a full chunk, so that its first row is a cut.
    down = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "__part int, __first bigint, __total bigint, __chunk bigint"])
    handed_on = StructType.fromDDL(down).names
    states = levels.pop().select(*keys, "__part", "__first", F.lit(limit).cast("long").alias("__total"), (F.col("__base") - 1).alias("__chunk"))

    def handed(pdf):
        import pandas as pd

        pdf, out = pdf.sort_values("__part"), []
        state = (int(pdf["__t"].iloc[0]), int(pdf["__c"].iloc[0]))
        for _, r in pdf.iterrows():
            out.append([*(r[k] for k in keys), r["__part"], r["__first"], *state])
            state = of(r).after(limit, state)
        return pd.DataFrame(out, columns=handed_on)

    while levels:
        below, above = levels.pop(), states.select(*(F.col(k).alias(f"{k}_") for k in keys), F.col("__part").alias("__up"), F.col("__total").alias("__t"), F.col("__chunk").alias("__c"))
        same = F.floor(below["__part"] / FAN) == above["__up"]
        for k in keys:
            same &= below[k].eqNullSafe(above[f"{k}_"])
        states = below.join(above, same).groupBy(*keys, "__up").applyInPandas(handed, down)
    return states.join(rows.groupBy("__part").agg(F.min("__row").alias("__least")), "__part").where("__first = __least").drop("__least")


def open_chunks(chunked: DataFrame, size: str, groups: Sequence[str] = (), opened: DataFrame | None = None) -> DataFrame:
    """(groups, chunk, size): the last chunk of each key and its sum, which a later greedy_chunks() carries on."""
    rows = chunked.select(*groups, F.col("chunk").cast("long").alias("chunk"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    if opened is not None:
        rows = rows.unionByName(opened.select(*groups, F.col("chunk").cast("long").alias("chunk"), F.col("size").cast("long").alias("size")))
    sums = rows.groupBy(*groups, "chunk").agg(F.sum("size").alias("size"))
    return sums.groupBy(*groups).agg(F.max(F.struct("chunk", "size")).alias("last")).select(*groups, "last.chunk", "last.size").where("chunk is not null")


def sequence(df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), name: str = "seq") -> DataFrame:
    """df with the number of each row within its key, from 1. Rows of a hot key are numbered by their range partitions;
    only a partition's first key can have begun earlier, so what is broadcast is a row a partition."""
    rows = ranged(df, [*groups, *order])
    local = F.row_number().over(Window.partitionBy("__part", *groups).orderBy("__row"))
    counts = rows.groupBy("__part", *groups).agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.withColumn("__earlier", earlier).where("__earlier > 0")
    before = before.select(F.col("__part").alias("__p"), *(F.col(g).alias(f"__k{i}") for i, g in enumerate(groups)), "__earlier")
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"__k{i}"))
    out = rows.withColumn(name, local).join(F.broadcast(before), same, "left")
    return out.select(*df.columns, (F.col(name) + F.coalesce("__earlier", F.lit(0))).cast("long").alias(name))


def gapped(df: DataFrame, order: Sequence[str], keep: Column, groups: Sequence[str] = (), name: str = "seq") -> DataFrame:
    """Numbers given before the filter, so that skipped rows leave gaps."""
    return sequence(df.withColumn("__keep", keep), order, groups, name).where("__keep").drop("__keep")
