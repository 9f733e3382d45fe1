"""Mixing sources to target weights by iterative proportional fitting (raking).

Token counts are summed by cell (source, language, topic). Raking multiplies the cells in turn until the
token shares by source, by language and by topic meet their targets; a document's calibrated probability is
its cell's new mass over the cell's tokens, scaled so that the largest is one. Documents are then sampled by
a hash of their id, so that a rerun or a lost executor gives the same sample.

A round reads nothing but the cells, and rounds go on until no share misses its target by more than TOLERANCE, ROUNDS of them
at most. Up to FEW cells they are raked as one array; beyond that they are rescaled with joins of two tables (cells and one
marginal), the lineage cut every round, with the same factors in the same order. Neither the number of sources nor the skew of one
matters; the driver sees cells up to FEW and else sums, never rows. Targets that cannot be met together (a value that
occurs in no cell with mass left for it) leave a gap, which marginals() tells and mix() warns of.

Targets: a mapping from a dimension's values to shares, or a power p, which takes the shares to be in
proportion to (token share) ** p: 1 keeps the corpus's own, 0 evens it out. Values without a target, or with
target 0, get no mass. Shares are taken over the values that occur.

Defined cases: null source, language or text count as the values '' ; a text without words has no tokens, and
its probability is its cell's (0 if the cell has no tokens at all); null ids share one draw; repeated rows share
one draw; an empty table gives an empty result; texts of any length are counted whole; the columns topic, n_tokens,
probability and sampled replace columns of these names (a column topic of the table is the topic), all others pass through.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, uniform, unused

DIMENSIONS = ("source", "lang", "topic")
#: Powers for the production targets: the hot source is damped, languages and topics less so.
TARGETS = {"source": 0.85, "lang": 0.95, "topic": 1.0}
ROUNDS = 100
#: The largest miss of a share at which raking ends.
TOLERANCE = 1e-10
#: Cells that are raked as one array at most, some 10 MB.
FEW = 1 << 17
SEED = "mix-1"

#: The topic of a text where the table has no topic column: the first pattern that it holds.
TOPICS = (("licence", "(?i)licen[cs]e"), ("records", "[0-9]{4}"), ("contacts", "[a-z0-9]@[a-z0-9]"))
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    found = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        found = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(found)
    return found


def cells_of(docs: DataFrame) -> DataFrame:
    return docs.groupBy(*(f"__{d}" for d in DIMENSIONS)).agg(F.sum("n_tokens").alias("tokens"))


def _goals(cells: DataFrame, dim: str, target) -> DataFrame:
    """A row a value of the dimension: __goal, its share of all tokens."""
    own = cells.groupBy(f"__{dim}").agg(F.sum("tokens").alias("__t"))
    if isinstance(target, dict):
        given = cells.sparkSession.createDataFrame([(str(k), float(v)) for k, v in target.items()], f"__{dim} string, __r double")
        own = own.join(given, f"__{dim}", "left").withColumn("__r", F.when(F.col("__t") > 0, F.coalesce("__r", F.lit(0.0))).otherwise(0.0))
    else:
        own = own.withColumn("__r", F.when(F.col("__t") > 0, F.pow(F.col("__t").cast("double"), F.lit(float(target)))).otherwise(0.0))
    total = own.agg(F.sum("__r")).first()[0] or 0.0
    return own.select(f"__{dim}", (F.col("__r") / F.lit(total) if total else F.lit(0.0)).alias("__goal"))


def _raked_array(cells: DataFrame, goals: dict[str, DataFrame], rounds: int) -> tuple[DataFrame, float]:
    """rake() for few cells, and the largest gap."""
    pdf = cells.toPandas()
    w, codes, wanted = pdf["tokens"].to_numpy(np.float64), {}, {}
    for d in DIMENSIONS:
        goal = {r[f"__{d}"]: r["__goal"] for r in goals[d].collect()}
        code, values = pdf[f"__{d}"].factorize()
        codes[d], wanted[d] = code, np.array([goal[v] for v in values], np.float64)
    for _ in range(rounds):
        for d in DIMENSIONS:
            have = np.bincount(codes[d], w, len(wanted[d]))
            w = w * np.divide(wanted[d], have, out=np.zeros(len(have)), where=have > 0)[codes[d]]
        gap = max(np.abs(np.bincount(codes[d], w, len(wanted[d])) - wanted[d]).max(initial=0.0) for d in DIMENSIONS)
        if gap <= TOLERANCE:
            break
    return cells.sparkSession.createDataFrame(pdf.assign(w=w), cells.withColumn("w", F.lit(0.0)).schema), float(gap)


def _raked_joins(cells: DataFrame, goals: dict[str, DataFrame], rounds: int) -> tuple[DataFrame, float]:
    """rake() for any number of cells, and the largest gap."""
    out = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            have = out.groupBy(f"__{d}").agg(F.sum("w").alias("__have"))
            factor = have.join(goals[d], f"__{d}").select(f"__{d}", F.when(F.col("__have") > 0, F.col("__goal") / F.col("__have")).otherwise(0.0).alias("__f"))
            out = out.join(factor, f"__{d}").withColumn("w", F.col("w") * F.col("__f")).drop("__f")
        out = materialize(out, "raked")
        gap = _gaps(out, goals).agg(F.max(F.abs("gap"))).first()[0] or 0.0
        if gap <= TOLERANCE:
            break
    return out, gap


def _gaps(raked: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    rows = []
    for d in DIMENSIONS:
        have = raked.groupBy(f"__{d}").agg(F.sum("w").alias("share")).join(goals[d], f"__{d}")
        rows.append(have.select(F.lit(d).alias("dimension"), F.col(f"__{d}").alias("value"), F.col("__goal").alias("target"), "share", (F.col("share") - F.col("__goal")).alias("gap")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _rake(cells: DataFrame, targets: dict, rounds: int) -> tuple[DataFrame, float]:
    if rounds < 1:
        raise ValueError("one round at least")
    cells = materialize(cells, "cells")
    goals = {d: _goals(cells, d, targets[d]) for d in DIMENSIONS}
    if cells.count() <= FEW:
        return _raked_array(cells, goals, rounds)
    return _raked_joins(cells, {d: materialize(g, f"goal-{d}") for d, g in goals.items()}, rounds)


def rake(cells: DataFrame, targets: dict = TARGETS, rounds: int = ROUNDS) -> DataFrame:
    """cells with w, the calibrated share of all tokens."""
    return _rake(cells, targets, rounds)[0]


def marginals(raked: DataFrame, targets: dict = TARGETS) -> DataFrame:
    """What raking reached: dimension, value, target, share and gap, the share's miss."""
    return _gaps(raked, {d: _goals(raked, d, targets[d]) for d in DIMENSIONS})


def mix(docs: DataFrame, targets: dict = TARGETS, rounds: int = ROUNDS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with topic, n_tokens, probability and sampled; no row is left out."""
    keys = {d: unused(docs, d) for d in DIMENSIONS}
    counted = docs.withColumns(
        {"n_tokens": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long"), "topic": F.col("topic") if "topic" in docs.columns else topic_of(F.col(text))}
    ).withColumns({keys[d]: F.coalesce(F.col(d).cast("string"), F.lit("")) for d in ("source", "lang")})
    counted = counted.withColumn(keys["topic"], F.coalesce(F.col("topic").cast("string"), F.lit("")))
    cells = cells_of(counted.select(*(F.col(keys[d]).alias(f"__{d}") for d in DIMENSIONS), "n_tokens"))
    raked, missed = _rake(cells, targets, rounds)
    raked = raked.withColumn("__ratio", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0))
    if missed > 1e-3:
        warnings.warn(f"the targets are missed by up to {missed:.3g} of all tokens; marginals() tells which", stacklevel=2)
    top = raked.agg(F.max("__ratio")).first()[0] or 0.0
    probability = unused(docs, "p")
    weights = raked.select(*(F.col(f"__{d}").alias(keys[d]) for d in DIMENSIONS), (F.col("__ratio") / F.lit(top) if top else F.lit(0.0)).alias(probability))
    out = counted.join(weights, list(keys.values()), "left").withColumn("probability", F.coalesce(probability, F.lit(0.0)))
    return out.withColumn("sampled", uniform(F.col(doc_id), seed) < F.col("probability")).drop(*keys.values(), probability)
