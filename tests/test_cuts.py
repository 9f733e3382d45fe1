"""Greedy cuts and sequences against a fold, with keys spread over many range partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cuts


def fold(sizes, limit, total=None, chunk=0):
    out, total = [], limit if total is None else total
    for x in sizes:
        if total >= limit:
            chunk, total = chunk + 1, 0
        total += x
        out.append(chunk)
    return out, total, chunk


def test_functions_compose():
    rng = random.Random(1)
    for _ in range(500):
        limit, parts = rng.randint(1, 30), [[rng.choice([0, 1, 2, 5, 40]) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 7))]
        first, *more = (cuts.steps(np.array(p, np.int64), limit) for p in parts)
        for f in more:
            first = first.then(limit, f)
        state, flat = (rng.randint(0, limit + 3), 5), [x for p in parts for x in p]
        chunks, total, chunk = fold(flat, limit, *state)
        assert first.after(limit, state) == (total, chunk)
        if flat:
            assert cuts.numbered(np.array(flat, np.int64), np.array([0]), [state], limit).tolist() == chunks


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [("hot", i, rng.choice([0, 1, 3, 7, 50, None])) for i in range(1500)] + [(f"k{i % 30}" if i % 30 else None, i, rng.randint(0, 9)) for i in range(400)]


@pytest.fixture
def many_partitions(spark, monkeypatch):
    monkeypatch.setattr(cuts, "FAN", 3)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("limit", [1, 40, 10**9])
def test_greedy_chunks(spark, rows, many_partitions, limit):
    df = spark.createDataFrame(rows, "g string, o int, s long").repartition(7)
    by, want = {}, set()
    for g, o, s in rows:
        by.setdefault(g, []).append((o, s or 0))
    for g, own in by.items():
        own.sort()
        want |= {(g, o, c) for (o, _), c in zip(own, fold([s for _, s in own], limit)[0], strict=True)}
    got = cuts.greedy_chunks(df, "o", "s", limit, ["g"]).collect()
    assert len(got) == len(rows) and {(r.g, r.o, r.chunk) for r in got} == want
    # The same in two runs, the open chunks carried over.
    first = cuts.greedy_chunks(df.where("o < 300"), "o", "s", limit, ["g"])
    left = cuts.open_chunks(first, "s", ["g"])
    second = cuts.greedy_chunks(df.where("o >= 300"), "o", "s", limit, ["g"], left)
    assert {(r.g, r.o, r.chunk) for r in first.unionByName(second).collect()} == want


def test_cut_edges(spark):
    files = spark.createDataFrame([(i, s) for i, s in enumerate([3, 3, 9, 1, 1, 10])], "pos int, bytes long")
    assert [r.chunk for r in cuts.greedy_chunks(files, "pos", "bytes", 5).orderBy("pos").collect()] == [1, 1, 2, 3, 3, 3]
    assert cuts.greedy_chunks(files.where("false"), "pos", "bytes", 5).count() == 0 and cuts.open_chunks(cuts.greedy_chunks(files.where("false"), "pos", "bytes", 5), "bytes").count() == 0
    with pytest.raises(ValueError):
        cuts.greedy_chunks(files, "pos", "bytes", 0)


def test_sequence(spark, rows, many_partitions):
    df, by = spark.createDataFrame(rows, "g string, o int, s long").repartition(7), {}
    for g, o, _ in rows:
        by.setdefault(g, []).append(o)
    assert {(r.g, r.o, r.seq) for r in cuts.sequence(df, ["o"], ["g"]).collect()} == {(g, o, i + 1) for g, own in by.items() for i, o in enumerate(sorted(own))}
    assert [r.seq for r in cuts.sequence(df, ["o", "g"]).orderBy("o", "g").collect()] == list(range(1, len(rows) + 1))
    kept = cuts.gapped(df, ["o", "g"], F.col("o") % 2 == 0)
    assert kept.count() == sum(o % 2 == 0 for _, o, _ in rows) and kept.agg(F.max("seq")).first()[0] > kept.count()
