"""The ledger build, the commit log, the registry and the lock."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from tessera.sources import registry
from tessera.sources.commits import CommitLog, Conflict
from tessera.streaming.ledger import Build

SCHEMA = "k string, n long"


def put(path, rows, spark):
    """One Parquet file of that name."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"k": [r[0] for r in rows], "n": pa.array([r[1] for r in rows], pa.int64())}), path)


def judge(df):
    return df.withColumns({"ok": F.col("n") >= 10, "seconds": F.col("n").cast("double")})


@pytest.fixture
def build(spark, tmp_path):
    src = str(tmp_path / "src")
    files = {"a": [("x", 1), ("y", 10), ("x", 20)], "b": [("x", 30), ("z", 5), ("w", 40)], "c": [("v", 10), (None, 11), (None, 12)], "d": [("u", 10), ("y", 3)]}
    for name, rows in files.items():
        put(f"{src}/{name}.parquet", rows, spark)
    return src, lambda **o: Build(spark, src, SCHEMA, str(tmp_path / "out"), ["k"], judge, **({"shard_clips": 3, "chunk_bytes": 1} | o))


def kept(b):
    return sorted((str(r.k), r.n, r.shard) for r in b.rows().collect())


WHOLE = [("None", 11, 2), ("u", 10, 2), ("v", 10, 2), ("w", 40, 1), ("x", 20, 1), ("y", 10, 1)]


def test_build_over_chunks(build, spark):
    b = build[1]()
    assert b.rows().count() == 0 and b.progress()["clips"] == 0
    stats = b.run()
    assert kept(b) == WHOLE and (stats["chunks"], stats["clips"], stats["rejected"], stats["duplicates"]) == (4, 6, 2, 3)
    assert b.progress() == {"clips": 6, "seconds": 101.0, "rejected": 2, "duplicates": 3, "shards": 2}
    meta = {r.shard: (r.clips, len(r.source_files)) for r in b.meta().collect()}
    assert meta == {1: (3, 2), 2: (3, 2)} and b.meta().where("bytes > 0").count() == 2 and b.known().count() == 6
    assert b.run()["chunks"] == 0 and kept(b) == WHOLE
    one = build[1](chunk_bytes=1 << 30, shard_clips=3)
    one.out, one.log = one.out + "2", CommitLog(spark, one.out + "2/commits")
    assert one.run()["chunks"] == 1 and kept(one) == WHOLE


def test_bounded_runs(build):
    b = build[1]()
    assert b.run(pilot=2)["clips"] == 2 and b.log.latest() == 0 and b.rows().count() == 0
    assert b.run(max_chunks=2)["chunks"] == 2 and b.progress()["clips"] == 3
    assert b.run(max_hours=1e-9)["chunks"] == 1 and b.progress()["clips"] == 5
    b.run()
    assert {r[:2] for r in kept(b)} == {r[:2] for r in WHOLE} and b.progress()["clips"] == 6
    assert [r[2] for r in kept(b) if r[0] in "uv"] == [3, 2]  # each run begins a shard


def test_broken_files_are_retried(build, spark):
    src, make = build
    good = open(f"{src}/b.parquet", "rb").read()
    open(f"{src}/b.parquet", "wb").write(b"not parquet at all")
    b = make(chunk_bytes=1 << 30)
    stats = b.run()
    assert stats["failed"] == 1 and {r.path[-9:]: r.outcome for r in b.outcomes().collect()}["b.parquet"] == "failed"
    assert ("w", 40) not in {r[:2] for r in kept(b)} and b.outcomes().where("error is not null").count() == 1
    assert b.run()["failed"] == 1  # still broken
    open(f"{src}/b.parquet", "wb").write(good)
    stats = b.run()
    assert stats["failed"] == 0 and {r[:2] for r in kept(b)} == {r[:2] for r in WHOLE} and b.outcomes().where("outcome <> 'ok'").count() == 0


def test_a_lost_run_shows_nothing(build, monkeypatch):
    b = build[1]()
    b.run(max_chunks=1)
    before, progress = kept(b), b.progress()
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            b.run()
    assert kept(b) == before and b.progress() == progress and b.known().count() == len(before)
    b.run()
    assert {r[:2] for r in kept(b)} == {r[:2] for r in WHOLE} and b.progress()["clips"] == 6 and b.progress()["duplicates"] == 3


def test_commit_log(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    a, b = CommitLog(spark, root), CommitLog(spark, root)
    assert a.latest() == 0 and a.read(0) is None and a.table("x int").count() == 0
    a.create(1, {"x": 1})
    with pytest.raises(Conflict):
        b.create(1, {"x": 2})
    made = []

    def add(last):
        if not made:  # somebody else is faster
            made.append(1)
            a.create(2, {"x": 2})
        return {"x": last["x"] + 1}

    assert b.update(add) == {"x": 3} and sorted((r.version, r.x) for r in a.table("x int").collect()) == [(1, 1), (2, 2), (3, 3)]
    assert [f for f in os.listdir(tmp_path / "log") if not f.endswith(".json")] == []
    threads = [threading.Thread(target=lambda: CommitLog(spark, root).update(lambda last: {"x": last["x"] + 1})) for _ in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert a.read(a.latest()) == {"x": 9} and json.load(open(tmp_path / "log" / f"{9:020d}.json")) == {"x": 9}


def test_registry_round_trip(spark, tmp_path):
    path = f"{tmp_path}/registry"
    assert registry.read(spark, path).count() == 0 and registry.pull(spark, path, "best").isEmpty()
    registry.append(spark, path, [{"step": 1000, "val_loss": 2.5, "path": "a"}, {"step": 2000, "val_loss": 2.1, "path": "b"}])
    registry.publish(spark, path, 3000, None, "me", now=5.0)
    assert registry.pull(spark, path, "best").first().path == "b" and registry.pull(spark, path).first().path == "checkpoints/step_0003000_me"
    rows = registry.read(spark, path).orderBy("pos").collect()
    assert [(r.trainer_id, r.shard_index, r.created) for r in rows] == [("unknown", 0, 0.0)] * 2 + [("me", 0, 5.0)]
    with pytest.raises(ValueError):
        registry.append(spark, path, [{"val_loss": 1.0}])


def test_lock(spark, tmp_path):
    path = f"{tmp_path}/lock"
    assert registry.acquire(spark, path, "a", 10, now=0.0) == (True, {"owner": "a", "acquired": 0.0, "expires": 10.0})
    assert registry.acquire(spark, path, "b", 10, now=5.0) == (False, {"owner": "a", "acquired": 0.0, "expires": 10.0})
    assert registry.acquire(spark, path, "a", 10, now=6.0)[0] and not registry.release(spark, path, "b")
    assert registry.acquire(spark, path, "b", 10, now=16.0)[0] and registry.release(spark, path, "b") and registry.acquire(spark, path, "c", now=17.0)[0]
    got = []
    free = f"{tmp_path}/free"
    threads = [threading.Thread(target=lambda o=o: got.append(registry.acquire(spark, free, o, now=0.0)[0])) for o in "abcd"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False, False, False, True]


def test_a_shard_is_one_file(spark, tmp_path):
    """Tasks do not each write to every shard; the recorded bytes are those of the shards' files."""
    rows = spark.range(4000).select(F.col("id").alias("k"), F.lit(True).alias("ok"), (F.col("id") % 40).alias("f"))
    rows.repartition(4).write.partitionBy("f").parquet(str(tmp_path / "in"))
    b = Build(spark, str(tmp_path / "in"), "k long, ok boolean", str(tmp_path / "out"), ["k"], lambda df: df.withColumn("seconds", F.lit(1.0)), shard_clips=100)
    b.run()
    assert b.rows().count() == 4000
    for shard in range(1, 41):
        parts = list((tmp_path / "out" / "data").glob(f"attempt=*/shard={shard}/*.parquet"))
        size = b.meta().where(F.col("shard") == shard).first()["bytes"] if shard % 13 == 1 else None
        assert len(parts) == 1 and size in (None, sum(p.stat().st_size for p in parts))
