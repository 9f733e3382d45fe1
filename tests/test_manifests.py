import math
import struct
import wave

import pytest
from pyspark.sql import functions as F

from tessera.functions import signal as S
from tessera.functions.hashing import bucket
from tessera.operators import quality as Q
from tessera.operators import relational as R
from tessera.sources import audio, io
from tessera.streaming import incremental


def test_smoke_clips(spark, tmp_path):
    """Six sine clips: known levels, no clipping or silence, grade A."""
    for i in range(6):
        with wave.open(str(tmp_path / f"spk_{i % 2}_{i:04d}.wav"), "wb") as w:
            w.setnchannels(1), w.setsampwidth(2), w.setframerate(24000)
            w.writeframes(b"".join(struct.pack("<h", int(0.2 * math.sin(2 * math.pi * (180 + 40 * i) * k / 24000) * 32767)) for k in range(int(24000 * (1.0 + 0.4 * i)))))
    clips = Q.measured(io.read_wavs(spark, str(tmp_path)), "samples", F.col("sample_rate"))
    rows = clips.withColumn("g", Q.grade(F.col("duration"), F.lit("ab"), F.col("clipping_ratio"), F.col("sample_rate"), F.col("silence_ratio"), F.col("rms_db"))).orderBy("path").collect()
    assert [r.duration for r in rows if "spk_0" in r.path] == [1.0, 1.8, 2.6]
    for r in rows:
        assert abs(r.peak_db + 13.98) < 0.011 and abs(r.rms_db + 16.99) < 0.011 and r.clipping_ratio == 0 and r.silence_ratio == 0 and r.g == "A"
    back = spark.range(1).select(io.decode_wav(io.encode_wav(F.array(F.lit(0.5), F.lit(-0.25)), F.lit(16000))).alias("w")).first().w
    assert back.sample_rate == 16000 and abs(back.samples[0] - 0.5) < 1e-4


def test_signal_edges(spark):
    row = spark.range(1).select(
        S.metrics(F.array().cast("array<double>"), F.lit(16000)).alias("empty"),
        S.trim(F.array(*map(F.lit, [0.0] * 8 + [0.5] * 4 + [0.0] * 8)), F.lit(4), F.lit(1)).alias("cut"),
        S.with_pauses(F.array(F.array(F.lit(1.0)), F.array(F.lit(2.0))), F.lit(2)).alias("joined"),
        S.cap_peak(F.array(F.lit(1.96), F.lit(-0.5))).alias("cap"),
    ).first()
    assert row.empty.clipping_ratio == 1 and row.empty.silence_ratio == 1 and row.empty.duration == 0
    assert row.cut == [0.0, 0.5, 0.5, 0.5, 0.5, 0.0] and row.joined == [1.0, 0.0, 0.0, 2.0] and row.cap == [0.98, -0.25]


def test_dedup_follows_acceptance(spark):
    rows = spark.createDataFrame([(1, "k", False), (2, "k", True), (3, "k", True), (4, "k", False)], "pos int, key string, ok boolean")
    assert [r.status for r in R.acceptance(rows, ["key"], "pos", F.col("ok")).orderBy("pos").collect()] == ["rejected", "accepted", "duplicate", "duplicate"]


def test_registry_and_lock(spark):
    reg = spark.createDataFrame([(0, 1000, 2.5), (1, 2000, 2.1), (2, 3000, None), (3, 2000, 2.1)], "pos int, step long, val_loss double")
    assert R.pull(reg, "best").first().pos == 1 and R.pull(reg).first().pos == 2
    assert R.pull(reg.where("pos < 0"), "best").isEmpty()
    with pytest.raises(ValueError):
        R.pull(reg, "other")
    lock = spark.createDataFrame([("a", 0.0, 10.0)], "owner string, acquired double, expires double")
    assert [R.acquire(lock, o, F.lit(n)).first().granted for o, n in (("b", 5.0), ("a", 5.0), ("b", 11.0))] == [False, True, True]
    assert R.release(lock, "a").isEmpty() and not R.release(lock, "b").isEmpty()


def test_split_and_buckets(spark):
    rows = spark.range(6)
    assert {r.split for r in R.exact_split(rows, "id").collect()} == {"train"}
    sizes = dict(R.exact_split(spark.range(1000), "id", valid=0.1, test=0.05).groupBy("split").count().collect())
    assert sizes == {"valid": 100, "test": 50, "train": 850}
    import hashlib

    got = spark.range(50).select("id", *(bucket(F.col("id"), n).alias(f"b{n}") for n in (2, 3, 7))).collect()
    assert all(r[f"b{n}"] == int(hashlib.md5(str(r.id).encode()).hexdigest(), 16) % n for r in got for n in (2, 3, 7))


def test_validation(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"audio_path":"a","text":"x","speaker_id":"s","duration":1.5}\n{bad\n\n{"audio_path":"a","text":" ","speaker_id":"s","duration":1}\n{"text":"x","speaker_id":"s","duration":1}\n')
    rows = Q.validated(io.read_manifest(spark, str(tmp_path / "m.jsonl"), strict=False), F.lit(True), "_corrupt_record").cache()
    assert sorted(str(r.error) for r in rows.collect()) == ["None", "empty text", "invalid json", "missing audio_path"]
    with pytest.raises(ValueError):
        Q.require_valid(rows)
    with pytest.raises(ValueError):
        Q.require_valid(rows.where("false"))
    with pytest.raises(KeyError):
        io.detect_columns(["text"])
    assert io.detect_columns(["wav", "sentence", "speaker"]) == {"audio": "wav", "text": "sentence", "speaker": "speaker"}


def test_incremental_build(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    rows = lambda a, b: spark.createDataFrame([(i, i % 5 != 0) for i in range(a, b)], "k long, ok boolean").coalesce(1)
    rows(0, 50).write.mode("append").parquet(src)
    run = lambda: incremental.build(spark, src, "k long, ok boolean", out, state, ["k"], lambda df: df.where("ok"))
    run()
    assert incremental.shards(spark, out).count() == 40
    run()
    assert incremental.shards(spark, out).count() == 40
    rows(30, 60).write.mode("append").parquet(src)
    run()
    got = incremental.shards(spark, out)
    assert got.count() == 48 and got.select("k").distinct().count() == 48


def test_incremental_order(spark, tmp_path):
    """Two batches: a null order loses to any other and keeps its key; a key of the first batch stays its."""
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    put = lambda rows: spark.createDataFrame(rows, "k string, o long, n string").coalesce(1).write.mode("append").parquet(src)
    run = lambda: incremental.build(spark, src, "k string, o long, n string", out, state, ["k"], order="o")
    put([("k1", None, "a"), ("k2", 5, "b"), ("k2", None, "c"), ("k2", 4, "d"), (None, 1, "e")])
    run()
    put([("k1", 1, "f"), ("k3", None, "g"), (None, 0, "h")])
    run()
    assert sorted((str(r.k), r.n) for r in incremental.shards(spark, out).collect()) == [("None", "e"), ("k1", "a"), ("k2", "d"), ("k3", "g")]


def test_latest_file(spark, tmp_path):
    import os

    for name, at in (("a.ckpt", 300), ("b.ckpt", 200), ("c.txt", 900), ("d.ckpt", 300)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (at, at))
    assert io.latest_file(spark, str(tmp_path), "*.ckpt").endswith("/d.ckpt") and io.latest_file(spark, str(tmp_path), "*.none") is None


def test_rounds(spark):
    df = spark.range(3000).select("id")
    got = [{r.id for r in R.rounds(df, "id", [20, 100, 1000]).where(F.col("round") <= k).collect()} for k in (1, 2, 3)]
    assert [len(g) for g in got] == [20, 100, 1000] and got[0] < got[1] < got[2]
    more = {r.id for r in R.rounds(df, "id", [20, 100, 1000, 9000]).where("round <= 3").collect()}
    assert more == got[2] and R.rounds(df, "id", [20, 9000]).count() == 3000 and R.rounds(df.where("false"), "id", [5]).count() == 0
    with pytest.raises(ValueError):
        R.rounds(df, "id", [20, 20])


def test_packs(spark, tmp_path):
    root = str(tmp_path / "cache")
    assert io.restore(spark, root, "k1") is None
    assert io.pack({"a": spark.range(3), "gone": None, "b": spark.range(2)}, root, "k1") == ["a", "b"]
    assert {n: df.count() for n, df in io.restore(spark, root, "k1").items()} == {"a": 3, "b": 2}
    io.pack({"a": spark.range(5)}, root, "k1")
    assert {n: df.count() for n, df in io.restore(spark, root, "k1").items()} == {"a": 5}
    with pytest.raises(ValueError):
        io.pack({"a": None}, root, "k2")
    for key in ("../cache/k1", "k1/a", "", ".."):
        assert io.restore(spark, root, key) is None
        with pytest.raises(ValueError):
            io.pack({"a": spark.range(1)}, root, key)
    (tmp_path / "cache" / "k1" / "a").rename(tmp_path / "cache" / "k1" / "moved")
    assert io.restore(spark, root, "k1") is None


def test_references(spark):
    one = lambda rows, c: spark.createDataFrame(rows, f"k string, {c} string")
    speakers, audio = one([(k, "") for k in "abcdef"], "x"), one([(k, "") for k in "abcdeea"], "x")
    txt, lab = one([("a", " hi\n"), ("b", "\n"), ("c", None), ("e", "one"), ("e", "one")], "txt"), one([("b", "lab b"), ("d", "\tlab d "), ("c", "lab c")], "lab")
    got = sorted((r.k, r.reference) for r in R.references(speakers, audio, txt, lab, "k").collect())
    assert got == [("a", "hi"), ("b", None), ("c", None), ("d", "lab d"), ("e", "one")]


def test_bounded_read(spark, tmp_path):
    for i in range(120):
        (tmp_path / f"{i:03d}.parquet").mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    paths = []
    for i in range(120):
        paths.append(f"{tmp_path}/{i:03d}.parquet/x.parquet")
        pq.write_table(pa.table({"i": [i]}), paths[-1])
    assert io.read_bounded(spark, paths, F.lit(True)).count() == 120 and io.read_bounded(spark, paths, F.lit(True), most_files=7).count() == 7
    assert io.read_bounded(spark, paths, F.col("i") > 3, n=5).count() == 5


def test_sources(spark, tmp_path):
    files = spark.createDataFrame([(f"data/train-{x}",) for x in ("1-of-00653.parquet", "v2-3.parquet", "9-of-00724.parquet", "0-of-00653.parquet")], "path string")
    assert [r.gen for r in io.generations(files).collect()] == [0, 0, 1] and io.generations(files, partial=True).count() == 4
    assert io.shard_files(files, "train").count() == 4
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "metrics.csv").write_text("step,val/loss\n1,2.5\n2,\n3,x\n4,1.25\n")
    assert R.min_named(io.read_metrics(spark, str(tmp_path)), "val", "loss").first().value == 1.25
    made = []
    make = lambda: made.append(1) or spark.range(3)
    assert [io.cached(make, spark, str(tmp_path / "c"), "k1").count() for _ in range(2)] == [3, 3] and len(made) == 1


def test_loudness(spark):
    sine = lambda rate, s, a: [a * math.sin(2 * math.pi * 997 * k / rate) for k in range(int(rate * s))]
    rows = spark.createDataFrame([(0, sine(48000, 2, 1.0), 48000), (1, sine(16000, 2, 0.1), 16000), (2, [0.5] * 10, 16000), (3, [0.0] * 16000, 16000), (4, None, 16000)], "i int, s array<double>, r int")
    got = {r.i: r for r in rows.withColumn("l", S.loudness(F.col("s"), F.col("r"))).withColumn("o", S.to_loudness(F.col("s"), F.col("l"))).collect()}
    assert abs(got[0].l + 3.01) < 0.05 and abs(got[1].l + 23.01) < 0.1  # a full-scale tone of 997 Hz reads -3.01
    assert abs(max(got[1].o) - 0.1 * 10 ** ((-20 - got[1].l) / 20)) < 1e-6 and abs(max(got[2].o) - 0.7) < 1e-9 and set(got[3].o) == {0.0} and got[4].o is None
    for r in rows.where("s is not null").collect():
        assert all(abs(a - b) < 1e-9 for a, b in zip(S.leveled(r.s, r.r), got[r.i].o, strict=True))


def test_audio_forms_and_stages(spark, tmp_path):
    import io as memory

    from tessera.plans import stages

    out = memory.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(3), w.setframerate(8000)
        w.writeframes(b"".join(int(x * (1 << 23)).to_bytes(3, "little", signed=True) for x in (0.5, -0.25)))
    df = spark.createDataFrame([((bytearray(out.getvalue()), None, None),), ((None, [0.1], 4000),), ((None, None, None),)], "audio struct<bytes: binary, array: array<double>, sampling_rate: int>")
    got = [r.a for r in df.select(audio.decode(F.col("audio"), ["bytes", "array", "sampling_rate"]).alias("a")).collect()]
    assert [round(x, 4) for x in got[0].samples] == [0.5, -0.25] and got[0].sample_rate == 8000 and (got[1].samples, got[1].sample_rate) == ([0.1], 4000) and (got[2] is None or got[2].samples is None)
    io.write_split_files(spark.createDataFrame([(1, "train"), (2, "test")], "i int, split string"), f"{tmp_path}/m")
    assert spark.read.schema("i int").json(f"{tmp_path}/m_train.jsonl").collect()[0].i == 1 and spark.read.schema("i int").json(f"{tmp_path}/m_valid.jsonl").count() == 0
    clips = spark.createDataFrame([(1, "A"), (2, "C")], "i int, quality_grade string")
    double = lambda batches: (b.assign(i=b["i"] * 2) for b in batches)
    assert [r.i for r in stages.run(clips, ["filter", "denoise", "vad"], denoise={"hook": double}).collect()] == [2]
    with pytest.raises(ValueError, match="no such stage"):
        stages.run(clips, ["nothing"])
    names = spark.createDataFrame([("a", "spk_1")], "name string, speaker string")
    assert R.mapped(spark.createDataFrame([("a",)], "name string"), names, "name").first().speaker == "spk_1"
    with pytest.raises(Exception, match="no name for"):
        R.mapped(spark.createDataFrame([("b",)], "name string"), names, "name").collect()
    raw = spark.createDataFrame([("a.wav", "តម្លៃបញ្ចុះ 25%"), ("a.wav", "z"), (None, "x")], "audio_path string, text string")
    done = stages.run(raw, ["ingest", "normalize"]).collect()
    assert {r.text_raw for r in done} == {"តម្លៃបញ្ចុះ 25%", "z"}
    clips = [("a", "s1", "1", "x"), ("b", "s1", "1", "y"), ("c", "s2", "1", "x"), ("d", "s1", "", "x"), ("e", "s1", None, "x"), ("f", "s1", "2", "x"), ("g", None, None, "x")]
    got = stages.ingest(spark.createDataFrame(clips, "audio_path string, speaker_id string, sentence_id string, text string"))
    assert sorted(r.audio_path for r in got.collect()) == ["a", "c", "d", "f", "g"]  # keyed by speaker and sentence, or text where there is no id


def documents(spark, path, rows: int = 400) -> str:
    """A table of documents in four files; every fourth text comes twice, one row has no id and one no text."""
    ids = [*range(rows), None]
    made = [(i, None if i == 7 else f"text {(i or 0) // 4 * 4 if (i or 0) % 4 < 2 else i}", "s", 300 + (i or 0) % 7, "en") for i in ids] + [(None, "only without an id", "s", 5, "en")]
    spark.createDataFrame(made, "doc_id bigint, text string, source string, n_chars bigint, lang string").repartition(4).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_bounded_scan_writes_with_all_tasks(spark, tmp_path, monkeypatch):
    """No task takes a whole quarter of the table."""
    from tessera.plans import files

    d = documents(spark, tmp_path / "d")
    monkeypatch.setattr(files.shared, "shared_path", lambda spark, name: str(tmp_path / name))
    got = sorted(r.doc_id for r in files.bounded_scan(spark, d).collect())
    assert got == [i for i in range(400) if i % 4 < 3]
    assert all(len(list((tmp_path / "corpus" / f"f={i}").glob("*.parquet"))) > 1 for i in range(4))


def test_stream_comes_in_many_files(spark, tmp_path, monkeypatch):
    """No task writes a whole delivery, and rows without an id are taken too."""
    from tessera.plans import catalog

    d = documents(spark, tmp_path / "d")
    monkeypatch.setattr(catalog.shared, "shared_dir", lambda spark: str(tmp_path))
    got = {r.text: (r.n, r.doc_id) for r in catalog.stream_incremental_dedup(spark, d).collect()}
    assert len(got) == 301 and got["only without an id"] == (1, None) and got["text 4"] == (1, 4) and got[None] == (1, 7)
    assert len(list(tmp_path.glob("stream-*/in/*.parquet"))) > 6
