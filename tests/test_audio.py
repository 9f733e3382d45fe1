"""WAV files by path, headers by ranges, and speaker folders."""

import os
import struct
import wave

import pytest
from pyspark.sql import functions as F

from tessera.sources import audio


def wav(path, samples, rate=8000, width=2, channels=1, junk=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        w.writeframes(b"".join(int(x * (1 << (8 * width - 1))).to_bytes(width, "little", signed=True) for x in samples))
    if junk:  # a chunk before the data
        raw = open(path, "rb").read()
        more = struct.pack("<4sI", b"LIST", junk) + b"x" * (junk + junk % 2)
        open(path, "wb").write(raw[:4] + struct.pack("<I", len(raw) - 8 + len(more)) + raw[8:12] + more + raw[12:])


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("wavs")
    wav(f"{d}/a/one.wav", [0.5, -0.25] * 4000)
    wav(f"{d}/a/two.wav", [0.5, -0.5] * 100, rate=16000, width=3, channels=2, junk=70_001)
    wav(f"{d}/b/none.wav", [])
    open(f"{d}/b/bad.wav", "wb").write(b"RIFF....WAVEnonsense")
    open(f"{d}/b/empty.wav", "wb").close()
    return str(d)


def test_headers(spark, files):
    want = {"a/one.wav": (8000, 1, 8000), "a/two.wav": (16000, 2, 100), "b/none.wav": (8000, 1, 0), "b/bad.wav": (None,) * 3, "b/empty.wav": (None,) * 3}
    audio.register(spark)
    rows = spark.read.format("wav_headers").option("perTask", "2").load(files)
    got = {r.path.removeprefix(files + "/"): (r.sample_rate, r.channels, r.frames) for r in rows.collect()}
    assert got == want and rows.rdd.getNumPartitions() == 3
    assert rows.agg(F.max("bytes_read")).first()[0] < 1024
    paths = spark.createDataFrame([(f"file://{files}/{p}",) for p in want] + [(f"{files}/missing.wav",), (None,)], "audio_path string")
    probed = {r.audio_path: r.h.frames for r in paths.withColumn("h", audio.probe(F.col("audio_path"))).collect()}
    assert probed[f"file://{files}/a/one.wav"] == 8000 and probed[f"{files}/missing.wav"] is None and probed[None] is None
    assert sorted((r.duration, r.channels) for r in audio.readable(paths).collect()) == [(0.0, 1), (0.006, 2), (1.0, 1)]


def test_decoding_by_path(spark, files):
    kind = "audio struct<bytes: binary, path: string, array: array<double>, sampling_rate: int>"
    content = bytearray(open(f"{files}/a/two.wav", "rb").read())
    df = spark.createDataFrame([((None, f"{files}/a/one.wav", None, None),), ((content, "nowhere", None, None),), ((None, "x", [0.1], 4000),), ((None, "nowhere", None, None),), ((None, None, None, None),), (None,)], kind)
    got = [r.d for r in df.select(audio.decode(F.col("audio"), ["bytes", "path", "array", "sampling_rate"]).alias("d")).collect()]
    assert len(got[0].samples) == 8000 and got[0].samples[:2] == [0.5, -0.25] and got[0].sample_rate == 8000
    assert len(got[1].samples) == 100 and abs(got[1].samples[0]) < 1e-6 and got[1].sample_rate == 16000
    assert got[2].samples == [0.1] and all(g is None or g.samples is None for g in got[3:])


def tree(root):
    return sorted(os.path.relpath(f"{d}/{f}", root) for d, _, names in os.walk(root) for f in names)


def test_speaker_folders(spark, files, tmp_path):
    rows = [(3, "spk 0", " third \n", f"{files}/a/one.wav"), (1, "spk_0", "first", f"{files}/a/two.wav"), (2, "ភា", "second", f"{files}/a/one.wav")]
    df, out = spark.createDataFrame(rows, "pos int, speaker_id string, text string, audio_path string").repartition(3), str(tmp_path / "fish")
    audio.write_speaker_folders(df, out, "pos")
    assert tree(out) == ["spk_0/00000001.lab", "spk_0/00000001.wav", "spk_0/00000002.lab", "spk_0/00000002.wav"] + tree(out)[4:] and len(tree(out)) == 6
    assert open(f"{out}/spk_0/00000002.lab").read() == "third\n" and open(f"{out}/spk_0/00000001.wav", "rb").read() == open(f"{files}/a/two.wav", "rb").read()
    audio.write_speaker_folders(df.where("pos = 2").withColumns({"samples": F.array(F.lit(0.5)), "sample_rate": F.lit(8000)}), out, "pos")
    assert len(tree(out)) == 2 and os.listdir(tmp_path) == ["fish"]  # replaced as a whole
    audio.write_speaker_folders(df, out, "pos", link=True)
    assert os.readlink(f"{out}/spk_0/00000001.wav") == f"{files}/a/two.wav"
    plain = df.select(F.col("speaker_id").alias("speaker"), F.lit("s").alias("stem"), F.col("text").alias("lab"), "audio_path")
    with pytest.raises(Exception, match="FileExists|exists"):
        plain.write.format("speaker_folders").mode("append").save(out)
    before = tree(out)
    with pytest.raises(Exception):  # a task that fails for good leaves nothing
        plain.unionByName(plain.limit(1).withColumn("audio_path", F.lit("/nowhere"))).write.format("speaker_folders").mode("overwrite").save(out)
    assert tree(out) == before and os.listdir(tmp_path) == ["fish"]
    plain.where("false").write.format("speaker_folders").mode("overwrite").save(out)
    assert tree(out) == []


def test_a_retried_task_leaves_no_strays(tmp_path):
    """An attempt that dies half-way, then one that runs through, then the job's commit."""
    writer = audio._FolderWriter(str(tmp_path / "out"), ["speaker", "stem", "lab", "wav"], True, False)
    rows = [("a", f"{i:08d}", f"t{i}\n", bytes([i])) for i in range(4)]

    def dying():
        yield from rows[:2]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(dying())
    open(f"{writer.job}/.drafts/left", "w").close()
    assert writer.write(iter(rows)).files == 4
    writer.commit([])
    assert tree(tmp_path) == sorted(f"out/a/{i:08d}.{x}" for i in range(4) for x in ("lab", "wav"))
