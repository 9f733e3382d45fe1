"""The stages of a speech corpus by one call over six generated clips, resumed and changed."""

import json
import os
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans import runner

# Sentences of the corpus and how they are read aloud.
RAW = ["សួស្តី ខ្ញុំជាជំនួយការសំឡេងភាសាខ្មែរ។", "ខ្ញុំមាន $10 នៅឆ្នាំ 2026។", "តម្លៃ ៛5000 សម្រាប់ម្ហូបនេះ។", "ថ្ងៃទី 5 ខែមករា ឆ្នាំ 2026 គឺជាថ្ងៃចាប់ផ្តើម។", "តម្លៃបញ្ចុះ 25% សម្រាប់អតិថិជនថ្មី។", "ថ្ងៃនេះ អាកាសធាតុល្អណាស់។"]
SAID = {1: "ខ្ញុំមាន ដប់ដុល្លារ នៅឆ្នាំពីរពាន់ម្ភៃប្រាំមួយ។", 2: "តម្លៃ ប្រាំពាន់រៀល សម្រាប់ម្ហូបនេះ។", 4: "តម្លៃបញ្ចុះ ម្ភៃប្រាំភាគរយ សម្រាប់អតិថិជនថ្មី។"}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    d, rows = tmp_path_factory.mktemp("speech"), []
    for i, text in enumerate(RAW):
        path, seconds = str(d / f"spk_{i % 2}_{i:04d}.wav"), 1.0 + 0.4 * i
        t = np.arange(int(24000 * seconds)) / 24000
        with wave.open(path, "wb") as w:
            w.setnchannels(1), w.setsampwidth(2), w.setframerate(24000)
            w.writeframes((0.2 * np.sin(2 * np.pi * (180 + 40 * i) * t) * 32767).astype("<i2").tobytes())
        rows.append({"audio_path": path, "text": text, "speaker_id": f"spk_{i % 2}", "duration": seconds, "source": "smoke"})
    bad = str(d / "bad.wav")
    open(bad, "wb").write(b"no audio")
    rows += [{"audio_path": bad, "text": "x", "speaker_id": "spk_0", "duration": 1.0}, {"audio_path": str(d / "gone.wav"), "text": "y", "speaker_id": "spk_0", "duration": 1.0}]
    path = str(d / "raw.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)
    return path


def test_from_manifest_to_folders(spark, corpus, tmp_path):
    def halved(samples, rate):
        return [(0, len(samples) // 4), (len(samples) // 4, len(samples) // 2)] if len(samples) > rate * 1.5 else []

    root = str(tmp_path / "work")
    where, made = runner.speech(spark, root, corpus)
    assert made == [s.name for s in runner.SPEECH] and spark.read.parquet(where["ingest"]).count() == 8
    checked = spark.read.parquet(where["check"]).collect()
    assert len(checked) == 6 and {(r.quality_grade, r.sample_rate, r.channels, r.clipping_ratio, r.silence_ratio) for r in checked} == {("A", 24000, 1, 0.0, 0.0)}
    assert all(abs(r.peak_db + 13.98) < 0.011 and abs(r.rms_db + 16.99) < 0.011 for r in checked)
    assert {r.quality_grade: r.n for r in spark.read.json(where["check"] + ".grades").collect()} == {"A": 6, "B": 0, "C": 0, "D": 0}
    folders = where["validate"] + ".folders"
    names = sorted(os.path.relpath(f"{d}/{f}", folders) for d, _, fs in os.walk(folders) for f in fs)
    assert names == [f"spk_{s}/{i:08d}.{x}" for s in (0, 1) for i in (1, 2, 3) for x in ("lab", "wav")]
    for i, text in SAID.items():  # counters a speaker, in the manifest's order
        assert open(f"{folders}/spk_{i % 2}/{i // 2 + 1:08d}.lab", encoding="utf-8").read() == text + "\n"
    with wave.open(f"{folders}/spk_1/00000002.wav") as w:
        assert w.getframerate() == 24000 and w.getnframes() == int(24000 * 2.2) and w.getsampwidth() == 2
    assert spark.read.json(f"{where['split']}.manifests/clips_train.jsonl").count() == 6
    meta = spark.read.json(where["pack"] + ".meta").collect()
    assert [(m.shard, m.clips, m.source_files) for m in meta] == [(1, 6, "smoke")]
    # Nothing is made twice; another option remakes what depends on it; the rest is found.
    assert runner.speech(spark, root, corpus)[1] == []
    again, made = runner.speech(spark, root, corpus, vad={"detector": halved})
    assert made == ["vad", "level", "normalize", "split", "validate", "pack"]
    cut = {r.audio_path[-8:-4]: r for r in spark.read.parquet(again["level"]).collect()}
    assert sorted(cut) == ["0002", "0003", "0004", "0005"] and cut["0005"].speech_ratio == 0.5 and cut["0005"].duration == 1.5
    assert runner.speech(spark, root, corpus, upto="vad")[1] == []
    # A table that a lost run left without its mark is made again.
    os.remove(f"{where['pack']}/_SUCCESS")
    assert runner.speech(spark, root, corpus)[1] == ["pack"]


def test_denoiser_and_errors(spark, corpus, tmp_path):
    loud = runner.denoise(spark.createDataFrame([(json.loads(line)["audio_path"], g) for line, g in zip(open(corpus, encoding="utf-8"), "ABCD", strict=False)], "audio_path string, quality_grade string"), denoiser=lambda s, r: s * 2)
    from tessera.sources import io

    peaks = {r.quality_grade: r.p for r in loud.select("quality_grade", F.array_max(io.decode_wav(F.col("wav"))["samples"]).alias("p")).collect()}
    assert {g: round(p, 2) for g, p in peaks.items()} == {"A": 0.2, "B": 0.4, "C": 0.4}
    with pytest.raises(ValueError, match="no such stage"):
        runner.speech(spark, str(tmp_path), corpus, nothing={})
