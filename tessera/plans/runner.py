"""A graph of stages that are kept by their content: what was made from the same inputs with the same options is not made again.

A stage's key is a digest of its name, its options and the keys of its inputs; a source's is that of its files' names, sizes
and times. Its table is written under that key and read again by the next stages, its reports beside it, each
there as a whole or not at all. A run that was lost goes on where it stopped, another option remakes what depends on it, and
what an earlier run made stays.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal as S
from ..operators import cuts
from ..operators import quality as Q
from ..operators import relational as R
from ..schema import MANIFEST, Limits
from ..sources import audio, io
from ..sources.io import _decode, _encode_wav
from ..sources.shared import hadoop, ship
from . import stages

#: Samples and rate to samples of the same rate, or to the (start, end) of speech in samples.
Denoiser = Callable[[np.ndarray, int], np.ndarray]
Detector = Callable[[np.ndarray, int], Sequence[tuple[int, int]]]


class Step(NamedTuple):
    """``work`` makes a table of those of ``inputs``; ``reports`` are tables made of it; ``sinks`` write what is no table."""

    name: str
    work: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    reports: dict[str, Callable[[DataFrame], DataFrame]] = {}
    sinks: dict[str, Callable[[DataFrame, str], None]] = {}


def _said(option) -> str:
    """An option as it enters a key: functions by their name."""
    return f"{option.__module__}.{option.__qualname__}" if callable(option) else repr(option)


def _done(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def source_key(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """A digest of files' names, sizes and times, summed where they are listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths if isinstance(paths, str) else list(paths))
    one = F.conv(F.substring(F.md5(F.concat_ws("|", "path", F.col("length"), F.unix_micros("modificationTime")).cast("binary")), 1, 12), 16, 10).cast("long")
    return str(files.agg(F.coalesce(F.sum(one), F.lit(0)), F.count(F.lit(1))).first())


class Runner:
    def __init__(self, spark: SparkSession, root: str, steps: Sequence[Step]):
        self.spark, self.root, self.steps, self.made = spark, root.rstrip("/"), list(steps), []
        ship(spark)

    def run(self, sources: dict[str, tuple[str, Callable[[], DataFrame]]], upto: str | None = None, **options: dict) -> dict[str, str]:
        """Runs the stages up to one of them (all) over the sources (name: key and reader) and returns where their tables are;
        ``made`` tells which had to be made."""
        if unknown := set(options) - {s.name for s in self.steps}:
            raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
        keys, where, tables = {n: k for n, (k, _) in sources.items()}, {}, {n: read for n, (_, read) in sources.items()}
        self.made = []
        for step in self.steps:
            own = options.get(step.name, {})
            said = json.dumps([step.name, sorted((k, _said(v)) for k, v in own.items()), [keys[i] for i in step.inputs]])
            keys[step.name] = hashlib.md5(said.encode()).hexdigest()
            path = where[step.name] = f"{self.root}/{step.name}-{keys[step.name][:16]}"
            if not _done(self.spark, path):
                step.work(*(tables[i]() for i in step.inputs), **own).write.mode("overwrite").parquet(path)
                self.made.append(step.name)
            tables[step.name] = lambda p=path: self.spark.read.parquet(p)
            for name, of in step.reports.items():
                if not _done(self.spark, f"{path}.{name}"):
                    of(tables[step.name]()).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}.{name}")
            for name, put in step.sinks.items():
                mark = f"{path}.{name}.done"
                if not _done(self.spark, mark):
                    put(tables[step.name](), f"{path}.{name}")
                    self.spark.range(0).write.mode("overwrite").parquet(mark)
            if step.name == upto:
                break
        return where


# The stages of a speech corpus. Audio is a path up to the quality check and 16-bit PCM bytes (wav) behind it.


def export(clips: DataFrame) -> DataFrame:
    """Clips whose file is there and readable, with its duration, sample_rate and channels."""
    return audio.readable(clips)


def check(clips: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Clips with their metrics and grade."""
    decoded = clips.withColumn("__d", audio.decode_path(F.col("audio_path"))).where("__d.samples is not null").withColumn("__s", F.col("__d.samples"))
    metrics = ["peak_db", "rms_db", "clipping_ratio", "silence_ratio", "duration"]
    out = Q.measured(decoded.drop(*metrics), "__s", F.col("sample_rate")).drop("__d", "__s")
    return out.withColumn("quality_grade", Q.grade(*(F.col(c) for c in ("duration", "text", "clipping_ratio", "sample_rate", "silence_ratio", "rms_db")), limits))


def _edited(edit: Denoiser):
    def run(wavs: pd.Series) -> pd.Series:
        out = []
        for b in wavs:
            samples, rate, *_ = _decode(b) if b else (None, None)
            out.append(None if samples is None else _encode_wav([edit(np.asarray(samples), rate)], [rate])[0])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "binary")


def denoise(clips: DataFrame, lowest: str = "C", denoiser: Denoiser | None = None) -> DataFrame:
    """Clips of the lowest grade or better with their audio, those that are not of grade A through the denoiser, if any."""
    out = Q.at_least(clips, lowest).withColumn("wav", audio.load(F.col("audio_path"))).where("wav is not null")
    if denoiser:
        out = out.withColumn("wav", F.when(Q.route(F.col("quality_grade")) == "passthrough", F.col("wav")).otherwise(_edited(denoiser)(F.when(F.col("quality_grade") != "A", F.col("wav")))))
    return out


def _spoken(detector: Detector):
    def run(wavs: pd.Series) -> pd.DataFrame:
        rows = []
        for b in wavs:
            samples, rate, *_ = _decode(b)
            spans = [] if samples is None else list(detector(np.asarray(samples), rate))
            if not spans or not len(samples):
                rows.append((0.0, None))
                continue
            part = np.asarray(samples)[spans[0][0] : spans[-1][1]]  # pauses inside stay
            rows.append((sum(e - s for s, e in spans) / len(samples), _encode_wav([part], [rate])[0]))
        return pd.DataFrame(rows, columns=["speech_ratio", "wav"])

    return F.pandas_udf(run, "speech_ratio double, wav binary")


def vad(clips: DataFrame, detector: Detector | None = None, least: float = 0.4) -> DataFrame:
    """Clips cut to what lies between the first and the last speech, with speech_ratio; those without enough go. Without a
    detector all stay as they are, with ratio 1."""
    if detector is None:
        return clips.withColumn("speech_ratio", F.lit(1.0))
    out = clips.withColumn("__v", _spoken(detector)(F.col("wav"))).where((F.col("__v.speech_ratio") >= least) & F.col("__v.wav").isNotNull())
    return out.withColumns({"speech_ratio": F.round("__v.speech_ratio", 4), "wav": F.col("__v.wav")}).drop("__v")


def level(clips: DataFrame, target: float = -20.0) -> DataFrame:
    """Clips at the target loudness, mono."""

    def run(wavs: pd.Series) -> pd.DataFrame:
        rows = []
        for b in wavs:
            samples, rate, *_ = _decode(b)
            rows.append((None, None) if samples is None else (_encode_wav([S.leveled(samples, rate, target)], [rate])[0], round(len(samples) / rate, 3)))
        return pd.DataFrame(rows, columns=["wav", "duration"], dtype=object)

    out = clips.withColumn("__w", F.pandas_udf(run, "wav binary, duration double")(F.col("wav"))).where("__w.wav is not null")
    return out.withColumns({"wav": F.col("__w.wav"), "duration": F.col("__w.duration"), "channels": F.lit(1)}).drop("__w")


def normalize(clips: DataFrame) -> DataFrame:
    return Q.not_blank(stages.normalize(clips), "text")


def split(clips: DataFrame, seed: int = 42, valid: float = 0.02, test: float = 0.02) -> DataFrame:
    return R.exact_split(clips, "audio_path", seed, valid, test)


def validate(clips: DataFrame) -> DataFrame:
    """Clips to train on; raises if one is not valid, or none is left."""
    rows = Q.validated(clips.where("split = 'train'"), F.col("wav").isNotNull())
    return Q.require_valid(rows).drop("error")


def pack(clips: DataFrame, shard_clips: int = 20_000) -> DataFrame:
    """Clips with shard, by their order, each shard closed by the clip that fills it."""
    numbered = cuts.sequence(clips, ["pos"], name="place")
    shards = cuts.greedy_chunks(numbered.select("place", F.lit(1).alias("one")), "place", "one", shard_clips).select("place", F.col("chunk").alias("shard"))
    return numbered.join(shards, "place")


def _manifest(clips: DataFrame) -> DataFrame:
    return clips.drop("wav", "pos")


def _splits(clips: DataFrame, path: str) -> None:
    io.write_split_files(_manifest(clips), f"{path}/clips")


def _folders(clips: DataFrame, path: str) -> None:
    audio.write_speaker_folders(clips, path, "pos")


def _shards(clips: DataFrame) -> DataFrame:
    measured = clips.withColumns({"__size": F.length("wav"), "__source": F.coalesce("source", F.lit(""))})
    return R.shard_meta(measured, ["shard"], "duration", "__size", "__source")


SPEECH = (
    Step("ingest", stages.ingest, ("manifest",)),
    Step("export", export, ("ingest",)),
    Step("check", check, ("export",), {"grades": Q.grade_histogram}),
    Step("denoise", denoise, ("check",)),
    Step("vad", vad, ("denoise",)),
    Step("level", level, ("vad",)),
    Step("normalize", normalize, ("level",)),
    Step("split", split, ("normalize",), {"hours": lambda df: df.groupBy("split").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration") / 3600, 4).alias("hours"))}, {"manifests": _splits}),
    Step("validate", validate, ("split",), {"speakers": lambda df: df.groupBy(F.col("speaker_id").alias("speaker")).agg(F.count(F.lit(1)).alias("clips"))}, {"folders": _folders}),
    Step("pack", pack, ("validate",), {"meta": _shards}),
)


def speech(spark: SparkSession, root: str, manifests: str | Sequence[str], upto: str | None = None, schema: str = MANIFEST, **options: dict) -> tuple[dict[str, str], list[str]]:
    """All stages from manifests to speaker folders and shards: where each stage's table is, and which were made anew."""
    runner = Runner(spark, root, SPEECH)
    read = lambda: io.read_manifest(spark, manifests, schema, position="pos")
    return runner.run({"manifest": (source_key(spark, manifests), read)}, upto, **options), runner.made
