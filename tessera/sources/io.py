"""Readers and writers: manifests (JSON lines), corpora (Parquet), metrics (CSV), lines, WAV files, speaker folders."""

from __future__ import annotations

import io
import re
import wave
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import MANIFEST
from .shared import hadoop, remove

#: Names by which columns are found, best first.
CANDIDATES = {
    "audio": ("audio", "wav", "speech", "path", "file"),
    "text": ("transcript", "text", "sentence", "transcription", "normalized_text"),
    "speaker": ("speaker_id", "speaker", "client_id"),
}
#: Generations of source files in the order in which they win ties; the last is partial.
GENERATIONS = (r"-of-00653", r"train-v\d+-\d+", r"-of-00724")


def read_manifest(spark: SparkSession, paths: str | Sequence[str], schema: str = MANIFEST, strict: bool = True, position: str | None = None) -> DataFrame:
    """One or more JSON-lines files. Bad lines raise; with strict off they are kept in _corrupt_record. With ``position``
    that column tells the lines' order (by file, then place in it)."""
    reader = spark.read.schema(schema if strict else f"{schema}, _corrupt_record string")
    rows = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").json(list(paths) if not isinstance(paths, str) else paths)
    # Ids grow within a block of a file, and blocks have their starts.
    return rows.withColumn(position, F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))) if position else rows


def union(manifests: Iterable[DataFrame]) -> DataFrame:
    """All rows of all manifests, by column name, with src, the place of each row's manifest."""
    out = None
    for i, m in enumerate(manifests):
        m = m.withColumn("src", F.lit(i))
        out = m if out is None else out.unionByName(m, allowMissingColumns=True)
    return out


def read_corpus(spark: SparkSession, path: str, columns: Sequence[str] = ("audio", "transcript", "speaker_id", "sentence_id", "duration")) -> DataFrame:
    """Parquet with the named columns only."""
    return spark.read.parquet(path).select(*columns)


def read_bounded(spark: SparkSession, paths: Sequence[str], keep, n: int = 0, most_files: int = 0) -> DataFrame:
    """The first ``most_files`` files (0: all), those that are missing or broken skipped, and n rows (0: all) after the
    filter."""
    files = list(paths)[:most_files] if most_files else list(paths)
    out = spark.read.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True).parquet(*files).where(keep)
    return out.limit(n) if n else out


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*metrics*.csv").option("ignoreCorruptFiles", True).csv(path)


def latest_file(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """Of a folder's files of that name the last one written, of equally late ones the last by path; none if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()["m"]["path"] if not files.isEmpty() else None


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped lines without blank ones."""
    return spark.read.text(path).select(T.strip(F.col("value")).alias("line")).where("line <> ''")


def shard_files(files: DataFrame, split: str, path: str = "path") -> DataFrame:
    """A listing's files data/<split>-*.parquet, in path order."""
    return files.where(F.col(path).startswith(f"data/{split}-") & F.col(path).endswith(".parquet")).orderBy(path)


def generations(files: DataFrame, partial: bool = False, path: str = "path") -> DataFrame:
    """A listing's files of known generations, with gen, in (gen, path) order, which decides who wins a duplicate."""
    gen = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(GENERATIONS))):
        if i < 2 or partial:
            gen = F.when(F.col(path).rlike(pattern), i).otherwise(gen)
    return files.withColumn("gen", gen).where("gen is not null").orderBy("gen", path)


def detect_columns(columns: Sequence[str]) -> dict[str, str | None]:
    """Which columns hold audio, text and speaker; the first two must be there."""
    found = {k: next((c for c in names if c in columns), None) for k, names in CANDIDATES.items()}
    missing = [k for k in ("audio", "text") if found[k] is None]
    if missing:
        raise KeyError(f"no column for {', '.join(missing)} among {', '.join(columns)}")
    return found


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A fixed order that looks random: by md5 of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary")), key)


def _decode(content: bytes) -> tuple[list[float] | None, int | None, int | None, int | None]:
    import numpy as np

    try:
        with wave.open(io.BytesIO(content)) as w:
            width, channels = w.getsampwidth(), w.getnchannels()
            raw = w.readframes(w.getnframes())
        if width == 3:  # the three bytes as the upper ones of four
            wide = np.zeros((len(raw) // 3, 4), np.uint8)
            wide[:, 1:] = np.frombuffer(raw, np.uint8)[: len(raw) // 3 * 3].reshape(-1, 3)
            raw, width = wide.tobytes(), 4
        kind = {1: "u1", 2: "<i2", 4: "<i4"}[width]
        x = np.frombuffer(raw, kind).astype(np.float64)
        x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
        return x.reshape(-1, channels).mean(axis=1).tolist(), w.getframerate(), channels, len(x) // channels
    except Exception:
        return None, None, None, None


def _decode_wav(content: pd.Series) -> pd.DataFrame:
    """WAV bytes to mono samples; null for what cannot be read."""
    return pd.DataFrame([_decode(b) if b else (None,) * 4 for b in content], columns=["samples", "sample_rate", "channels", "frames"])


def _probe_wav(content: pd.Series) -> pd.DataFrame:
    """The header of WAV bytes."""

    def of(b):
        try:
            with wave.open(io.BytesIO(b)) as w:
                return w.getframerate(), w.getnchannels(), w.getnframes()
        except Exception:
            return None, None, None

    return pd.DataFrame([of(b) for b in content], columns=["sample_rate", "channels", "frames"])


def _encode_wav(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """Mono 16-bit PCM."""
    import numpy as np

    def of(x, r):
        if x is None:
            return None
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(int(r))
            w.writeframes(np.clip(np.round(np.asarray(x) * 32767), -32768, 32767).astype("<i2").tobytes())
        return out.getvalue()

    return pd.Series([of(x, r) for x, r in zip(samples, rate, strict=True)])


def decode_wav(content: Column) -> Column:
    """WAV bytes to mono samples; null for what cannot be read."""
    return F.pandas_udf(_decode_wav, "samples array<double>, sample_rate int, channels int, frames bigint")(content)


def probe_wav(content: Column) -> Column:
    """The header of WAV bytes."""
    return F.pandas_udf(_probe_wav, "sample_rate int, channels int, frames bigint")(content)


def encode_wav(samples: Column, rate: Column) -> Column:
    """Mono 16-bit PCM."""
    return F.pandas_udf(_encode_wav, "binary")(samples, rate)


def read_wavs(spark: SparkSession, path: str) -> DataFrame:
    """A folder's WAV files: path, samples, sample_rate, channels, frames."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path)
    return files.select("path", decode_wav(F.col("content")).alias("w")).select("path", "w.*")


def write_manifest(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; text stays as it is, and null keys are kept."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").json(path)


def write_split_files(df: DataFrame, prefix: str, names: Sequence[str] = ("train", "valid", "test")) -> None:
    """One manifest a split: <prefix>_train.jsonl and so on; a split without rows gives an empty one."""
    for n in names:
        write_manifest(df.where(F.col("split") == n).drop("split"), f"{prefix}_{n}.jsonl")


def write_speakers(df: DataFrame, path: str) -> None:
    """One folder a sanitised speaker."""
    df.write.mode("overwrite").partitionBy("speaker").parquet(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def scorecard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A line of a Markdown table for each row."""
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |")).alias("line"))


def _cache_path(root: str, key: str) -> str:
    """root/key, for keys that stay below the root."""
    if not re.fullmatch(r"[\w-][\w.-]*", key):
        raise ValueError(f"not a cache key: {key!r}")
    return f"{root}/{key}"


def cached(df_factory, spark: SparkSession, root: str, key: str) -> DataFrame:
    """The table under root/key; made first if it is not there."""
    path = _cache_path(root, key)
    fs, done = hadoop(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        df_factory().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pack(tables: dict[str, DataFrame | None], root: str, key: str) -> list[str]:
    """Keeps several tables under one key, without those that are not there (None); an error if none is. The list of their
    names is written last, so a pack is there as a whole or not at all."""
    path = _cache_path(root, key)
    there = {n: df for n, df in tables.items() if df is not None}
    if not there:
        raise ValueError("nothing to pack")
    spark = next(iter(there.values())).sparkSession
    remove(spark, path)
    for n, df in there.items():
        df.write.parquet(_cache_path(path, n))
    spark.createDataFrame([(n,) for n in there], "name string").coalesce(1).write.parquet(f"{path}/_names")
    return list(there)


def restore(spark: SparkSession, root: str, key: str) -> dict[str, DataFrame] | None:
    """What pack() kept under a key; None if it is not there as a whole, cannot be read, or the key leaves the root."""
    try:
        path = _cache_path(root, key)
        names = [r["name"] for r in spark.read.schema("name string").parquet(f"{path}/_names").collect()]
        out = {n: spark.read.parquet(_cache_path(path, n)) for n in names}
        return out or None
    except Exception:
        return None
