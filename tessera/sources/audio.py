"""WAV files by path: headers by byte ranges, decoding on executors, and folders of wav and lab files a speaker.

Paths are opened where the tasks run, with pyarrow's file systems: plain and file: paths, hdfs:, s3: and gs: as far as the
machine has their drivers. Executors must see the files; the driver reads none of them.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..functions import text as T
from .io import _decode, decode_wav, encode_wav
from .shared import ship

_HEADER = "sample_rate int, channels int, frames bigint, bytes_read int"
#: Bytes of a header's first read; chunks that lie further on are stepped over by reads of 8 bytes.
FIRST = 128


def opened(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if re.match(r"\w[\w+.-]+://", path) else (fs.LocalFileSystem(), path)


def header(path: str) -> tuple[int, int, int, int] | tuple[None, None, None, None]:
    """Sample rate, channels, frames and bytes that were read of a RIFF file; nones if it is none or is not there. Frames are
    those that the file holds, where its header claims more."""
    try:
        system, inner = opened(path)
        with system.open_input_file(inner) as f:
            size, head, read = f.size(), f.read_at(FIRST, 0), FIRST

            def at(i: int, n: int) -> bytes:
                nonlocal read
                if i + n <= len(head):
                    return head[i : i + n]
                read += n
                return f.read_at(n, i)

            if at(0, 4) != b"RIFF" or at(8, 4) != b"WAVE":
                return (None,) * 4
            place, form = 12, None
            while place + 8 <= size and read < 1024:
                name, length = struct.unpack("<4sI", at(place, 8))
                if name == b"fmt ":
                    form = struct.unpack("<HHIIHH", at(place + 8, 16))
                elif name == b"data" and form:
                    _, channels, rate, _, block, _ = form
                    return rate, channels, min(length, size - place - 8) // block, min(read, size)
                place += 8 + length + length % 2
    except Exception:  # missing, no permission, or broken: the row says so by its nulls
        pass
    return (None,) * 4


def _bytes(path: str) -> bytes | None:
    try:
        system, inner = opened(path)
        with system.open_input_stream(inner) as f:
            return f.read()
    except Exception:
        return None


def _headers(paths: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([header(p) if p else (None,) * 4 for p in paths], columns=["sample_rate", "channels", "frames", "bytes_read"], dtype=object)


def _decoded(paths: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_decode(b) if p and (b := _bytes(p)) else (None,) * 4 for p in paths], columns=["samples", "sample_rate", "channels", "frames"], dtype=object)


def _loaded(paths: pd.Series) -> pd.Series:
    return pd.Series([_bytes(p) if p else None for p in paths], dtype=object)


def probe(path: Column) -> Column:
    """struct of sample_rate, channels, frames and bytes_read, from under 1 KB of a file; nulls for what cannot be read."""
    return F.pandas_udf(_headers, _HEADER)(path)


def decode_path(path: Column) -> Column:
    """struct of mono samples, sample_rate, channels and frames of a WAV file; nulls for what cannot be read."""
    return F.pandas_udf(_decoded, "samples array<double>, sample_rate int, channels int, frames bigint")(path)


def load(path: Column) -> Column:
    """A file's bytes; null for what cannot be read."""
    return F.pandas_udf(_loaded, "binary")(path)


def decode(audio: Column, fields: Sequence[str]) -> Column:
    """samples and sample_rate of an audio struct: what is decoded already (array, sampling_rate), else its bytes, else
    the file at its path."""
    out = F.lit(None).cast("struct<samples: array<double>, sample_rate: int>")
    pick = lambda w: F.struct(w["samples"].alias("samples"), w["sample_rate"].alias("sample_rate"))
    left = F.lit(True)
    steps = []
    if "array" in fields:
        steps.append((audio["array"].isNotNull(), lambda c: F.struct(audio["array"].cast("array<double>").alias("samples"), audio["sampling_rate"].cast("int").alias("sample_rate"))))
    if "bytes" in fields:
        steps.append((F.length(audio["bytes"]) > 0, lambda c: pick(decode_wav(F.when(c, audio["bytes"])))))
    if "path" in fields:
        steps.append((audio["path"].isNotNull(), lambda c: pick(decode_path(F.when(c, audio["path"])))))
    chosen = []
    for there, of in steps:  # a UDF gets only the rows that nothing before it has
        now = F.coalesce(left & there, F.lit(False))
        chosen.append((now, of(now)))
        left = left & ~F.coalesce(there, F.lit(False))
    for now, value in reversed(chosen):
        out = F.when(now, value).otherwise(out)
    return out


def readable(df: DataFrame, path: str = "audio_path") -> DataFrame:
    """df without rows whose file is missing or no WAV file, with the header's duration, sample_rate and channels."""
    ship(df.sparkSession)
    h = df.withColumn("__h", probe(F.col(path))).where("__h.frames is not null and __h.sample_rate > 0")
    return h.withColumns({"duration": F.round(F.col("__h.frames") / F.col("__h.sample_rate"), 3), "sample_rate": F.col("__h.sample_rate"), "channels": F.col("__h.channels")}).drop("__h")


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _HeaderReader(DataSourceReader):
    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path, per_task

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        system, inner = opened(self.path)
        found = sorted(x.path for x in system.get_file_info(fs.FileSelector(inner, recursive=True)) if x.path.lower().endswith(".wav"))
        start = self.path[: self.path.index("://") + 3] if "://" in self.path else ""
        return [_Files([start + p for p in found[i : i + self.per_task]]) for i in range(0, len(found), self.per_task)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for p in partition.paths:
            yield (p, *header(p))


class WavHeaders(DataSource):
    """``spark.read.format("wav_headers").load(folder)``: path and header of the WAV files below a folder; option perTask."""

    @classmethod
    def name(cls) -> str:
        return "wav_headers"

    def schema(self) -> str:
        return f"path string, {_HEADER}"

    def reader(self, schema) -> DataSourceReader:
        return _HeaderReader(self.options["path"], int(self.options.get("perTask", "1000")))


class _Done(WriterCommitMessage):
    def __init__(self, files: int):
        self.files = files


class _FolderWriter(DataSourceWriter):
    """Tasks write below a folder of the job, each file under a name of its own first, then under its final one: an attempt
    that is run again replaces what the lost one wrote. The job's folder becomes the target by one rename when all tasks are
    done, and goes if one fails for good."""

    def __init__(self, path: str, columns: list[str], overwrite: bool, link: bool):
        self.system, self.target = opened(path.rstrip("/"))
        self.names, self.link = {c: i for i, c in enumerate(columns)}, link
        missing = {"speaker", "stem", "lab"} - set(columns)
        if missing or not {"wav", "audio_path"} & set(columns):
            raise ValueError(f"speaker folders need speaker, stem, lab, and wav or audio_path; missing: {sorted(missing) or 'wav'}")
        if not overwrite and self._there(self.target):
            raise FileExistsError(self.target)
        head, _, tail = self.target.rpartition("/")
        self.job = f"{head}/.{tail}-{uuid.uuid4().hex}"

    def _there(self, path: str) -> bool:
        from pyarrow import fs

        return self.system.get_file_info(path).type != fs.FileType.NotFound

    def _put(self, path: str, content: bytes | None, source: str | None = None) -> None:
        draft = f"{self.job}/.drafts/{uuid.uuid4().hex}"
        if source is not None:
            import os

            os.symlink(opened(source)[1], draft)
        else:
            with self.system.open_output_stream(draft) as f:
                f.write(content)
        try:
            self.system.move(draft, path)
        except OSError:  # a store that does not replace files
            self.system.delete_file(path)
            self.system.move(draft, path)

    def write(self, iterator: Iterator[Row]) -> _Done:
        made, n, at = set(), 0, self.names
        self.system.create_dir(f"{self.job}/.drafts", recursive=True)
        for row in iterator:
            folder = f"{self.job}/{row[at['speaker']]}"
            if folder not in made:
                self.system.create_dir(folder, recursive=True)
                made.add(folder)
            wav = row[at["wav"]] if "wav" in at else None
            if wav is not None:
                self._put(f"{folder}/{row[at['stem']]}.wav", bytes(wav))
            elif self.link:
                self._put(f"{folder}/{row[at['stem']]}.wav", None, row[at["audio_path"]])
            else:
                system, inner = opened(row[at["audio_path"]])
                with system.open_input_stream(inner) as f:
                    self._put(f"{folder}/{row[at['stem']]}.wav", f.read())
            self._put(f"{folder}/{row[at['stem']]}.lab", row[at["lab"]].encode())
            n += 1
        return _Done(n)

    def commit(self, messages: list) -> None:
        self.system.create_dir(self.job, recursive=True)
        if self._there(f"{self.job}/.drafts"):
            self.system.delete_dir(f"{self.job}/.drafts")
        if self._there(self.target):
            old = f"{self.job}-old"
            self.system.move(self.target, old)
            self.system.move(self.job, self.target)
            self.system.delete_dir(old)
        else:
            self.system.move(self.job, self.target)

    def abort(self, messages: list) -> None:
        if self._there(self.job):
            self.system.delete_dir(self.job)


class SpeakerFolders(DataSource):
    """``df.write.format("speaker_folders").mode("overwrite").save(folder)`` for columns speaker, stem, lab, and wav (bytes)
    or audio_path (copied; with option link=true a symbolic link): <folder>/<speaker>/<stem>.wav and .lab."""

    @classmethod
    def name(cls) -> str:
        return "speaker_folders"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _FolderWriter(self.options["path"], schema.names, overwrite, self.options.get("link", "false") == "true")


def register(spark: SparkSession) -> None:
    """Makes the two formats known to a session."""
    ship(spark)
    spark.dataSource.register(WavHeaders)
    spark.dataSource.register(SpeakerFolders)


def write_speaker_folders(df: DataFrame, path: str, order: str, speaker: str = "speaker_id", text: str = "text", link: bool = False) -> None:
    """Pairs of wav and lab files a sanitised speaker, numbered from 1 in eight digits by ``order``; the lab file is the
    stripped text and a line feed. Audio is the column wav (bytes), or samples and sample_rate (written as 16-bit PCM), or
    the file at audio_path."""
    from ..operators.relational import speaker_sequence

    register(df.sparkSession)
    sound = []
    if "wav" in df.columns:
        sound = [F.col("wav")]
    elif "samples" in df.columns:
        sound = [encode_wav(F.col("samples"), F.col("sample_rate")).alias("wav")]
    light = df.select(F.col(order).alias("__order"), T.identifier(F.col(speaker)).alias("speaker"), F.concat(T.strip(F.coalesce(F.col(text), F.lit(""))), F.lit("\n")).alias("lab"), *(sound or [F.col("audio_path")]))
    numbered = speaker_sequence(light, F.col("speaker"), "__order", "stem")
    numbered.drop("__order").write.format("speaker_folders").mode("overwrite").option("link", str(link).lower()).save(path)

