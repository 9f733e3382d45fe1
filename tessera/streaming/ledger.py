"""The shard build over files that keep coming, with an outcome for every file and one commit record a chunk.

Files that have no good outcome yet are listed, ordered, and cut to chunks by their bytes. A chunk's rows are judged and
staged; the first accepted row of a key stays, over all chunks and runs; files go to shards by their accepted clips. Then one
record of the commit log makes the rows, the keys, the counts and the outcomes of the files visible together. What a lost
run has staged is named by no record, so nobody sees it, and its files are taken again.

A file that cannot be read or judged is found by halving its chunk, gets the outcome ``failed`` with the error, and is
listed again by the next run, until it is mended. A chunk that another builder's commit overtakes is staged in vain: the
run ends with Conflict, and can be started again.

The driver holds the files of one chunk. Keys are read in each chunk, 16 bytes each. A run over no new files adds nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cuts
from ..sources.commits import CommitLog
from ..sources.shared import listing, materialize, remove

_RECORD = (
    "attempt string, files array<struct<path: string, outcome: string, error: string, bytes: bigint, clips: bigint, seconds: double, shard: int>>, "
    "shards array<struct<shard: int, bytes: bigint>>, clips bigint, seconds double, rejected bigint, duplicates bigint, "
    "total struct<clips: bigint, seconds: double, rejected: bigint, duplicates: bigint, shards: bigint>, created double"
)
#: Bytes of a shard's files that one task writes.
PART_BYTES = 128 << 20
_NOTHING = {"clips": 0, "seconds": 0.0, "rejected": 0, "duplicates": 0, "shards": 0}


class Build:
    """``judge`` gives the rows of the source the columns ``ok`` and ``seconds`` (others as it likes); a row that is not ok
    is rejected, and does not shadow a later good one of its key."""

    def __init__(
        self, spark: SparkSession, source: str, schema: str, out: str, keys: Sequence[str], judge: Callable[[DataFrame], DataFrame], shard_clips: int = 20_000, chunk_bytes: int = 15 << 30,
        name: str = "*.parquet", arrange: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.spark, self.source, self.schema, self.out, self.keys, self.judge = spark, source, schema, out.rstrip("/"), list(keys), judge
        self.shard_clips, self.chunk_bytes, self.name, self.arrange = shard_clips, chunk_bytes, name, arrange
        self.log = CommitLog(spark, f"{self.out}/commits")

    # What is there.

    def records(self) -> DataFrame:
        return self.log.table(_RECORD)

    def outcomes(self) -> DataFrame:
        """Of every file the last outcome: path, outcome, error, clips, seconds, shard, version."""
        flat = self.records().select("version", F.explode("files").alias("f")).select("version", "f.*")
        last = flat.groupBy("path").agg(F.max_by(F.struct(*flat.columns), "version").alias("r"))
        return last.select("r.*")

    def todo(self) -> DataFrame:
        """Files without a good outcome, with their bytes and place (from 1), by ``arrange``'s columns, then path."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", self.name).option("recursiveFileLookup", True).load(self.source)  # names and lengths only
        files = listed.select(_plain(F.col("path")).alias("path"), F.col("length").alias("bytes"))
        files = files.join(self.outcomes().where("outcome = 'ok'").select("path"), "path", "left_anti")
        files = self.arrange(files) if self.arrange else files
        return cuts.sequence(files, [*(c for c in files.columns if c not in ("path", "bytes")), "path"], name="place").select("place", "path", "bytes")

    def progress(self) -> dict:
        """Totals over all commits."""
        last = self.log.read(self.log.latest())
        return last["total"] if last else dict(_NOTHING)

    def _committed(self, what: str) -> list[str]:
        return [f"{self.out}/{what}/attempt={r.attempt}" for r in self.records().where("clips > 0").select("attempt").collect()]

    def rows(self) -> DataFrame:
        """The accepted rows of all commits with their shard."""
        paths = self._committed("data")
        if not paths:
            empty = self.judge(self._read([]))
            return empty.select(*(c for c in empty.columns if c not in ("ok", "__file", "__row")), F.lit(0).alias("shard"))
        with listing(self.spark):
            return self.spark.read.option("basePath", f"{self.out}/data").parquet(*paths).drop("attempt")

    def known(self) -> DataFrame:
        paths = self._committed("keys")
        return self.spark.read.schema("key binary").parquet(*paths) if paths else self.spark.createDataFrame([], "key binary")

    def meta(self) -> DataFrame:
        """A row a shard: clips, hours, bytes, source files."""
        files = self.records().select(F.explode("files").alias("f")).select("f.*").where("clips > 0")
        sizes = self.records().select(F.explode("shards").alias("s")).select("s.*").groupBy("shard").agg(F.sum("bytes").alias("bytes"))
        out = files.groupBy("shard").agg(F.sum("clips").alias("clips"), F.round(F.sum("seconds") / 3600, 4).alias("hours"), F.sort_array(F.collect_set("path")).alias("source_files"))
        return out.join(sizes, "shard", "left")

    # A run.

    def run(self, max_chunks: int = 0, max_hours: float = 0.0, pilot: int = 0) -> dict:
        """Works on what is to do and returns the run's counts. It stops cleanly after ``max_chunks`` chunks, after the chunk
        in which ``max_hours`` of time were over, or with ``pilot``, which publishes nothing and starts from
        the first file, after as many accepted clips. A later run goes on where it stopped."""
        with listing(self.spark):
            return self._run(max_chunks, max_hours, pilot)

    def _run(self, max_chunks: int, max_hours: float, pilot: int) -> dict:
        began, stats, chunk = time.time(), dict(_NOTHING) | {"chunks": 0, "failed": 0}, 0
        base = dict(_NOTHING) if pilot else self.progress()
        # What was pending at the end of the last run was published then: a new shard begins.
        state = (self.shard_clips, base["shards"])
        todo = materialize(self.todo(), "todo")
        plan = cuts.greedy_chunks(todo, "place", "bytes", self.chunk_bytes).select("place", "chunk").join(todo, "place")
        plan = materialize(plan, "plan")
        while True:
            chunk += 1
            files = plan.where(F.col("chunk") == chunk).orderBy("place").collect()
            if not files or max_chunks and chunk > max_chunks:
                return stats
            state = self._chunk(files, state, stats, base, bool(pilot))
            stats["chunks"] = chunk
            if max_hours and time.time() - began > max_hours * 3600 or pilot and stats["clips"] >= pilot:
                return stats

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumns({"__file": F.lit(""), "__row": F.lit(0).cast("long")})
        rows = self.spark.read.schema(self.schema).parquet(*files)
        return rows.select("*", _plain(F.col("_metadata.file_path")).alias("__file"), F.col("_metadata.row_index").alias("__row"))

    def _sizes(self, data: str) -> list[dict]:
        """The shards of a chunk with the bytes of their files, from one listing."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(data)  # names and lengths only
        sizes = listed.groupBy(F.regexp_extract("path", r"/shard=([0-9]+)/[^/]*$", 1).cast("int").alias("shard")).agg(F.sum("length").alias("bytes"))
        return [r.asDict() for r in sizes.where("shard is not null").orderBy("shard").collect()]

    def _stage(self, files: list[str], to: str) -> tuple[list[str], list[tuple[str, str]]]:
        """Judged rows of the files that can be read, in folders below ``to``; and the others with their errors."""
        path = f"{to}/{uuid.uuid4().hex}"
        try:
            judged = self.judge(self._read(files))
            key = F.unhex(F.md5(F.to_json(F.struct(*self.keys)).cast("binary")))
            judged.withColumns({"ok": F.coalesce("ok", F.lit(False)), "__key": key}).write.parquet(path)
            return [path], []
        except Exception as e:
            remove(self.spark, path)
            if len(files) == 1:
                return [], [(files[0], f"{type(e).__name__}: {e}"[:500])]
        half = len(files) // 2
        (a, x), (b, y) = self._stage(files[:half], to), self._stage(files[half:], to)
        return a + b, x + y

    def _chunk(self, files: list, state: tuple[int, int], stats: dict, base: dict, pilot: bool) -> tuple[int, int]:
        attempt = uuid.uuid4().hex
        stage = f"{self.out}/_staged/{attempt}"
        version = self.log.latest()
        try:
            staged, failed = self._stage([f.path for f in files], stage)
            broken = dict(failed)
            order = {f.path: i for i, f in enumerate(files)}
            clips, seconds, counts, shards = np.zeros(len(files), np.int64), np.zeros(len(files)), {"rejected": 0, "duplicates": 0}, []
            after = state
            if staged:
                spark = self.spark
                rows = spark.read.parquet(*staged)
                places = F.broadcast(spark.createDataFrame(list(order.items()), "__file string, __place int"))  # the chunk's files
                rows = rows.join(places, "__file").withColumn("__at", F.struct("__place", "__row"))
                known = spark.createDataFrame([], "key binary") if pilot else self.known()
                keys = rows.groupBy("__key").agg(F.min(F.when(F.col("ok"), F.struct(F.col("__at").alias("at"), F.col("seconds").alias("s")))).alias("first"))
                keys = keys.join(known.select(F.col("key").alias("__key"), F.lit(True).alias("__old")), "__key", "left")
                kept = keys.where("first is not null and __old is null")
                for r in kept.groupBy("first.at.__place").agg(F.count(F.lit(1)).alias("n"), F.sum("first.s").alias("s")).collect():
                    clips[r["__place"]], seconds[r["__place"]] = r["n"], r["s"] or 0.0
                good = np.array([f.path not in broken for f in files])
                numbers = np.zeros(len(files), np.int64)
                numbers[good] = cuts.numbered(clips[good], np.array([0]), [state], self.shard_clips)
                after = cuts.steps(clips[good], self.shard_clips).after(self.shard_clips, state)
                status = F.when(F.col("__old") | (F.col("__at") > F.col("first.at")), "duplicate").when(F.col("ok"), "kept").otherwise("rejected")
                judged = rows.join(keys, "__key").withColumn("__status", status)
                seen = Observation()
                judged = judged.observe(seen, *(F.count_if(F.col("__status") == s).alias(n) for n, s in (("rejected", "rejected"), ("duplicates", "duplicate"))))
                # A shard's rows go to one task for each PART_BYTES of its files: else each task would write to all shards.
                weight = np.bincount(numbers, weights=[f.bytes for f in files])
                pieces = np.maximum(1, np.ceil(weight / PART_BYTES)).astype(np.int64)[numbers]
                of = F.broadcast(spark.createDataFrame([(i, int(n), int(p)) for i, (n, p) in enumerate(zip(numbers, pieces, strict=True))], "__place int, shard int, __pieces int"))
                final = judged.where("__status = 'kept'").join(of, "__place")
                inner = ["__file", "__row", "__place", "__at", "__old", "__status", "__pieces", "first", "ok"]
                if pilot:
                    final.write.format("noop").mode("overwrite").save()
                else:
                    data, own = f"{self.out}/data/attempt={attempt}", f"{self.out}/keys/attempt={attempt}"
                    final.repartition("shard", F.pmod("__row", "__pieces")).drop(*inner, "__key").write.partitionBy("shard").parquet(data)
                    kept.select(F.col("__key").alias("key")).write.parquet(own)
                    shards = self._sizes(data)
                counts = {k: int(v) for k, v in seen.get.items()}
            else:
                numbers = np.zeros(len(files), np.int64)
            counts |= {"clips": int(clips.sum()), "seconds": float(seconds.sum())}
            for k, v in counts.items():
                stats[k] += v
            stats["failed"] += len(broken)
            stats["shards"] = after[1]
            if not pilot:
                total = {k: base[k] + stats[k] for k in counts} | {"shards": after[1]}
                outcome = [
                    {"path": f.path, "outcome": "failed" if f.path in broken else "ok", "error": broken.get(f.path), "bytes": f.bytes, "clips": int(clips[i]), "seconds": float(seconds[i]), "shard": int(numbers[i])}
                    for i, f in enumerate(files)
                ]
                self.log.create(version + 1, {"attempt": attempt, "files": outcome, "shards": shards, "total": total, "created": time.time()} | counts)
            return after
        finally:
            remove(self.spark, stage)


def _plain(path):
    """A local file's path without its scheme, which Spark writes in two ways; others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")
