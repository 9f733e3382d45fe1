"""A log of numbered JSON records in a folder, each created once: the base of the ledger, the registry and the lock.

A record is written under a name of its own and then given its number, which fails if the number is taken: of two writers
that read the same state one succeeds and the other sees Conflict and reads again. On a local or mounted file system that is
a hard link, elsewhere Hadoop's rename, which HDFS refuses where the target exists; a store whose rename replaces files does
not do. Readers see whole records or none.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import hadoop, remove


class Conflict(RuntimeError):
    """The number is taken: somebody else has written since."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.root}/{version:020d}.json"

    def latest(self) -> int:
        """The last number, 0 before the first."""
        fs, root = hadoop(self.spark, self.root)
        if not fs.exists(root):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return max((int(n[:20]) for n in names if n.endswith(".json") and n[:20].isdigit()), default=0)

    def read(self, version: int) -> dict | None:
        """A record; none for number 0."""
        if not version:
            return None
        fs, path = hadoop(self.spark, self._path(version))
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, version: int, record: dict) -> None:
        """Writes a record under a number, if that is free."""
        draft = f"{self.root}/.{uuid.uuid4().hex}"
        fs, path = hadoop(self.spark, draft)
        fs.mkdirs(path.getParent())
        stream = fs.create(path, False)
        stream.write(bytearray(json.dumps(record, ensure_ascii=False).encode()))
        stream.close()
        to = self._path(version)
        try:
            if fs.getUri().getScheme() == "file":
                local = lambda p: unquote(urlparse(p).path) if "://" in p or p.startswith("file:") else p
                try:
                    os.link(local(draft), local(to))
                except FileExistsError:
                    raise Conflict(to) from None
            elif not fs.rename(path, hadoop(self.spark, to)[1]):
                raise Conflict(to)
        finally:
            remove(self.spark, draft)

    def update(self, make: Callable[[dict | None], dict | None], tries: int = 50) -> dict | None:
        """Adds what ``make`` makes of the last record, anew if another writer was faster; nothing if it makes None."""
        for i in range(tries):
            version = self.latest()
            record = make(self.read(version))
            if record is None:
                return None
            try:
                self.create(version + 1, record)
                return record
            except Conflict:
                time.sleep(random.uniform(0, min(1.0, 0.01 * 2**i)))
        raise Conflict(f"{self.root}: others were faster {tries} times")

    def table(self, schema: str) -> DataFrame:
        """All records as rows, with version."""
        if not self.latest():
            return self.spark.createDataFrame([], f"{schema}, version bigint")
        rows = self.spark.read.schema(schema).json(self.root)
        return rows.withColumn("version", F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json", 1).cast("bigint"))
