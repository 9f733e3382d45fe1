"""The folder that driver and executors share, tables written there to cut lineage, and the package for executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; without one only a local session may use a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="shared-")


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as Hadoop has it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


_written: list[tuple[SparkSession, str]] = []


def _drop_written() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session has ended: its folder goes with it
            return


atexit.register(_drop_written)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: a cut in the lineage that survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, by: Sequence[str], row: str = "__row", part: str = "__part") -> DataFrame:
    """df sorted by range partitions and written: ``row`` grows in that order over the whole table, ``part`` is the range
    partition. No partition depends on how often a leading column's value occurs, as the others cut it too."""
    out = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(row, F.monotonically_increasing_id())
    return materialize(out, "ranged").withColumn(part, F.shiftright(row, 33).cast("int"))


_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession):
    """Lists many small folders with a few tasks a core, where Spark starts a task a folder."""
    before = spark.conf.get(_LISTING_KEY)
    spark.conf.set(_LISTING_KEY, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_KEY, before)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, for what runs Python there."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)


#: Bytes and rows of a batch that goes to a Python worker: ten thousand long texts would not fit.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": 6 << 20, "spark.sql.execution.arrow.maxRecordsPerBatch": 1000}


def python() -> None:
    """Makes the active session ready for Python on executors: the package is sent, and the bytes and rows of the batches are
    bounded unless the session has set them."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    ship(spark)
    for key, most in BATCHES.items():
        if not spark._jsparkSession.sessionState().conf().contains(key):
            spark.conf.set(key, str(most))
