"""What the operators of this subpackage share: word patterns, let-bindings and tables cut from their lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """Evaluates value once per row and hands it to body as a lambda variable (Catalyst may not inline it again)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def unused(df: DataFrame, base: str) -> str:
    """A column name that df does not have."""
    taken, name = {c.lower() for c in df.columns}, f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on seed and key alone: the first 52 bits of an md5."""
    head = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(2**52))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a temporary one is set in local mode, where
    driver and executors are one; elsewhere that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def few(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """df in no more tasks than its rows need (but one a core): what iterates over small tables would otherwise
    start a task for every shuffle partition in each step."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


def trim() -> None:
    """Gives a Python worker's free memory back to the machine: the worker stays for later tasks, its arrays need not."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_shipped: set[str] = set()
#: Bytes of a batch that goes to a Python worker: ten thousand long rows would not fit.
BATCH_BYTES = 6 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, for the operators that run Python there, and bounds
    the bytes of the batches that they get, unless the session has set them."""
    sc = spark.sparkContext
    if not spark._jsparkSession.sessionState().conf().contains(_BATCH_KEY):
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)


_written: list[tuple[SparkSession, str]] = []


def discard(spark: SparkSession, path: str) -> None:
    """Removes what was written there and is read no more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _drop_written() -> None:
    for spark, path in _written:
        try:
            discard(spark, path)
        except Exception:  # the session has ended: its folder goes with it
            return


atexit.register(_drop_written)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: a cut in the lineage that survives lost executors."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partitions) if partitions else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
