"""The registry of checkpoints and the lock of those who train, for writers that do not know of each other."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as R
from ..schema import REGISTRY
from .commits import CommitLog

_ENTRY = [x.split()[0] for x in REGISTRY.split(", ")]
_NOBODY = {"owner": None, "acquired": 0.0, "expires": 0.0}


def append(spark: SparkSession, path: str, entries: Sequence[dict]) -> int:
    """Adds checkpoints after all that are there, none lost or overwritten, and returns their version."""
    log = CommitLog(spark, path)
    rows = [{k: e.get(k) for k in _ENTRY} for e in entries]
    if not rows or any(r["step"] is None for r in rows):
        raise ValueError("an entry has a step")
    log.update(lambda last: {"entries": rows})
    return log.latest()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All checkpoints with their defaults and pos, the order in which they were added; a missing registry is empty."""
    rows = CommitLog(spark, path).table(f"entries array<struct<{', '.join(x.replace(' ', ': ', 1) for x in REGISTRY.split(', '))}>>")
    flat = rows.select("version", F.posexplode("entries").alias("i", "e")).select("e.*", F.struct("version", "i").alias("pos"))
    return flat.withColumns({"trainer_id": F.coalesce("trainer_id", F.lit("unknown")), "shard_index": F.coalesce("shard_index", F.lit(0)), "created": F.coalesce("created", F.lit(0.0))})


def pull(spark: SparkSession, path: str, strategy: str = "latest") -> DataFrame:
    """The checkpoint to go on from; no row if there is none."""
    return R.pull(read(spark, path), strategy)


def publish(spark: SparkSession, path: str, step: int, val_loss: float | None, trainer_id: str, shard_index: int = 0, now: float | None = None) -> dict:
    """Records a checkpoint under the folder name that its step and trainer give."""
    entry = {"step": int(step), "val_loss": val_loss, "trainer_id": trainer_id, "shard_index": int(shard_index), "path": f"checkpoints/step_{int(step):07d}_{trainer_id}", "created": time.time() if now is None else now}
    append(spark, path, [entry])
    return entry


def acquire(spark: SparkSession, path: str, owner: str, ttl: float = 3600.0, now: float | None = None) -> tuple[bool, dict]:
    """Takes the lock unless another owner holds it and has time left; of two who try at once one gets it. Returns whether
    it was granted, and the lock."""
    held: dict = {}

    def take(last: dict | None) -> dict | None:
        at = time.time() if now is None else now
        if last and last["owner"] not in (None, owner) and last["expires"] > at:
            held.update(last)
            return None
        return {"owner": owner, "acquired": at, "expires": at + ttl}

    lock = CommitLog(spark, path).update(take)
    return (True, lock) if lock else (False, held)


def release(spark: SparkSession, path: str, owner: str) -> bool:
    """Gives the lock back; only its owner can."""
    return CommitLog(spark, path).update(lambda last: _NOBODY if last and last["owner"] == owner else None) is not None
