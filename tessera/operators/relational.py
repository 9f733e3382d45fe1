"""Dedup, splits, sequences, shards, registry, locks and plans over manifests. Every order-dependent operator takes its order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import bucket, md5
from ..functions.rx import strip
from . import cuts


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows with one key the first by ``order``. Ties in the order are broken by nothing: give a total one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def acceptance(df: DataFrame, keys: Sequence[str], order: str, ok: Column) -> DataFrame:
    """df with status: a row is 'duplicate' only if an earlier row of its key was accepted; else accepted or rejected."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.when(ok, 1).otherwise(0)).over(before), F.lit(0)) > 0
    return df.withColumn("status", F.when(taken, "duplicate").when(ok, "accepted").otherwise("rejected"))


def exact_split(df: DataFrame, key: str, seed: int = 42, valid: float = 0.02, test: float = 0.02) -> DataFrame:
    """df with split: exact sizes int(n * fraction), in the order of md5(seed|key).

    Ranks come from counts, so no task holds all rows: a prefix sum over the hash's first four digits (65,536 groups) plus
    a rank within the group.
    """
    hashed = df.withColumn("__h", md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).withColumn("__b", F.substring("__h", 1, 4))
    counts = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__c"))
    n = counts.agg(F.sum("__c")).first()[0] or 0
    n_valid, n_test = int(n * valid), int(n * test)
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    rank = F.col("__before") + F.row_number().over(Window.partitionBy("__b").orderBy("__h", key))
    return hashed.join(starts, "__b").withColumn("split", F.when(rank <= n_valid, "valid").when(rank <= n_valid + n_test, "test").otherwise("train")).drop("__h", "__b", "__before")


def rounds(df: DataFrame, key: str, totals: Sequence[int], seed: int = 42) -> DataFrame:
    """Rows of cumulative samples of the given sizes, with round, from 1, of the first sample that holds them: sample k is the
    rows of rounds up to k. Samples are the first rows in the order of md5(seed|key), so another size changes no smaller one.

    One pass counts the hashes' first four digits; only rows up to the digits that hold the largest sample are numbered.
    """
    if list(totals) != sorted(set(totals)) or not totals or totals[0] < 1:
        raise ValueError("sizes grow")
    hashed = df.withColumn("__h", md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).withColumn("__b", F.substring("__h", 1, 4))
    counts = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__c"))
    upto = counts.withColumn("__sum", F.sum("__c").over(Window.orderBy("__b"))).where(F.col("__sum") >= totals[-1]).agg(F.min("__b")).first()[0]
    few = hashed.where(F.col("__b") <= upto) if upto else hashed
    rank = cuts.sequence(few, ["__h", key], name="__rank").where(F.col("__rank") <= totals[-1])
    first = F.lit(len(totals))
    for i, n in reversed(list(enumerate(totals[:-1]))):
        first = F.when(F.col("__rank") <= n, i + 1).otherwise(first)
    return rank.withColumn("round", first).drop("__h", "__b", "__rank")


def speaker_sequence(df: DataFrame, speaker: Column, order: str, path: str = "seq") -> DataFrame:
    """df with speaker and its rows' 8-digit numbers from 1; a speaker's rows are spread over range partitions."""
    return cuts.sequence(df.withColumn("speaker", speaker), [order], ["speaker"], path).withColumn(path, F.format_string("%08d", path))


def gapped_sequence(df: DataFrame, order: str, keep: Column, groups: Sequence[str] = ()) -> DataFrame:
    """Numbers given before the filter, so that skipped rows leave gaps; within groups if given."""
    return cuts.gapped(df, [order], keep, groups)


def balanced_shards(df: DataFrame, key: str, n: int) -> DataFrame:
    """key and shard: distinct keys in the order of their md5, dealt round; sizes differ by one at most."""
    keys = df.select(key).distinct().withColumn("__h", md5(F.col(key)))
    return cuts.sequence(keys, ["__h", key], name="shard").select(key, ((F.col("shard") - 1) % n).cast("int").alias("shard"))


def shard_rows(df: DataFrame, key: str, shards: DataFrame, n: int, index: int) -> DataFrame:
    """Rows of one shard; keys that the map lacks go to their hash bucket. Raises if a known map leaves the shard empty."""
    if not shards.isEmpty() and shards.where(F.col("shard") == index).isEmpty():
        raise ValueError(f"shard {index} of {n} has no keys")
    return df.join(shards, key, "left").withColumn("shard", F.coalesce("shard", bucket(F.col(key), n).cast("int"))).where(F.col("shard") == index)


def todo(all_: DataFrame, done: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    return all_.join(done.select(*on), list(on), "left_anti").orderBy(*order)


def best(registry: DataFrame, position: str = "pos") -> DataFrame:
    """The lowest loss, then the latest step, then the first row; without losses the latest step."""
    return registry.orderBy(F.col("val_loss").asc_nulls_last(), F.col("step").desc(), position).limit(1)


def latest(registry: DataFrame, position: str = "pos") -> DataFrame:
    return registry.orderBy(F.col("step").desc(), position).limit(1)


def pull(registry: DataFrame, strategy: str = "latest", position: str = "pos") -> DataFrame:
    if strategy not in ("latest", "best"):
        raise ValueError(f"no such strategy: {strategy}")
    return (best if strategy == "best" else latest)(registry, position)


def min_named(df: DataFrame, *parts: str) -> DataFrame:
    """The least number in the first column whose name holds all parts; blanks and words do not count."""
    column = next((c for c in df.columns if all(p in c.lower() for p in parts)), None)
    value = F.expr(f"try_cast(`{column}` AS DOUBLE)") if column else F.lit(None).cast("double")
    return df.agg(F.min(F.when(~F.isnan(value), value)).alias("value"))


def acquire(lock: DataFrame, owner: str, now: Column, ttl: float = 3600.0) -> DataFrame:
    """The lock's rows after an attempt, with granted: refused only while another owner's has not expired."""
    free = F.col("owner").isNull() | (F.col("owner") == owner) | (F.col("expires") <= now)
    return lock.select(
        *(c for c in lock.columns if c not in ("owner", "acquired", "expires")), free.alias("granted"), F.when(free, owner).otherwise(F.col("owner")).alias("owner"),
        F.when(free, now).otherwise(F.col("acquired")).alias("acquired"), F.when(free, now + ttl).otherwise(F.col("expires")).alias("expires"),
    )


def release(lock: DataFrame, owner: str) -> DataFrame:
    return lock.where(~F.col("owner").eqNullSafe(owner))


def shard_meta(df: DataFrame, groups: Sequence[str], seconds: str, size: str, source: str) -> DataFrame:
    """Per shard: clips, hours, bytes, bytes a second (null without seconds) and source files in order."""
    s = F.sum(seconds)
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("clips"), F.round(s / 3600, 4).alias("hours"), F.sum(size).alias("proto_bytes"),
        F.when(s > 0, F.round(F.sum(size) / s, 1)).alias("bytes_per_second"), F.array_join(F.array_sort(F.collect_set(source)), ",").alias("source_files"),
    )


def progress(base: DataFrame, session: DataFrame) -> DataFrame:
    """Totals of what was there and what came."""
    return base.unionByName(session).agg(*(F.sum(c).alias(c) for c in base.columns))


def throughput(audio_s: Column, wall_s: Column, remaining_s: Column) -> Column:
    rate = audio_s / F.nullif(wall_s, F.lit(0.0))
    return F.struct(F.round(rate, 4).alias("rate"), F.round(remaining_s / F.nullif(rate, F.lit(0.0)), 1).alias("eta_s"))


def pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Both sides' keys with has_left and has_right: orphans of either side show."""
    a, b = left.select(*on).distinct().withColumn("l", F.lit(True)), right.select(*on).distinct().withColumn("r", F.lit(True))
    return a.join(b, list(on), "full_outer").select(*on, F.coalesce("l", F.lit(False)).alias("has_left"), F.coalesce("r", F.lit(False)).alias("has_right"))


def references(speakers: DataFrame, audio: DataFrame, txt: DataFrame, lab: DataFrame, key: str) -> DataFrame:
    """Speakers that have reference audio, with their reference text: that of ``txt`` if there is such a file, else of
    ``lab``, stripped; null if it is blank. A speaker's files of a kind count as one, with the least text."""
    of = lambda df, c: df.groupBy(key).agg(F.min(strip(F.col(c))).alias(c), F.lit(True).alias(f"__{c}"))
    there = speakers.join(audio.select(key).distinct(), key, "left_semi")
    found = there.join(of(txt, "txt"), key, "left").join(of(lab, "lab"), key, "left")
    return found.select(key, F.nullif(F.when(F.col("__txt"), F.col("txt")).otherwise(F.col("lab")), F.lit("")).alias("reference"))


def mapped(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """df joined with its names' table; a value that the table lacks is an error when its row is read."""
    found = df.join(names.withColumn("__there", F.lit(True)), key, "left")
    unknown = F.raise_error(F.concat(F.lit(f"no name for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    first = next(c for c in names.columns if c != key)
    return found.withColumn(first, F.when(F.col("__there"), F.col(first)).otherwise(unknown.cast(names.schema[first].dataType))).drop("__there")


def grand_totals(shards: DataFrame, sums: Sequence[str]) -> DataFrame:
    """One row: the number of shards and the totals over them."""
    return shards.agg(F.count(F.lit(1)).alias("shards"), *(F.sum(c).alias(c) for c in sums))


def any_of(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: for each condition whether any row meets it (false for an empty table)."""
    return df.agg(*(F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in conditions.items()))
