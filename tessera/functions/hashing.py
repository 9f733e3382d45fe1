"""Hashes that agree between engines: all are md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5(key: Column) -> Column:
    return F.md5(key.cast("string").cast("binary"))


def bucket(key: Column, n: int) -> Column:
    """The 128-bit md5 of key modulo n, folded over four 32-bit parts."""
    if n <= 1:
        return F.lit(0).cast("long")
    part = lambda i: F.conv(F.substr(md5(key), i * 8 + 1, F.lit(8)), 16, 10).cast("long")
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(3)), part), F.lit(0).cast("long"), lambda a, x: (a * F.lit(4294967296) + x) % n)


def cache_key(dataset: Column, split: Column, n: Column, shards: Column, index: Column, revision: Column) -> Column:
    said = F.concat_ws("|", dataset, split, F.concat(F.lit("n="), n), F.concat(F.lit("shards="), shards), F.concat(F.lit("idx="), index), F.concat(F.lit("rev="), revision))
    return F.substring(md5(said), 1, 16)
