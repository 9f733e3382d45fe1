"""Line dedup by site-relative frequency (native expressions only).

A line is boilerplate of a host when more than ``ratio`` of the host's pages contain it (and at least
``min_pages`` do). Lines are compared after trimming ASCII white space; blank lines are never boilerplate.

The lines are counted by (host, hash), a key that no single host or line can make hot after map-side
aggregation. What a host drops is small by construction: the page counts of its lines add up to pages times
mean lines a page, so fewer than (mean lines a page) / ratio lines can exceed the ratio. That list is written and
counted. Up to SMALL hashes it is broadcast and the texts are never shuffled; beyond that it joins the pages as one
array a host, copied to SALTS groups among which each host's pages are dealt, so that a hot host is not one group.

Defined cases: null text stays null and contains no line; null hosts form one host; a line on exactly the ratio stays;
a text whose lines all go becomes the empty string; texts of any length are treated whole; repeated rows count as
pages of their own; an empty table gives an empty result; other columns pass through, but n_lines and n_dropped
replace columns of these names.
Hosts are compared exactly, lines by a 64-bit hash within their host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, unused

RATIO = 0.05
#: Pages that tell a repeated line from a page's own.
MIN_PAGES = 3
#: Hashes of lines that are broadcast at most, about 16 MB.
SMALL = 1 << 20
SALTS = 64
_TRIM = "\t\n\x0b\x0c\r "


def _key(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(_TRIM))
    return F.when(F.length(trimmed) > 0, F.xxhash64(trimmed))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row a host that has boilerplate: __host and __bad, the hashes of its lines."""
    pages = docs.select(F.col(host).alias("__host"), F.split(F.col(text), "\n").alias("__lines"))
    seen = pages.select("__host", F.explode(F.array_distinct(F.transform("__lines", _key))).alias("__h")).where(F.col("__h").isNotNull())
    counts = seen.groupBy("__host", "__h").agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") >= min_pages)
    totals = docs.groupBy(F.col(host).alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    over = counts.join(totals, F.col("__host").eqNullSafe(F.col("__of"))).where(F.col("__c") > F.lit(ratio) * F.col("__n"))
    return over.groupBy("__host").agg(F.collect_set("__h").alias("__bad"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """docs with boilerplate lines removed from text, and n_lines, n_dropped."""
    bad = materialize(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    lines, hosts = bad.agg(F.sum(F.size("__bad")), F.count(F.lit(1))).first()
    own, site, salt, every, kept = (unused(docs, x) for x in ("bad", "host", "salt", "lines", "kept"))
    bad = bad.select(F.col("__host").alias(site), F.col("__bad").alias(own))
    if (lines or 0) + hosts <= SMALL:
        joined = docs.join(F.broadcast(bad), docs[host].eqNullSafe(bad[site]), "left")
    else:
        many = bad.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn(salt, F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
        joined = dealt.join(many, dealt[host].eqNullSafe(many[site]) & (dealt[salt] == many[salt]), "left").drop(salt)
    stays = F.when(F.col(own).isNull(), F.col(every)).otherwise(F.filter(every, lambda x: ~F.coalesce(F.array_contains(F.col(own), _key(x)), F.lit(False))))
    out = joined.withColumn(every, F.split(F.col(text), "\n")).withColumn(kept, stays)
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    return out.withColumns({text: F.when(F.col(own).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")), "n_lines": size(every), "n_dropped": size(every) - size(kept)}).drop(site, own, every, kept)
