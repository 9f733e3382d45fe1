"""License scans (native expressions only): MinHash bands over text windows, then exact containment.

Texts and templates become 5-word shingles of lower-case words without punctuation. For a template of n
words, windows of 2n words start every n words, so that any occurrence of n words lies whole in a window. A window
that holds a share c of the template's n - 4 shingles has a Jaccard similarity of c * (n - 4) / (2n - 4 + (1 - c) * (n - 4))
with it at least: little over 1/3 for long templates, 1/6 for five words. With bands of one MinHash value each, such
a window misses all with chance (1 - Jaccard) ** bands; each template takes as many bands as keep this under MISS for
the c that is asked for. Where the template has so few shingles that this takes more bands than it has
shingles, its shingles themselves are the bands: a window that holds any of them is a candidate, and none is missed.
A window and a template of a shared band are candidates; exact containment of the template's shingles, at least
CONTAINMENT, verifies them.

A shared MinHash value is a shared shingle, so windows are only made of texts that hold a template's shingle at all:
this test loses nothing and spares nearly all texts the windows. The template table is fixed and small (its
shingles are a literal, its bands are broadcast); documents are never joined with each other.

Defined cases: null texts and texts of under five words match nothing; templates of under five words have no shingle and
match nothing, a set of no others finds nothing; rows with a null id count as one document; other columns are not read; a
text of any length is scanned whole; a template found in many windows
of a document gives one row, with the best window; repeated rows are scanned each, and reported once a doc_id;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, words

SHINGLE = 5
MISS = 1e-4
CONTAINMENT = 0.75

# The usual notices of public licences.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def normalized(text: Column) -> Column:
    return words(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")))


def shingles(w: Column) -> Column:
    """The hashes of an array's 5-word shingles in their order."""
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return let(
        hashed,
        lambda h: F.when(F.size(h) < SHINGLE, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice(h, 1, F.size(h) - SHINGLE + 1), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, SHINGLE))))
        ),
    )


def n_bands(size: int, of: int, containment: float) -> int:
    """The bands that a template of size words and of distinct shingles takes; 0: its shingles are the bands."""
    held = max(1, math.ceil(containment * of - 1e-9))
    jaccard = held / (2 * size - SHINGLE + 1 + of - held)
    n = math.ceil(math.log(MISS) / math.log1p(-jaccard))
    return 0 if n >= of else n


def bands(s: Column, n: int, of: list[int]) -> Column:
    """The n bands of the shingles s or, for 0, those shingles that are in of."""
    if not n:
        return F.transform(F.array_intersect(s, F.array(*(F.lit(x).cast("long") for x in of))), lambda x: F.struct(F.lit(-1).alias("band"), x.alias("low")))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.struct(b.alias("band"), F.array_min(F.transform(s, lambda x: F.xxhash64(x, b))).alias("low")))


def templates(spark: SparkSession, texts: dict[str, str] = TEMPLATES) -> DataFrame:
    """license, size (words) and its shingles."""
    rows = spark.createDataFrame(list(texts.items()), "license string, t string")
    w = normalized(F.col("t"))
    return rows.select("license", F.size(w).alias("size"), F.array_distinct(shingles(w)).alias("of"))


def scan(docs: DataFrame, texts: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """Per document and license found: doc_id, license, containment of the template in the best window, n_windows."""
    known = templates(docs.sparkSession, texts)
    fixed = [r for r in known.collect() if r["of"]]  # the templates given, some dozens of rows
    if not fixed:
        none = docs.select(F.col(doc_id), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("n_windows"))
        return none.where("false")
    literal = F.array(*(F.lit(x).cast("long") for x in sorted({x for r in fixed for x in r["of"]})))
    sizes = sorted({r["size"] for r in fixed})
    held = docs.select(F.col(doc_id).alias("__id"), shingles(normalized(F.col(text))).alias("__s")).where(F.arrays_overlap("__s", literal))
    # Windows of 2n words hold 2n - 4 shingles; a text with fewer is one window.
    starts = lambda n: F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("__s") - 1), F.lit(n))
    of_size = lambda n: F.transform(starts(n), lambda a: F.struct(F.lit(n).alias("size"), F.array_distinct(F.slice("__s", a + 1, F.lit(2 * n - SHINGLE + 1))).alias("in")))
    windows = held.select("__id", F.explode(F.flatten(F.array(*map(of_size, sizes)))).alias("w")).where(F.arrays_overlap("w.in", literal))
    ways = {}  # by size: the bands, and the shingles of its templates
    for n in sizes:
        of = [r["of"] for r in fixed if r["size"] == n]
        needed = [n_bands(n, len(x), containment) for x in of]
        ways[n] = (0 if 0 in needed else max(needed), sorted({x for y in of for x in y}))
    keys = lambda size, s: F.explode(F.coalesce(*(F.when(size == n, bands(s, *way)) for n, way in ways.items())))
    banded = windows.select("__id", "w.size", "w.in", keys(F.col("w.size"), F.col("w.in")).alias("b")).select("__id", "size", "in", "b.band", "b.low")
    signed = known.select("license", "size", "of", keys(F.col("size"), F.col("of")).alias("b")).select("license", "size", "of", "b.band", "b.low")
    found = banded.join(F.broadcast(signed), ["size", "band", "low"])
    share = F.size(F.array_intersect("in", "of")) / F.size("of")
    best = found.select("__id", "license", share.alias("c"), F.xxhash64("in").alias("w")).where(F.col("c") >= containment).distinct()
    return best.groupBy("__id", "license").agg(F.max("c").alias("containment"), F.count(F.lit(1)).alias("n_windows")).withColumnRenamed("__id", doc_id)
