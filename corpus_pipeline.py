"""The documents' way from raw rows to token digests: quality rules, line dedup, near-duplicate join, mixing, BPE.

Defined cases, of every stage: columns that documents does not have pass through all stages but the last, also under the names
that operators give their own columns; a null text is a document without words, which the rules reject; null sources and
languages are a source and a language of their own; null ids share one draw of the mixing and are a document each
elsewhere; repeated rows are copies, of which the join keeps one; texts of any length are whole; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, lines, mix, ngram_join, rules
from tessera.llm.common import discard, shared_path, table

VOCABULARY = "byte_bpe_50k.json"


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def passing(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *used: str) -> DataFrame:
    """The rows that ``work`` leaves, with docs' columns: those that it does not use have other names meanwhile."""
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c not in (*COLUMNS, *used)}
    out = work(docs.withColumnsRenamed(aside))
    return out.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy of the rule ledger rejects go."""
    return passing(docs, lambda d: rules.apply_policy(d).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source leave the texts; n_chars follows the text."""

    def work(d: DataFrame) -> DataFrame:
        out = lines.drop_boilerplate(d)
        return out.withColumn("n_chars", F.length("text").cast(d.schema["n_chars"].dataType)) if "n_chars" in d.columns else out

    return passing(docs, work)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id."""
    return passing(docs, ngram_join.keep_one)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by their calibrated probability."""
    return passing(docs, lambda d: mix.mix(d).where("sampled"), "topic")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text decoded from them."""
    out = bpe.digests(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path(VOCABULARY))
    return out.drop("text")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mixing", mixing), ("tokens", tokens)]
#: The join of near duplicates and the encoding have no SQL form that finishes on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next; what a stage has read goes
    when its own rows are written."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            discard(spark, read)
        docs, read = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
