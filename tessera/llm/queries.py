"""The queries of this subpackage for the driver, with SQL for those that have a SQL form."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, html_text, kd_search, licences, lines, mix, ngram_join, nn_descent, pseudonyms, rules, runs, tokenfiles
from .common import materialize, shared_path, table
from .sql import ABLATION_SQL, LINES_SQL, REPAIR_SQL, RULES_SQL, RUNS_SQL, SEARCH_SQL, mix_sql

VOCABULARY = "byte_bpe_50k.json"
#: Public, as the tables are made up; real texts need a secret one.
PSEUDONYM_KEY = "key of the test tables"


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.apply_policy(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_mask")


def ablation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ablation(rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.search(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "tokens")
    tokenfiles.write(table(spark, sf_dir, "documents"), out, public_tokenizers.path(VOCABULARY))
    return tokenfiles.with_checksums(spark, out)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY)).drop("text")


def op11_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return kd_search.search(rows.select("vec_id", kd_search.scaled(F.col("embedding")).alias("embedding")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    damaged = conversations.damage(rows)
    audits = materialize(conversations.audits(damaged), "audits")
    digests = conversations.repaired_digests(damaged, audits)
    one = audits.select(*conversations.COUNTS, "audit").join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    all_ = rows.select(F.col("conv_id").alias("c")).distinct()
    out = all_.join(one, F.col("c").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zeros = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in conversations.COUNTS[1:]]
    return out.select(F.col("c").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return runs.digests(runs.periodic_runs(docs))


QUERIES = {f.__name__: f for f in (op1_mix, op2_pseudonyms, op3_html_text, op4_rules, op5_nn_descent, op6_token_files, op7_licences, op8_ngram_join, op9_line_dedup, op10_bpe, op11_kd_search, op12_conversation_repair, op13_periodic_runs, ablation_rules)}
ORACLES = {
    "op1_mix": mix_sql(), "op4_rules": RULES_SQL, "op9_line_dedup": LINES_SQL, "op11_kd_search": SEARCH_SQL, "op12_conversation_repair": REPAIR_SQL, "op13_periodic_runs": RUNS_SQL, "ablation_rules": ABLATION_SQL
}
