"""Grades, filters, validation and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rx import strip
from ..functions.signal import metrics, speech_ratio
from ..schema import REQUIRED, Limits

GRADES = ("A", "B", "C", "D")


def grade(duration: Column, text: Column, clipping: Column, rate: Column, silence: Column, rms: Column, limits: Limits = Limits()) -> Column:
    """A to D from rounded metrics; the first case that holds."""
    bad = (
        (duration < limits.shortest) | (duration > limits.longest) | text.isNull() | (F.length(strip(text)) < 2) | (clipping > limits.clipping) | (rate < limits.rate) | (silence > limits.silence)
    )
    best = (rate >= limits.a_rate) & (clipping == 0) & (silence < limits.a_silence) & rms.between(*limits.a_rms)
    return F.when(F.coalesce(bad, F.lit(True)), "D").when(best, "A").when((silence < limits.b_silence) & (rms > limits.b_rms), "B").otherwise("C")


def measured(df: DataFrame, samples: str, rate: Column, frame: Column | None = None) -> DataFrame:
    """df with the metrics of its samples as columns."""
    return df.withColumn("m", metrics(F.col(samples), rate, frame)).select("*", "m.*").drop("m")


def grade_rank(g: Column) -> Column:
    """0 for A to 3 for D; anything else is D."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, GRADES)), g).cast("int") - 1, F.lit(3))


def at_least(df: DataFrame, lowest: str = "B", column: str = "quality_grade") -> DataFrame:
    return df.where(F.when(grade_rank(F.col(column)) < 0, 3).otherwise(grade_rank(F.col(column))) <= GRADES.index(lowest))


def fused_threshold(df: DataFrame, lowest: str = "B", column: str = "quality_grade") -> DataFrame:
    """The shard builder's: D goes, C too unless it is allowed."""
    return df.where((F.col(column) != "D") & ((F.col(column) != "C") | F.lit(lowest != "B")))


def route(g: Column) -> Column:
    return F.when(g == "A", "passthrough").otherwise("denoise")


def grade_histogram(df: DataFrame, column: str = "quality_grade") -> DataFrame:
    """Rows of every grade, those without clips too: quality_grade, n, pct."""
    spark = df.sparkSession
    domain = spark.createDataFrame([(g,) for g in GRADES], "quality_grade string")
    counts = df.groupBy(F.col(column).alias("quality_grade")).agg(F.count(F.lit(1)).alias("n"))
    full = domain.join(counts, "quality_grade", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    total = full.groupBy().agg(F.sum("n").alias("t"))
    return full.join(F.broadcast(total)).select("quality_grade", "n", F.when(F.col("t") > 0, F.round(F.lit(100.0) * F.col("n") / F.col("t"), 4)).otherwise(0.0).alias("pct"))


def with_audio_and_text(df: DataFrame, audio: str, text: str) -> DataFrame:
    return df.where(F.col(audio).isNotNull() & (strip(F.col(text)) != ""))


def or_default(*columns: Column, default: str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(default))


def by_speech(df: DataFrame, spans: str, length: str, least: float = 0.4) -> DataFrame:
    ratio = speech_ratio(F.col(spans), F.col(length))
    return df.where(F.size(spans) > 0).withColumn("speech_ratio", F.round(ratio, 4)).where(ratio >= least)


def longer_than(df: DataFrame, samples: Column, rate: Column, seconds: float = 0.3) -> DataFrame:
    return df.where(F.size(samples) >= (F.lit(seconds) * rate).cast("int"))


def not_blank(df: DataFrame, text: str) -> DataFrame:
    return df.where(strip(F.col(text)) != "")


def existing(df: DataFrame, files: DataFrame, on: str) -> DataFrame:
    return df.join(files.select(on).distinct(), on, "left_semi")


def guard(df: DataFrame, what: str) -> DataFrame:
    """df; raises if it is empty."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows are left")
    return df


def tier(gb: Column) -> Column:
    """struct of batch, length and accum by memory."""
    of = lambda b, n: F.struct(F.lit(b).alias("batch"), F.lit(n).alias("length"), F.greatest(F.lit(1), F.lit(4 // b)).alias("accum"))
    return F.when(gb < 6, of(1, 512)).when(gb < 12, of(1, 768)).when(gb < 20, of(2, 1024)).otherwise(of(4, 1024))


def request_error(text: Column, normalized: Column, speaker: Column, speakers: list[str]) -> Column:
    """Why a synthesis request is refused; null if it is fine."""
    return (
        F.when(text.isNull() | ~F.length(text).between(1, 2000), "text length").when(speaker.isNull() | ~speaker.isin(speakers), "unknown speaker").when(strip(normalized) == "", "nothing to say")
    )


def validated(df: DataFrame, exists: Column, corrupt: str | None = None) -> DataFrame:
    """df with error: what is wrong first, null if nothing is."""
    missing = F.array_join(F.filter(F.array(*(F.when(F.col(c).isNull(), c) for c in REQUIRED)), lambda x: x.isNotNull()), ",")
    error = F.when(F.col(corrupt).isNotNull(), "invalid json") if corrupt else F.when(F.lit(False), "")
    return df.withColumn(
        "error",
        error.when(missing != "", F.concat(F.lit("missing "), missing)).when(strip(F.col("text")) == "", "empty text").when(~(F.col("duration") > 0), "bad duration").when(~exists, "no file"),
    )


def validation_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("error").isNull()).alias("n_ok"), F.count_if(F.col("error").isNotNull()).alias("n_bad"))


def first_errors(df: DataFrame, position: str, n: int = 20) -> DataFrame:
    return df.where("error is not null").select(position, "error").orderBy(position).limit(n)


def require_valid(df: DataFrame) -> DataFrame:
    """Raises if no row is valid, or any is not."""
    ok, bad = validation_summary(df).first()
    if not ok or bad:
        raise ValueError(f"{ok} valid rows and {bad} others")
    return df


def size_mismatches(local: DataFrame, published: DataFrame, name: str, size: str) -> DataFrame:
    """Published files whose local size differs (missing: -1)."""
    have = local.select(name, F.col(size).alias("have"))
    return published.join(have, name, "left").withColumn("have", F.coalesce("have", F.lit(-1))).where(F.col("have") != F.col(size)).select(name, "have", F.col(size).alias("expected"))


def without_partner(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_anti")
