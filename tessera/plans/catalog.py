"""Queries over the driver's tables, one or more for each operator, each with SQL for DuckDB where SQL has a form.

The tables hold no audio: embeddings stand for sample arrays (frames of 8, limits scaled), documents and conversations for
transcripts, source and user for speakers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import signal as S
from ..functions import text as T
from ..operators import cuts
from ..operators import quality as Q
from ..operators import relational as R
from ..schema import Limits
from ..sources import io, shared

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

FRAME = 8
RATE = 64
LIMITS = Limits(shortest=0.5, longest=20.0, clipping=0.05, rate=16, silence=0.9, a_rate=32, a_silence=0.2, a_rms=(-30.0, -12.0), b_silence=0.4, b_rms=-35.0)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return add


#: Files of a batch of a stream: all that have come.
ALL_FILES = 1_000_000


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Signals

_SIGNAL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS s FROM embeddings),
m AS (SELECT vec_id, s, len(s) AS n, list_max(list_transform(s, lambda x: abs(x))) AS pk, sqrt(list_sum(list_transform(s, lambda x: x * x)) / len(s)) AS r,
  list_transform(range(0, len(s) // {FRAME}), lambda i: 20 * log10(greatest(sqrt(list_sum(list_transform(list_slice(s, i * {FRAME} + 1, i * {FRAME} + {FRAME}), lambda x: x * x)) / {FRAME}), 1e-9))) AS f FROM e),
q AS (SELECT vec_id, round(n / {RATE}.0, 3) AS duration, round(20 * log10(greatest(pk, 1e-9)), 2) AS peak_db, round(20 * log10(greatest(r, 1e-9)), 2) AS rms_db,
  round(len(list_filter(s, lambda x: abs(x) >= 0.999)) / n, 4) AS clipping_ratio, round(len(list_filter(f, lambda x: x < -40)) / len(f), 4) AS silence_ratio FROM m)"""
_GRADED = _SIGNAL + f""",
g AS (SELECT *, CASE WHEN duration < {LIMITS.shortest} OR duration > {LIMITS.longest} OR clipping_ratio > {LIMITS.clipping} OR silence_ratio > {LIMITS.silence} THEN 'D'
  WHEN clipping_ratio = 0 AND silence_ratio < 0.2 AND rms_db BETWEEN -30 AND -12 THEN 'A' WHEN silence_ratio < 0.4 AND rms_db > -35 THEN 'B' ELSE 'C' END AS quality_grade FROM q)"""


def _signals(spark: SparkSession, d: str) -> DataFrame:
    return Q.measured(t(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", F.lit(RATE), F.lit(FRAME)).drop("embedding")


def _graded(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return _signals(spark, d).withColumn("quality_grade", Q.grade(c("duration"), F.lit("text"), c("clipping_ratio"), F.lit(RATE), c("silence_ratio"), c("rms_db"), LIMITS))


@query(_SIGNAL + " SELECT * FROM q")
def signal_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d)


@query(_GRADED + " SELECT vec_id, quality_grade FROM g")
def signal_grade(spark: SparkSession, d: str) -> DataFrame:
    return _graded(spark, d).select("vec_id", "quality_grade")


@query(
    _GRADED + " SELECT x.g AS quality_grade, count(g.vec_id)::BIGINT AS n, round(100.0 * count(g.vec_id) / sum(count(g.vec_id)) OVER (), 4) AS pct FROM (VALUES ('A'), ('B'), ('C'), ('D')) x(g) LEFT JOIN g ON g.quality_grade = x.g GROUP BY x.g"
)
def grade_histogram(spark: SparkSession, d: str) -> DataFrame:
    return Q.grade_histogram(_graded(spark, d))


@query(_GRADED + " SELECT vec_id, quality_grade FROM g WHERE quality_grade IN ('A', 'B')")
def grade_threshold_filter(spark: SparkSession, d: str) -> DataFrame:
    return Q.at_least(_graded(spark, d)).select("vec_id", "quality_grade")


@query(_GRADED + " SELECT vec_id, quality_grade FROM g WHERE quality_grade NOT IN ('C', 'D')")
def grade_fused_filter(spark: SparkSession, d: str) -> DataFrame:
    return Q.fused_threshold(_graded(spark, d)).select("vec_id", "quality_grade")


@query(_GRADED + " SELECT vec_id, CASE quality_grade WHEN 'A' THEN 'passthrough' ELSE 'denoise' END AS route FROM g")
def grade_route(spark: SparkSession, d: str) -> DataFrame:
    return _graded(spark, d).select("vec_id", Q.route(F.col("quality_grade")).alias("route"))


@query(_GRADED + " SELECT count(*) FILTER (WHERE quality_grade IN ('A','B'))::BIGINT AS kept, count(*) FILTER (WHERE quality_grade NOT IN ('A','B'))::BIGINT AS rejected, count(*) FILTER (WHERE quality_grade = 'B')::BIGINT AS b_grade FROM g")
def grade_counters(spark: SparkSession, d: str) -> DataFrame:
    keep = Q.grade_rank(F.col("quality_grade")) <= 1
    return _graded(spark, d).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("rejected"), F.count_if(F.col("quality_grade") == "B").alias("b_grade"))


_LOUD = -17.0


@query(
    f"""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS s FROM embeddings),
v AS (SELECT vec_id, len(s) AS n, list_transform(range(0, len(s) // {FRAME}), lambda i: 20 * log10(greatest(sqrt(list_sum(list_transform(list_slice(s, i * {FRAME} + 1, i * {FRAME} + {FRAME}), lambda x: x * x)) / {FRAME}), 1e-9)) >= {_LOUD}) AS f FROM e),
w AS (SELECT vec_id, n, list_position(f, true) AS a, len(f) - list_position(list_reverse(f), true) + 1 AS b, list_contains(f, true) AS voiced FROM v)
SELECT vec_id, CASE WHEN voiced THEN greatest(0, (a - 1) * {FRAME} - 2) ELSE 0 END::INTEGER AS first, CASE WHEN voiced THEN least(n, b * {FRAME} + 2) ELSE n END::INTEGER AS last FROM w"""
)
def trim_bounds(spark: SparkSession, d: str) -> DataFrame:
    b = S.trim_bounds(F.col("embedding"), F.lit(FRAME), F.lit(2), _LOUD)
    return t(spark, d, "embeddings").select("vec_id", b.alias("b")).select("vec_id", "b.first", "b.last")


@query(
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3) AS s FROM embeddings), p AS (SELECT *, list_max(list_transform(s, lambda x: abs(x))) AS p FROM e)
SELECT vec_id, round(p, 6) AS before, round(CASE WHEN p > 0.98 THEN 0.98::DOUBLE ELSE p END, 6) AS after, round(CASE WHEN p > 0 THEN 0.7::DOUBLE ELSE 0 END, 6) AS raised FROM p"""
)
def peak_gain_cap(spark: SparkSession, d: str) -> DataFrame:
    loud = t(spark, d, "embeddings").select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 3).alias("s"))
    return loud.select("vec_id", *(F.round(S.peak(x), 6).alias(n) for n, x in (("before", F.col("s")), ("after", S.cap_peak(F.col("s"))), ("raised", S.raise_peak(F.col("s"))))))


@query(
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS s FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(range(1, len(s) // 2 + 1), lambda i: (s[2 * i - 1] + s[2 * i]) / 2)), 9) AS total, (len(s) // 2)::INTEGER AS n FROM e"""
)
def downmix_pairs(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("embedding").cast("array<double>")
    mono = S.downmix(F.transform(F.sequence(F.lit(1), F.size(s), F.lit(2)), lambda i: F.slice(s, i, F.lit(2))))
    return t(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(mono, F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.size(mono).alias("n"))


@query("SELECT conv_id, (sum(length(text)) + 5 * (count(*) - 1))::INTEGER AS n_samples, count(*)::BIGINT AS pieces FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def concat_with_pause(spark: SparkSession, d: str) -> DataFrame:
    pieces = t(spark, d, "conversations").where("text is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").alias("n")))).alias("p"))
    joined = S.with_pauses(F.transform("p", lambda x: F.array_repeat(F.lit(0.5), x["n"])), F.lit(5))
    return pieces.select("conv_id", F.size(joined).alias("n_samples"), F.size("p").cast("long").alias("pieces"))


@query("SELECT user_id, round(sum(floor(least(value, 20))::BIGINT) / (20 * count(*)), 4) AS speech_ratio FROM events WHERE value IS NOT NULL GROUP BY user_id HAVING sum(floor(least(value, 20))::BIGINT) / (20 * count(*)) >= 0.4")
def speech_ratio_filter(spark: SparkSession, d: str) -> DataFrame:
    end = F.floor(F.least("value", F.lit(20.0)))
    spans = t(spark, d, "events").where("value is not null").groupBy("user_id").agg(F.collect_list(F.struct(F.lit(0).cast("long").alias("start"), end.alias("end"))).alias("spans"), (F.count(F.lit(1)) * 20).alias("length"))
    return Q.by_speech(spans, "spans", "length").select("user_id", "speech_ratio")


# Manifests

@query("SELECT event_id, user_id, coalesce(nullif(c_name, ''), nullif(event_type, ''), 'unknown') AS speaker FROM events LEFT JOIN customer ON user_id = c_custkey")
def coalesce_speaker(spark: SparkSession, d: str) -> DataFrame:
    out = t(spark, d, "events").join(t(spark, d, "customer").select("c_custkey", "c_name"), F.col("user_id") == F.col("c_custkey"), "left")
    return out.select("event_id", "user_id", Q.or_default(F.col("c_name"), F.col("event_type"), default="unknown").alias("speaker"))


@query("SELECT event_id, (props->>'k')::INTEGER AS k FROM events")
def manifest_parse(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


_ROWS = """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS speaker_id, CASE WHEN doc_id % 13 = 0 THEN '  ' ELSE text END AS text,
  CASE WHEN doc_id % 17 = 0 THEN 0.0 ELSE n_chars / 15.0 END AS duration, 'doc/' || doc_id AS audio_path, doc_id % 19 <> 0 AS there FROM documents"""
_ERRORS = f"""SELECT doc_id, CASE WHEN speaker_id IS NULL THEN 'missing speaker_id' WHEN NOT regexp_matches(text, '\\S') THEN 'empty text' WHEN NOT duration > 0 THEN 'bad duration' WHEN NOT there THEN 'no file' END AS error FROM ({_ROWS})"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    rows = t(spark, d, "documents").select(
        "doc_id", F.when(i % 11 != 0, F.col("source")).alias("speaker_id"), F.when(i % 13 == 0, "  ").otherwise(F.col("text")).alias("text"),
        F.when(i % 17 == 0, 0.0).otherwise(F.col("n_chars") / 15.0).alias("duration"), F.concat(F.lit("doc/"), i).alias("audio_path"), (i % 19 != 0).alias("there"),
    )
    return Q.validated(rows, F.col("there")).select("doc_id", "error")


@query(_ERRORS)
def validate_rows(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d)


@query(f"SELECT count(*) FILTER (WHERE error IS NULL)::BIGINT AS n_ok, count(*) FILTER (WHERE error IS NOT NULL)::BIGINT AS n_bad FROM ({_ERRORS})")
def validate_summary(spark: SparkSession, d: str) -> DataFrame:
    return Q.validation_summary(_checked(spark, d))


@query(f"SELECT * FROM ({_ERRORS}) WHERE error IS NOT NULL ORDER BY doc_id LIMIT 20")
def first_errors(spark: SparkSession, d: str) -> DataFrame:
    return Q.first_errors(_checked(spark, d), "doc_id")


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '\\S') AND lang IS NOT NULL")
def ingest_filter(spark: SparkSession, d: str) -> DataFrame:
    return Q.with_audio_and_text(t(spark, d, "documents"), "lang", "text").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def recon_missing_pairs(spark: SparkSession, d: str) -> DataFrame:
    return Q.without_partner(t(spark, d, "documents").select("doc_id"), t(spark, d, "labels"), ["doc_id"])


@query("SELECT DISTINCT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_rows(spark: SparkSession, d: str) -> DataFrame:
    return Q.existing(t(spark, d, "documents").select("doc_id", "source"), t(spark, d, "labels"), "doc_id")


@query("SELECT coalesce(d.doc_id, b.item_id) AS id, d.doc_id IS NOT NULL AS has_left, b.item_id IS NOT NULL AS has_right FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT item_id FROM benchmark) b ON d.doc_id = b.item_id")
def pair_orphans(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return R.pairs(docs, t(spark, d, "benchmark").select(F.col("item_id").alias("id")), ["id"])


@query("SELECT d.doc_id, coalesce(l.doc_id * 2, -1) AS have, d.doc_id * 2 + d.doc_id % 2 AS expected FROM (SELECT doc_id FROM documents) d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.doc_id * 2, -1) <> d.doc_id * 2 + d.doc_id % 2")
def size_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    return Q.size_mismatches(t(spark, d, "labels").select("doc_id", (i * 2).alias("size")), t(spark, d, "documents").select("doc_id", (i * 2 + i % 2).alias("size")), "doc_id", "size")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id")
def anti_join_todo(spark: SparkSession, d: str) -> DataFrame:
    return R.todo(t(spark, d, "documents").select("doc_id", "source"), t(spark, d, "labels"), ["doc_id"], ["doc_id"])


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return R.first_wins(t(spark, d, "documents"), ["text"], ["doc_id"]).select("doc_id", "source")


_STATUS = """SELECT event_id, CASE WHEN coalesce(sum((value > 10)::INT) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 'duplicate'
  WHEN value > 10 THEN 'accepted' ELSE 'rejected' END AS status FROM events"""


def _accounted(spark: SparkSession, d: str) -> DataFrame:
    return R.acceptance(t(spark, d, "events"), ["user_id", "event_type"], "event_id", F.coalesce(F.col("value") > 10, F.lit(False)))


@query(_STATUS)
def dedup_accept_accounting(spark: SparkSession, d: str) -> DataFrame:
    return _accounted(spark, d).select("event_id", "status")


@query(f"SELECT status, count(*)::BIGINT AS n FROM ({_STATUS}) GROUP BY status")
def dedup_counters(spark: SparkSession, d: str) -> DataFrame:
    return _accounted(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT text, source, 0 AS src FROM documents UNION ALL SELECT text, NULL, 1 FROM conversations")
def union_manifests(spark: SparkSession, d: str) -> DataFrame:
    return io.union([t(spark, d, "documents").select("text", "source"), t(spark, d, "conversations").select("text")])


def _split_sql(rest: str) -> str:
    return f"WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents), s AS (SELECT doc_id, n_chars, CASE WHEN k <= floor(n * 0.02) THEN 'valid' WHEN k <= 2 * floor(n * 0.02) THEN 'test' ELSE 'train' END AS split FROM r) {rest}"


@query(_split_sql("SELECT doc_id, split FROM s"))
def exact_split(spark: SparkSession, d: str) -> DataFrame:
    return R.exact_split(t(spark, d, "documents").select("doc_id"), "doc_id")


@query(_split_sql("SELECT split, count(*)::BIGINT AS clips, round(sum(n_chars) / 15.0 / 3600, 4) AS hours FROM s GROUP BY split"))
def split_hours(spark: SparkSession, d: str) -> DataFrame:
    return R.exact_split(t(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").groupBy("split").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("n_chars") / 15.0 / 3600, 4).alias("hours"))


@query("SELECT doc_id, regexp_replace(source, '[^a-zA-Z0-9]', '_', 'g') AS speaker, lpad((row_number() OVER (PARTITION BY source ORDER BY doc_id))::VARCHAR, 8, '0') AS seq FROM documents")
def speaker_sequence(spark: SparkSession, d: str) -> DataFrame:
    return R.speaker_sequence(t(spark, d, "documents").select("doc_id", "source"), T.identifier(F.col("source")), "doc_id").drop("source")


@query("SELECT * FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS seq, lang FROM documents) WHERE lang = 'en'")
def gapped_sequence(spark: SparkSession, d: str) -> DataFrame:
    return R.gapped_sequence(t(spark, d, "documents").select("doc_id", "source", "lang"), "doc_id", F.col("lang") == "en", ["source"])


@query("SELECT doc_id, CASE WHEN r <= 20 THEN 1 WHEN r <= 100 THEN 2 ELSE 3 END AS round FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 500")
def cumulative_rounds(spark: SparkSession, d: str) -> DataFrame:
    return R.rounds(t(spark, d, "documents").select("doc_id"), "doc_id", [20, 100, 500])


@query("SELECT source AS speaker, count(*)::BIGINT AS clips FROM documents GROUP BY source")
def speaker_counts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").groupBy(F.col("source").alias("speaker")).agg(F.count(F.lit(1)).alias("clips"))


@query("SELECT count(DISTINCT source)::BIGINT AS speakers, count(DISTINCT lang)::BIGINT AS langs FROM documents")
def distinct_speakers(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").agg(F.countDistinct("source").alias("speakers"), F.countDistinct("lang").alias("langs"))


@query("SELECT event_type AS rate, count(*)::BIGINT AS n, count(*) FILTER (WHERE value < 20)::BIGINT AS n_low FROM events GROUP BY event_type")
def rate_histogram(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy(F.col("event_type").alias("rate")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < 20).alias("n_low"))


# Hashes and shards

_BUCKET = "list_reduce(list_concat([0::BIGINT], list_transform(range(0, 4), lambda i: ('0x' || substr(md5(k), (i * 8 + 1)::INT, 8))::BIGINT)), lambda a, x: (a * 4294967296 + x) % {n})"


@query("SELECT doc_id, " + ", ".join(f"{_BUCKET.format(n=n)} AS b{n}" for n in (2, 5, 14)) + " FROM (SELECT doc_id, doc_id::VARCHAR AS k FROM documents)")
def shard_bucket(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", *(H.bucket(F.col("doc_id"), n).alias(f"b{n}") for n in (2, 5, 14)))


_BALANCED = "SELECT source, ((row_number() OVER (ORDER BY md5(source), source) - 1) % 4)::INTEGER AS shard FROM (SELECT DISTINCT source FROM documents)"


@query(_BALANCED)
def balanced_shards(spark: SparkSession, d: str) -> DataFrame:
    return R.balanced_shards(t(spark, d, "documents"), "source", 4)


@query(f"SELECT doc_id, source, shard FROM documents JOIN ({_BALANCED}) USING (source) WHERE shard = 1")
def shard_filter(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents").select("doc_id", "source")
    return R.shard_rows(docs, "source", R.balanced_shards(docs, "source", 4), 4, 1).select("doc_id", "source", "shard")


@query("SELECT doc_id, substr(md5('ds|train|n=' || n_chars || '|shards=4|idx=' || (doc_id % 4) || '|rev=1'), 1, 16) AS cache_key FROM documents")
def cache_key(spark: SparkSession, d: str) -> DataFrame:
    key = H.cache_key(F.lit("ds"), F.lit("train"), F.col("n_chars"), F.lit(4), F.col("doc_id") % 4, F.lit("1"))
    return t(spark, d, "documents").select("doc_id", key.alias("cache_key"))


# Registry, locks, plans

_REGISTRY = "SELECT event_id AS pos, user_id AS step, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS val_loss FROM events"


def _registry(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select(F.col("event_id").alias("pos"), F.col("user_id").alias("step"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("val_loss"))


@query(f"SELECT * FROM ({_REGISTRY}) ORDER BY val_loss ASC NULLS LAST, step DESC, pos LIMIT 1")
def best_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    return R.pull(_registry(spark, d), "best")


@query(f"SELECT * FROM ({_REGISTRY}) ORDER BY step DESC, pos LIMIT 1")
def latest_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    return R.pull(_registry(spark, d), "latest")


@query("SELECT min(CASE WHEN event_id % 2 = 0 THEN value END) AS value FROM events")
def min_named_metric(spark: SparkSession, d: str) -> DataFrame:
    odd = F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")).otherwise("n/a")
    return R.min_named(t(spark, d, "events").select(odd.alias("val_loss_epoch"), "user_id"), "val", "loss")


@query(
    """WITH l AS (SELECT event_id, event_type AS owner, value AS acquired, value + 10 AS expires FROM events), g AS (SELECT *, owner IS NULL OR owner = 'click' OR expires <= 30 AS ok FROM l)
SELECT event_id, coalesce(ok, false) AS granted, CASE WHEN ok THEN 'click' ELSE owner END AS owner, round(CASE WHEN ok THEN 30.0 ELSE acquired END, 6) AS acquired, round(CASE WHEN ok THEN 3630.0 ELSE expires END, 6) AS expires FROM g"""
)
def lock_acquire(spark: SparkSession, d: str) -> DataFrame:
    locks = t(spark, d, "events").select("event_id", F.col("event_type").alias("owner"), F.col("value").alias("acquired"), (F.col("value") + 10).alias("expires"))
    out = R.acquire(locks, "click", F.lit(30.0))
    return out.withColumns({"granted": F.coalesce("granted", F.lit(False)), "acquired": F.round("acquired", 6), "expires": F.round("expires", 6)})


@query("SELECT event_id, event_type AS owner FROM events WHERE event_type IS DISTINCT FROM 'click'")
def lock_release(spark: SparkSession, d: str) -> DataFrame:
    return R.release(t(spark, d, "events").select("event_id", F.col("event_type").alias("owner")), "click")


_CHUNKS = """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
c AS (SELECT source, doc_id, n_chars, r, 1 AS chunk, n_chars AS total FROM o WHERE r = 1 UNION ALL
  SELECT o.source, o.doc_id, o.n_chars, o.r, CASE WHEN c.total >= 20000 THEN c.chunk + 1 ELSE c.chunk END, CASE WHEN c.total >= 20000 THEN o.n_chars ELSE c.total + o.n_chars END FROM c JOIN o ON o.source = c.source AND o.r = c.r + 1)"""


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return cuts.greedy_chunks(t(spark, d, "documents").select("source", "doc_id", "n_chars"), "doc_id", "n_chars", 20000, ["source"])


@query(_CHUNKS + " SELECT source, doc_id, n_chars, chunk FROM c")
def greedy_chunks(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d)


_FILES = "SELECT doc_id // 40 AS file, sum(n_chars)::BIGINT AS bytes, count(*) FILTER (WHERE n_chars >= 200)::BIGINT AS clips FROM documents GROUP BY ALL"


def _fold(name: str, size: str, limit: int) -> str:
    return f"""{name} AS (SELECT file, {size} AS s, r, 1 AS chunk, {size} AS total FROM o WHERE r = 1 UNION ALL
  SELECT o.file, o.{size}, o.r, CASE WHEN c.total >= {limit} THEN c.chunk + 1 ELSE c.chunk END, CASE WHEN c.total >= {limit} THEN o.{size} ELSE c.total + o.{size} END FROM {name} c JOIN o ON o.r = c.r + 1)"""


@query(
    f"WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY file) AS r FROM ({_FILES})), {_fold('b', 'bytes', 150000)}, {_fold('k', 'clips', 100)} "
    "SELECT file, bytes, clips, b.chunk AS chunk, k.chunk AS shard FROM o JOIN b USING (file) JOIN k USING (file)"
)
def shard_cut(spark: SparkSession, d: str) -> DataFrame:
    """Files are read by chunks of bytes and cut to shards by their accepted clips; what is pending at the end of a first
    run over half of the files is carried into the second."""
    docs = t(spark, d, "documents")
    files = docs.groupBy(F.floor(F.col("doc_id") / 40).alias("file")).agg(F.sum("n_chars").alias("bytes"), F.count_if(F.col("n_chars") >= 200).alias("clips"))
    half = (docs.agg(F.max("doc_id")).first()[0] or 0) // 80
    first = cuts.greedy_chunks(files.where(F.col("file") < half), "file", "clips", 100)
    second = cuts.greedy_chunks(files.where(F.col("file") >= half), "file", "clips", 100, opened=cuts.open_chunks(first, "clips"))
    shards = first.unionByName(second).select("file", F.col("chunk").alias("shard"))
    return files.join(cuts.greedy_chunks(files, "file", "bytes", 150000).select("file", "chunk"), "file").join(shards, "file")


@query(_CHUNKS + " SELECT source, chunk, count(*)::BIGINT AS clips, round(sum(n_chars) / 15.0 / 3600, 4) AS hours, sum(n_chars)::BIGINT AS proto_bytes, round(sum(n_chars) / (sum(n_chars) / 15.0), 1) AS bytes_per_second, string_agg(DISTINCT 'f' || (doc_id % 3), ',' ORDER BY 'f' || (doc_id % 3)) AS source_files FROM c GROUP BY source, chunk")
def shard_meta(spark: SparkSession, d: str) -> DataFrame:
    rows = _chunks(spark, d).withColumns({"seconds": F.col("n_chars") / 15.0, "file": F.concat(F.lit("f"), F.col("doc_id") % 3)})
    return R.shard_meta(rows, ["source", "chunk"], "seconds", "n_chars", "file")


@query("SELECT (1000 + count(*))::BIGINT AS clips, (50000 + sum(n_chars))::BIGINT AS seconds FROM documents")
def cumulative_progress(spark: SparkSession, d: str) -> DataFrame:
    session = t(spark, d, "documents").agg(F.count(F.lit(1)).alias("clips"), F.sum("n_chars").alias("seconds"))
    return R.progress(spark.sql("SELECT 1000L AS clips, 50000L AS seconds"), session)


@query("SELECT user_id, round(sum(value) / count(*), 4) AS rate, round(1000 / (sum(value) / count(*)), 1) AS eta_s FROM events GROUP BY user_id")
def throughput_eta(spark: SparkSession, d: str) -> DataFrame:
    sums = t(spark, d, "events").groupBy("user_id").agg(F.sum("value").alias("v"), F.count(F.lit(1)).cast("double").alias("n"))
    return sums.select("user_id", R.throughput(F.col("v"), F.col("n"), F.lit(1000.0)).alias("x")).select("user_id", "x.*")


@query("SELECT DISTINCT source, CASE WHEN g < 6 THEN 1 WHEN g < 12 THEN 1 WHEN g < 20 THEN 2 ELSE 4 END AS batch, CASE WHEN g < 6 THEN 512 WHEN g < 12 THEN 768 ELSE 1024 END AS length, CASE WHEN g < 12 THEN 4 WHEN g < 20 THEN 2 ELSE 1 END AS accum FROM (SELECT source, replace(source, 'src', '')::INTEGER + 2 AS g FROM documents)")
def memory_tiers(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("source").distinct().select("source", Q.tier(F.regexp_replace("source", "src", "").cast("int") + 2).alias("x")).select("source", "x.*")


@query(
    "SELECT * FROM (SELECT CASE WHEN k % 4 = 1 THEN 'data/train-v' || k || '-' || lpad(k::VARCHAR, 5, '0') ELSE 'data/train-' || lpad(k::VARCHAR, 5, '0') || CASE k % 4 WHEN 0 THEN '-of-00653' WHEN 2 THEN '-of-00724' ELSE '' END END || '.parquet' AS path, "
    "CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS gen FROM (SELECT n_nationkey AS k FROM nation)) WHERE gen IS NOT NULL"
)
def source_generations(spark: SparkSession, d: str) -> DataFrame:
    k, number = F.col("n_nationkey"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    plain = F.concat(F.lit("data/train-"), number, F.when(k % 4 == 0, "-of-00653").when(k % 4 == 2, "-of-00724").otherwise(""))
    path = F.when(k % 4 == 1, F.concat(F.lit("data/train-v"), k, F.lit("-"), number)).otherwise(plain)
    return io.generations(t(spark, d, "nation").select(F.concat(path, F.lit(".parquet")).alias("path")), partial=True)


# Text

@query("SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9]', '_', 'g') AS id FROM pages")
def sanitize_ids(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", T.identifier(F.col("url")).alias("id"))


@query("SELECT doc_id, lpad(doc_id::VARCHAR, 8, '0') AS stem, 'step_' || lpad(doc_id::VARCHAR, 7, '0') AS step, source || '_' || doc_id || '.wav' AS wav FROM documents")
def zero_pad(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("/a/b.c/"), F.col("source"), F.lit("_"), F.col("doc_id"), F.lit(".flac"))
    return t(spark, d, "documents").select("doc_id", F.format_string("%08d", "doc_id").alias("stem"), F.format_string("step_%07d", "doc_id").alias("step"), T.stem(path).alias("wav"))


@query("SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.1fB', b) WHEN b < 1048576 THEN printf('%.1fKB', b / 1024) WHEN b < 1073741824 THEN printf('%.1fMB', b / 1048576) ELSE printf('%.1fGB', b / 1073741824) END AS size FROM (SELECT doc_id, (n_chars * (1 + doc_id % 4) * (1 + 1000 * (doc_id % 3)))::DOUBLE AS b FROM documents)")
def human_bytes(spark: SparkSession, d: str) -> DataFrame:
    n = (F.col("n_chars") * (1 + F.col("doc_id") % 4) * (1 + 1000 * (F.col("doc_id") % 3))).cast("double")
    return t(spark, d, "documents").select("doc_id", T.human_bytes(n).alias("size"))


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_THOUSAND = f"""(CASE WHEN {{x}} // 100 > 0 THEN {_list(T.ONES)}[({{x}} // 100 + 1)::INT] || '{T.HUNDRED}' ELSE '' END || {_list(T.TENS)}[({{x}} // 10 % 10 + 1)::INT] || CASE WHEN {{x}} % 10 > 0 THEN {_list(T.ONES)}[({{x}} % 10 + 1)::INT] ELSE '' END)"""


def _words_sql(x: str) -> str:
    """Words of a non-negative integer below 10^12."""
    part = lambda g, word: f"CASE WHEN {g} > 0 THEN {_THOUSAND.format(x=f'({g})')} || '{word}' ELSE '' END"
    return f"CASE WHEN {x} = 0 THEN '{T.ONES[0]}' ELSE {part(f'({x} // 1000000000)', T.BILLION)} || {part(f'({x} // 1000000 % 1000)', T.MILLION)} || {part(f'({x} // 1000 % 1000)', T.THOUSAND)} || {part(f'({x} % 1000)', '')} END"


@query(f"SELECT o_orderkey, CASE WHEN k < 0 THEN '{T.MINUS}' ELSE '' END || {_words_sql('abs(k)')} AS words FROM (SELECT o_orderkey, o_orderkey * (o_custkey * 97 - 40000) AS k FROM orders)")
def number_words_int(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", T.number_words(F.col("o_orderkey") * (F.col("o_custkey") * 97 - 40000)).alias("words"))


@query(
    f"""SELECT l_orderkey, l_linenumber, '{T.ONES[0]}' || CASE WHEN f = '' THEN '' ELSE '{T.POINT}' || array_to_string(list_transform(string_split(f, ''), lambda c: {_list(T.ONES)}[c::INT + 1]), '') END AS words
FROM (SELECT l_orderkey, l_linenumber, rtrim(lpad(round(l_discount * 100)::INT::VARCHAR, 2, '0'), '0') AS f FROM lineitem WHERE l_discount < 1)"""
)
def number_words_decimal(spark: SparkSession, d: str) -> DataFrame:
    s = F.concat(F.lit("0."), F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"))
    return t(spark, d, "lineitem").where("l_discount < 1").select("l_orderkey", "l_linenumber", T.number_words(s).alias("words"))


@query(
    f"""SELECT o_orderkey, 'cost ' || {_words_sql('w')} || '{T.DOLLAR}' || CASE WHEN c > 0 THEN ' ' || {_words_sql('c')} || '{T.CENT}' ELSE '' END || ' or ' || {_words_sql('w')} || '{T.RIEL}.' AS said
FROM (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT // 100 AS w, round(o_totalprice * 100)::BIGINT % 100 AS c FROM orders)"""
)
def currency_rewrite(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    whole, part = (cents / 100).cast("long").cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    return t(spark, d, "orders").select("o_orderkey", T.currency(F.concat(F.lit("cost $"), whole, F.lit("."), part, F.lit(" or "), whole, F.lit(" ៛."))).alias("said"))


@query(f"SELECT l_orderkey, l_linenumber, 'off ' || {_words_sql('k')} || '{T.PERCENT} now' AS said FROM (SELECT l_orderkey, l_linenumber, l_partkey % 1000 AS k FROM lineitem)")
def percent_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.percent(F.concat(F.lit("off "), F.col("l_partkey") % 1000, F.lit(" % now"))).alias("said"))


@query(
    f"""SELECT o_orderkey, 'on {T.DAY}' || {_words_sql('day(o_orderdate)')} || ' {T.MONTH}' || {_list(T.MONTHS)}[month(o_orderdate)] || ' {T.YEAR}' || {_words_sql('year(o_orderdate)')} || ' there' AS said FROM orders"""
)
def date_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", T.dates(F.concat(F.lit("on "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" there"))).alias("said"))


@query()
def bare_number_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", T.numbers(F.concat(F.lit("n 1,234 and -7.5 x9 "), F.col("doc_id"), F.lit(" "), F.col("text"))).alias("said"))


@query()
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return T.normalize(t(spark, d, "documents").select("doc_id", F.concat(F.lit("$"), F.col("doc_id"), F.lit(" 25% "), F.col("text")).alias("said")), "said")


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(translate(nfc_normalize(text), chr(8203) || chr(8204) || chr(8205) || chr(65279), ''), '[ \\t\\x{00a0}]+', ' ', 'g'), '\\n{2,}', chr(10), 'g'), ' ' || chr(10)) AS said FROM (SELECT doc_id, '  ' || replace(text, '. ', chr(10) || chr(10) || ' ' || chr(8203)) || chr(10) AS text FROM documents)")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    rough = F.concat(F.lit("  "), F.replace(F.col("text"), F.lit(". "), F.lit("\n\n \u200b")), F.lit("\n"))
    return t(spark, d, "documents").select("doc_id", T.clean(rough).alias("said"))


@query("SELECT doc_id, pos::INTEGER AS pos, s AS sentence FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS s FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^!?]*[!?]|[^!?]+$'), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS l FROM documents))")
def sentences(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))


@query("SELECT doc_id, CASE WHEN text IS NULL OR length(text) NOT BETWEEN 1 AND 2000 THEN 'text length' WHEN source NOT IN ('src1', 'src2') THEN 'unknown speaker' WHEN NOT regexp_matches(text, '\\S') THEN 'nothing to say' END AS error FROM documents")
def request_validation(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", Q.request_error(F.col("text"), F.col("text"), F.col("source"), ["src1", "src2"]).alias("error"))


@query("SELECT '| ' || item_id || ' | ' || text || ' |  |' AS line FROM benchmark")
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    return io.scorecard(t(spark, d, "benchmark").withColumn("score", F.lit(None).cast("string")), ["item_id", "text", "score"])


@query("SELECT text, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS doc_id FROM (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text) GROUP BY text")
def stream_incremental_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The incremental build over the table's rows, which come as three deliveries of many files in the order of their ids
    (rows without an id last), each built when it has come; a last run finds nothing new. The document that stays is read
    from the shards."""
    import os

    from ..streaming import incremental

    root = f"{shared.shared_dir(spark)}/stream-{os.urandom(8).hex()}"
    keep = spark.read.parquet(f"{d}/documents.parquet")
    source, i = f"{root}/in", F.col("doc_id")
    low, high = (x or 0 for x in keep.agg(F.min("doc_id"), F.max("doc_id")).first())
    third = (high - low) // 3 + 1
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema)
    for came in (i < low + third, (i >= low + third) & (i < low + 2 * third), (i >= low + 2 * third) | i.isNull(), None):
        if came is not None:
            keep.where(came).write.mode("append").parquet(source)
        incremental.build(spark, source, ddl, f"{root}/out", f"{root}/state", ["text"], files=ALL_FILES, order="doc_id")
    return incremental.shards(spark, f"{root}/out").groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))


_LEDGER = """WITH RECURSIVE k AS (SELECT doc_id, doc_id // 64 AS file, n_chars FROM documents QUALIFY n_chars >= 200 AND row_number() OVER (PARTITION BY text, n_chars >= 200 ORDER BY doc_id) = 1),
f AS (SELECT file, coalesce(n, 0) AS n, row_number() OVER (ORDER BY file) AS r FROM (SELECT DISTINCT doc_id // 64 AS file FROM documents) LEFT JOIN (SELECT file, count(*) AS n FROM k GROUP BY file) USING (file)),
c AS (SELECT file, r, 1 AS shard, n AS total FROM f WHERE r = 1 UNION ALL
  SELECT f.file, f.r, CASE WHEN c.total >= 100 OR f.r = 3 THEN c.shard + 1 ELSE c.shard END, CASE WHEN c.total >= 100 OR f.r = 3 THEN f.n ELSE c.total + f.n END FROM c JOIN f ON f.r = c.r + 1)
SELECT doc_id, n_chars, shard FROM k JOIN c USING (file)"""


@query(_LEDGER)
def ledger_build(spark: SparkSession, d: str) -> DataFrame:
    """The table's documents as files of 64 ids each, built to shards by two runs, the first stopped after two chunks; the
    first of equal texts that is long enough stays. The shard of each document that was accepted."""
    from ..streaming.ledger import Build

    root = shared.shared_path(spark, "ledger")
    docs = t(spark, d, "documents").select("doc_id", "text", "n_chars")
    parts = docs.withColumn("f", F.format_string("%09d", F.floor(F.col("doc_id") / 64).cast("long")))
    parts.repartition("f").sortWithinPartitions("f", "doc_id").write.partitionBy("f").parquet(f"{root}/in")
    judge = lambda df: df.withColumns({"ok": F.col("n_chars") >= 200, "seconds": F.col("n_chars") / 15.0})
    build = Build(spark, f"{root}/in", "doc_id bigint, text string, n_chars bigint", f"{root}/out", ["text"], judge, shard_clips=100, chunk_bytes=1)
    build.run(max_chunks=2)
    build.chunk_bytes = 1 << 30
    build.run()
    return build.rows().select("doc_id", "n_chars", "shard")


@query(
    "SELECT d.doc_id, nullif(regexp_replace(CASE WHEN b.item_id IS NOT NULL THEN CASE WHEN b.item_id % 5 = 0 THEN chr(10) ELSE b.text END ELSE d.lang END, '^\\s+|\\s+$', '', 'g'), '') AS reference "
    "FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id"
)
def reference_lookup(spark: SparkSession, d: str) -> DataFrame:
    docs, i = t(spark, d, "documents"), F.col("item_id")
    txt = t(spark, d, "benchmark").select(i.alias("doc_id"), F.when(i % 5 == 0, "\n").otherwise(F.col("text")).alias("txt"))
    return R.references(docs.select("doc_id"), t(spark, d, "labels"), txt, docs.select("doc_id", F.col("lang").alias("lab")), "doc_id")


@query("SELECT n_name, r_name AS speaker_id FROM nation JOIN region ON n_regionkey = r_regionkey")
def name_map(spark: SparkSession, d: str) -> DataFrame:
    names = t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("speaker_id"))
    return R.mapped(t(spark, d, "nation"), names, "n_regionkey").select("n_name", "speaker_id")


@query("SELECT count(*)::BIGINT AS shards, sum(clips)::BIGINT AS clips, sum(bytes)::BIGINT AS bytes FROM (SELECT source, count(*) AS clips, sum(n_chars) AS bytes FROM documents GROUP BY source)")
def grand_totals(spark: SparkSession, d: str) -> DataFrame:
    shards = t(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("clips"), F.sum("n_chars").alias("bytes"))
    return R.grand_totals(shards, ["clips", "bytes"])


@query("SELECT coalesce(bool_or(n_chars > 100000000), false) AS huge, coalesce(bool_or(lang = 'en'), false) AS english FROM documents")
def any_rows(spark: SparkSession, d: str) -> DataFrame:
    return R.any_of(t(spark, d, "documents"), huge=F.col("n_chars") > 100_000_000, english=F.col("lang") == "en")


from . import files  # noqa: E402, F401  its queries join those above
