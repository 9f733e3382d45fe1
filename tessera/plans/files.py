"""Queries that take the driver's tables through sources, sinks and files and back, and rewrites of made texts of their
columns; each with SQL. Files are written below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T
from ..operators import quality as Q
from ..operators import relational as R
from ..schema import Limits
from ..sources import audio, io, registry, shared
from .catalog import _split_sql, _words_sql, query, t

RATE = 16000


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents")
    return docs.select(F.concat(F.lit("doc/"), "doc_id").alias("audio_path"), "text", F.col("source").alias("speaker_id"), (F.col("n_chars") / 15.0).alias("duration"), F.lit(None).cast("double").alias("rms_db"))


@query("SELECT 'doc/' || doc_id AS audio_path, text, source AS speaker_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS src FROM documents UNION ALL SELECT 'doc/' || doc_id, text, source, 1 FROM documents WHERE doc_id % 3 = 2")
def manifest_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as two manifests, one of them in two parts, the second appended, and read again."""
    path, rows = shared.shared_path(spark, "manifest"), _manifest(spark, d)
    third = F.regexp_extract("audio_path", "([0-9]+)", 1).cast("long") % 3
    io.write_manifest(rows.where(third == 0), f"{path}/a")
    io.write_manifest(rows, f"{path}/b")
    io.write_manifest(rows.where(third > 0), f"{path}/b")  # replaces
    io.write_manifest(rows.where(third == 2), f"{path}/b", append=True)
    return io.union([io.read_manifest(spark, f"{path}/{x}") for x in "ab"]).select("audio_path", "text", "speaker_id", "src")


@query(_split_sql("SELECT split, count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS ids FROM s GROUP BY split"))
def split_files(spark: SparkSession, d: str) -> DataFrame:
    path = shared.shared_path(spark, "splits")
    io.write_split_files(R.exact_split(t(spark, d, "documents").select("doc_id"), "doc_id"), f"{path}/docs")
    read = lambda n: spark.read.schema("doc_id bigint").json(f"{path}/docs_{n}.jsonl").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")).select(F.lit(n).alias("split"), "n", "ids")
    return read("train").unionByName(read("valid")).unionByName(read("test")).where("n > 0")


@query("SELECT doc_id, source AS speaker_id, n_chars FROM documents WHERE n_chars >= 300 AND doc_id % 4 <> 3")
def bounded_scan(spark: SparkSession, d: str) -> DataFrame:
    """The first three of four corpora, each of the files of all tasks, and the columns that are asked for."""
    path = shared.shared_path(spark, "corpus")
    docs = t(spark, d, "documents").withColumn("f", F.col("doc_id") % 4)
    docs.select("doc_id", F.col("source").alias("speaker_id"), "n_chars", "text", "f").write.partitionBy("f").parquet(path)
    rows = io.read_bounded(spark, [f"{path}/f={i}" for i in range(4)], F.col("n_chars") >= 300, most_files=3)
    return rows.select("doc_id", "speaker_id", "n_chars")


@query("SELECT doc_id, text FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 100")
def shuffled_take(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred in an order that looks random."""
    path = shared.shared_path(spark, "corpus")
    t(spark, d, "documents").write.parquet(path)
    return io.shuffled(io.read_corpus(spark, path, ["doc_id", "text"]), "doc_id", 7).limit(100)


@query("SELECT line, count(*)::BIGINT AS n FROM (SELECT regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS line FROM documents) WHERE line <> '' GROUP BY line")
def text_lines(spark: SparkSession, d: str) -> DataFrame:
    path = shared.shared_path(spark, "lines")
    io.write_lines(t(spark, d, "documents").where("text is not null"), "text", path)
    return io.read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH r AS (SELECT event_id AS pos, user_id AS step, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS val_loss FROM events ORDER BY event_id LIMIT 60) "
    "SELECT 'best' AS kind, step, val_loss FROM (SELECT * FROM r ORDER BY val_loss NULLS LAST, step DESC, pos LIMIT 1) UNION ALL SELECT 'latest', step, val_loss FROM (SELECT * FROM r ORDER BY step DESC, pos LIMIT 1)"
)
def registry_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Sixty checkpoints appended in three versions, and what is pulled then."""
    path = shared.shared_path(spark, "registry")
    rows = t(spark, d, "events").orderBy("event_id").limit(60).select("user_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v")).collect()
    for i in range(0, len(rows), 20):
        registry.append(spark, path, [{"step": r.user_id, "val_loss": r.v} for r in rows[i : i + 20]])
    pulled = [registry.pull(spark, path, k).select(F.lit(k).alias("kind"), "step", "val_loss") for k in ("best", "latest")]
    return pulled[0].unionByName(pulled[1])


@query(
    f"SELECT vec_id, 's_' || label AS speaker, lpad((row_number() OVER (PARTITION BY label ORDER BY vec_id))::VARCHAR, 8, '0') AS stem, 64::BIGINT AS frames, {RATE} AS sample_rate, 'vector ' || vec_id || chr(10) AS lab, "
    "round(round(embedding[1]::DOUBLE * 32767) / 32768, 6) AS first FROM embeddings"
)
def speaker_folders(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as clips of 64 samples, written as wav and lab files a speaker, found again by headers and decoded."""
    path = shared.shared_path(spark, "folders")
    clips = t(spark, d, "embeddings").select("vec_id", F.concat(F.lit("s "), "label").alias("speaker_id"), F.concat(F.lit(" vector "), "vec_id").alias("text"), F.col("embedding").cast("array<double>").alias("samples"), F.lit(RATE).alias("sample_rate"))
    audio.write_speaker_folders(clips, path, "vec_id")
    wavs = spark.read.format("wav_headers").load(path).select("path", "frames", "sample_rate")
    wavs = wavs.withColumn("samples", audio.decode_path(F.col("path"))["samples"])
    labs = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.lab").load(path)
    labs = labs.select(F.regexp_extract("path", r"([^/]+/[0-9]+)\.lab$", 1).alias("k"), F.decode("content", "UTF-8").alias("lab"))
    both = wavs.withColumn("k", F.regexp_extract("path", r"([^/]+/[0-9]+)\.wav$", 1)).join(labs, "k")
    return both.select(
        F.regexp_extract("lab", "([0-9]+)", 1).cast("long").alias("vec_id"), F.element_at(F.split("k", "/"), 1).alias("speaker"), F.element_at(F.split("k", "/"), 2).alias("stem"),
        "frames", "sample_rate", "lab", F.round(F.element_at("samples", 1), 6).alias("first"),
    )


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source")
def cached_table(spark: SparkSession, d: str) -> DataFrame:
    """Made once under its key, found the second time."""
    root = shared.shared_path(spark, "cache")
    made = []
    make = lambda: made.append(1) or t(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    io.cached(make, spark, root, "sources-1")
    out = io.cached(make, spark, root, "sources-1")
    if len(made) != 1:
        raise AssertionError("made again")
    return out


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '\\S') AND n_chars > 0")
def valid_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that pass the whole validation, behind its two gates: none may be bad, and some must be left."""
    rows = _manifest(spark, d).withColumn("doc_id", F.regexp_extract("audio_path", "([0-9]+)", 1).cast("long"))
    good = Q.validated(rows, F.lit(True)).where("error is null").drop("error")
    return Q.guard(Q.require_valid(Q.validated(good, F.lit(True))), "documents").select("doc_id")


@query("SELECT vec_id, len(s)::INTEGER AS n FROM (SELECT vec_id, embedding[1:vec_id % 60 + 1] AS s FROM embeddings) WHERE len(s) >= 19 AND vec_id % 7 <> 0")
def long_enough(spark: SparkSession, d: str) -> DataFrame:
    """Clips of 0.3 s at least with a text that is not blank."""
    clips = t(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, (F.col("vec_id") % 60 + 1).cast("int")).alias("s"), F.when(F.col("vec_id") % 7 == 0, " 　\n").otherwise("x").alias("text"))
    return Q.not_blank(Q.longer_than(clips, F.col("s"), F.lit(64), 0.3), "text").select("vec_id", F.size("s").alias("n"))


@query("SELECT vec_id, len(c)::INTEGER AS n, round(c[1]::DOUBLE, 6) AS first FROM (SELECT vec_id, embedding[2 * (vec_id % 5) + 1:50 + 2 * (vec_id % 7)] AS c FROM embeddings)")
def speech_slice(spark: SparkSession, d: str) -> DataFrame:
    """From the first span's start to the last one's end, given at half the rate of the samples."""
    i = F.col("vec_id")
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    spans = F.array(span(i % 5, F.lit(12)), span(F.lit(15), 25 + i % 7))
    cut = t(spark, d, "embeddings").select("vec_id", S.vad_slice(F.col("embedding").cast("array<double>"), spans, F.lit(2.0)).alias("c"))
    return cut.select("vec_id", F.size("c").alias("n"), F.round(F.element_at("c", 1), 6).alias("first"))


@query(
    "SELECT doc_id, CASE WHEN d < 0.5 OR d > 20 THEN 'D' WHEN r >= 22050 AND doc_id % 5 = 0 THEN 'A' ELSE 'B' END AS grade FROM (SELECT doc_id, (doc_id % 250) / 10.0 AS d, CASE doc_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 22050 ELSE 48000 END AS r FROM documents)"
)
def strict_grade(spark: SparkSession, d: str) -> DataFrame:
    """The grade whose best needs a rate of 22,050."""
    i = F.col("doc_id")
    clips = t(spark, d, "documents").select("doc_id", ((i % 250) / 10.0).alias("d"), F.when(i % 3 == 0, 16000).when(i % 3 == 1, 22050).otherwise(48000).alias("r"), F.when(i % 5 == 0, -20.0).otherwise(-31.0).alias("rms"))
    return clips.select("doc_id", Q.grade(F.col("d"), F.lit("ab"), F.lit(0.0), F.col("r"), F.lit(0.1), F.col("rms"), Limits(a_rate=22050)).alias("grade"))


# Texts made of the tables' columns.

def _either(x, of):
    return F.when(of % 2 == 0, x).otherwise(T.khmer_digits(x))


@query(
    "SELECT o_orderkey, 'on {D}' || {d} || ' {M}' || CASE WHEN o_orderkey % 3 = 0 THEN '{name}' ELSE ['{months}'][month(o_orderdate)] END || ' {Y}' || {y} || '.' AS said FROM orders".format(
        D=T.DAY, M=T.MONTH, Y=T.YEAR, d=_words_sql("day(o_orderdate)"), y=_words_sql("year(o_orderdate)"), months="', '".join(T.MONTHS), name="កខ"
    )
)
def full_date_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in full, with digits of either script, months as numbers or names of consonants, which stay."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    month = F.when(k % 3 == 0, "កខ").otherwise(_either(F.month(day).cast("string"), k))
    said = F.concat(F.lit(f"on {T.DAY} "), _either(F.dayofmonth(day).cast("string"), k), F.lit(f" {T.MONTH}"), month, F.lit(f" {T.YEAR} "), _either(F.year(day).cast("string"), k), F.lit("."))
    return t(spark, d, "orders").select("o_orderkey", T.dates(said).alias("said"))


@query(f"SELECT o_orderkey, 'in {T.YEAR}' || {_words_sql('year(o_orderdate)')} || ' and 2026' AS said FROM orders")
def year_rewrite(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.lit(f"in {T.YEAR} "), _either(F.year("o_orderdate").cast("string"), F.col("o_orderkey")), F.lit(" and 2026"))
    return t(spark, d, "orders").select("o_orderkey", T.dates(said).alias("said"))


@query(f"SELECT l_orderkey, l_linenumber, {_words_sql('l_partkey')} || '{T.DOLLAR} ' || {_words_sql('l_partkey')} || '{T.RIEL}' AS said FROM lineitem")
def khmer_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Amounts in Khmer digits before and behind their signs."""
    n = T.khmer_digits(F.col("l_partkey").cast("string"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.currency(F.concat(F.lit("$"), n, F.lit(" "), n, F.lit(f" {T.RIEL}"))).alias("said"))


@query("SELECT doc_id, translate(doc_id::VARCHAR, '0123456789', '" + T.KHMER_DIGITS + "') AS khmer, doc_id::VARCHAR AS back FROM documents")
def digit_scripts(spark: SparkSession, d: str) -> DataFrame:
    k = T.khmer_digits(F.col("doc_id").cast("string"))
    return t(spark, d, "documents").select("doc_id", k.alias("khmer"), T.arabic_digits(k).alias("back"))


def _replaced(x: str) -> str:
    for old, new in T.PUNCTUATION:
        x = "replace({}, '{}', '{}')".format(x, old.replace("'", "''"), new.replace("'", "''"))
    return x


@query(f"SELECT doc_id, {_replaced('x')} AS said FROM (SELECT doc_id, replace(replace(text, '. ', '... … '), ', ', ' – “a” ‘b’ ') AS x FROM documents)")
def punctuation_map(spark: SparkSession, d: str) -> DataFrame:
    rough = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit("... … ")), F.lit(", "), F.lit(" – “a” ‘b’ "))
    return t(spark, d, "documents").select("doc_id", T.punctuation(rough).alias("said"))


_C = T.COENG


@query(f"SELECT doc_id, regexp_replace(regexp_replace(replace(replace(text, 'e', 'ក{_C}{_C}ខ'), 'n', 'គ{_C}'), '{_C}{_C}+', '{_C}', 'g'), '{_C}(\\s|$)', '\\1', 'g') AS said FROM documents")
def coeng_repair(spark: SparkSession, d: str) -> DataFrame:
    rough = F.replace(F.replace(F.col("text"), F.lit("e"), F.lit(f"ក{_C}{_C}ខ")), F.lit("n"), F.lit(f"គ{_C}"))
    return t(spark, d, "documents").select("doc_id", T.ordering(rough).alias("said"))
