"""Token ids as Parquet files made for selective reads.

Rows lie in ascending document id. Files are cut by ranges of the id, so the row-group statistics and the
page indexes (which Spark's Parquet writer always adds) let a reader that wants some documents, or only the
metadata columns, skip the rest. Ids are 32-bit integers without a dictionary in version 2 pages, which
delta-encodes them in bit-packed blocks; the language and source columns keep dictionaries.

Defined cases: null text has only the end id; null document ids sort first; rows with equal ids lie side by
side in any order; an empty table gives an empty folder that reads back as an empty table; columns n_tokens and
ids replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import BATCH, codec, slices
from .common import ship, trim

END = 2
#: Bytes of a row group and of a page before compression: pages hold some dozens of documents.
ROW_GROUP = 16 << 20
PAGE = 256 << 10
#: Bytes of text a file.
FILE = 24 << 20


def tokenized(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """doc_id, source and lang where there, n_tokens and ids (with the end id), without any order."""
    ship(docs.sparkSession)
    kept = [doc_id, *(c for c in ("source", "lang") if c in docs.columns and c not in (doc_id, text))]
    schema = docs.select(*kept, F.lit(0).cast("long").alias("n_tokens"), F.array(F.lit(0)).alias("ids")).schema

    def run(batches):
        import numpy as np
        import pyarrow as pa

        c = codec(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for s in slices(column, BATCH):
                ids, offsets = c.encode_column(column[s])
                ids = np.insert(ids, offsets[1:], np.uint32(end))
                offsets += np.arange(len(offsets))
                lengths = np.diff(offsets)
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k))[s] for k in kept), pa.array(lengths), ids], names=schema.names)
        trim()

    return docs.select(*kept, text).mapInArrow(run, schema)


def write(docs: DataFrame, out: str, path: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Writes docs' ids to the folder ``out``. The texts are dealt by ranges of the id first, as they are smaller
    than their ids, and encoded where they are written."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranged = docs.repartitionByRange(max(1, -(-size // FILE)), doc_id).sortWithinPartitions(doc_id)
    writer = tokenized(ranged, path, doc_id, text, end).write
    for k, v in (("parquet.writer.version", "PARQUET_2_0"), ("parquet.enable.dictionary#ids.list.element", "false"), ("parquet.enable.dictionary#n_tokens", "false"), ("parquet.block.size", ROW_GROUP), ("parquet.page.size", PAGE)):
        writer = writer.option(k, v)
    writer.option("compression", "zstd").parquet(out)


def _layout(spark: SparkSession, out: str, doc_id: str):
    """The folder's rows with their file; the files with the number of ids before each; the window within a file.

    The files are ordered by their smallest id (one row a file, on which the running totals are made), so that
    rows need be numbered within their file only.
    """
    rows = spark.read.parquet(out).withColumn("__file", F.col("_metadata.file_path"))
    order = F.col(doc_id).asc_nulls_first()
    files = rows.groupBy("__file").agg(F.sum("n_tokens").alias("__n"), F.min(doc_id).alias("__first"), F.count_if(F.col(doc_id).isNull()).alias("__null"))
    before = Window.orderBy(F.col("__null").desc(), F.col("__first").asc_nulls_first(), "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__file").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows, files, within


def read(spark: SparkSession, out: str, doc_id: str = "doc_id") -> DataFrame:
    """The folder's rows with start, the number of ids of all documents before."""
    rows, files, within = _layout(spark, out, doc_id)
    start = F.col("__before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.join(files, "__file").withColumn("start", start.cast("long")).drop("__file", "__before")


def with_checksums(spark: SparkSession, out: str, doc_id: str = "doc_id") -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    rows, files, within = _layout(spark, out, doc_id)
    schema = rows.select("__file", doc_id, "n_tokens", F.lit(0).cast("long").alias("ids_crc32")).schema

    def crc(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            col = b.column(b.schema.get_field_index("ids"))
            offsets, values = col.offsets.to_numpy(), memoryview(np.ascontiguousarray(col.values.to_numpy(), "<i4")).cast("B")
            sums = [zlib.crc32(values[4 * i : 4 * j]) for i, j in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sums, pa.int64())], names=schema.names)

    sums = rows.select("__file", doc_id, "n_tokens", "ids").mapInArrow(crc, schema)
    start = F.col("__before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return sums.join(files, "__file").withColumn("start", start).select(doc_id, F.col("start").cast("long"), "n_tokens", "ids_crc32")
