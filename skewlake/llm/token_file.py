"""Token ids as Parquet list columns, in doc_id order."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_slices, plain, shared_dir, text_bytes
from .tokens import encoder

#: Files at most; with more text files are larger. So the table of parts, a row for each file, is small enough to broadcast.
MAX_PARTS = 65_536
#: Row groups and pages of the files; ids are dictionary-encoded where that is smaller, else delta-encoded (format version 2).
WRITER = {"parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "true", "parquet.writer.version": "PARQUET_2_0", "compression": "zstd"}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, part_bytes: int = 16 << 20) -> None:
    """Write doc_id, part, at, n_tokens and ids (with end_id) of every document, in ascending doc_id order over the files.

    Files are ranges of doc_id of about part_bytes of text, sorted inside; part numbers them, and `at` is the number of ids
    before the document in its part. Page indexes let a reader that asks for some doc_id or for n_tokens alone skip the ids.
    """
    docs = plain(docs, doc_id="long", text="string")
    _, total = text_bytes(docs)
    dealt = docs.repartitionByRange(min(MAX_PARTS, max(1, -(-total // part_bytes))), "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())

    def run(batches):
        end, at = np.array([end_id], "<u4").tobytes(), 0
        for b in byte_slices(batches, 4 << 20):
            ids = [x + end for x in encoder(tokenizer).encode(b.column("text").to_pylist())]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            edge = np.concatenate([[0], np.cumsum(n)])
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(at + edge[:-1]), pa.array(n), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), values)], ["doc_id", "part", "at", "n_tokens", "ids"])
            at += int(edge[-1])

    dealt.mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids array<int>").write.options(**WRITER).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with `start`, the number of ids of all documents before; ids are read only if they are used."""
    rows = spark.read.schema("doc_id long, part int, at long, n_tokens long, ids array<int>").parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


def describe_tokens(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of rows that read_tokens gives; n_tokens is that of the ids read."""

    def run(batches):
        for b in batches:
            ids = b.column("ids")
            edge, values = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy()).astype("<i4", copy=False)
            crc = [zlib.crc32(values[x:y]) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(edge).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the token files and describe them as read back.

    Null or empty text: the one id end_id. Null doc_id comes before all others. Rows of equal doc_id are ordered by text and
    each has its own place. An empty table gives empty files and no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id)
    return describe_tokens(read_tokens(spark, path))


def op9_token_file(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
