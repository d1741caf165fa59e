"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skewlake.llm import decontaminate, langid, ngram_join, packing, substring_dedup
from skewlake.llm.common import shared_dir


#: Text that one task of the deduplicating stages takes. Workers live on from stage to stage, so each stage keeps its memory low.
BLOCK_BYTES = 4 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or told with too low a score go."""
    return langid.keep_known(docs)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one(docs, size=5, percent=80, block_bytes=BLOCK_BYTES)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document with a smaller doc_id has are cut out."""
    return substring_dedup.dedup_substrings(docs, carry=True, block_bytes=BLOCK_BYTES)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat an item of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_words=False)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", join_ngrams),
    ("substring_dedup", dedup_substrings),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

#: Language ID and tokenisation aren't SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
