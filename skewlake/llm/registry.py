"""Queries over the numbered operators, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, knn, langid, lexical, ngram_join, packing, repair, simhash, substring_dedup, token_count, token_file, tool_calls, warc


def _on(table: str, f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": lambda spark, d: decontaminate.op1_decontamination(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")),
        "op2_token_count": _on("documents", token_count.op2_token_count),
        "op3_tool_calls": _on("conversations", tool_calls.op3_tool_calls),
        "op4_substring_dedup": _on("documents", substring_dedup.op4_substring_dedup),
        "op5_exact_topk": _on("embeddings", knn.op5_exact_topk),
        "op6_ngram_join": _on("documents", ngram_join.op6_ngram_join),
        "op7_packing": _on("documents", packing.op7_packing),
        "op8_warc": _on("pages", warc.op8_warc),
        "op9_token_file": _on("documents", token_file.op9_token_file),
        "op10_language_id": _on("documents", langid.op10_language_id),
        "op11_lexical_search": lambda spark, d: lexical.op11_lexical_search(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")),
        "op12_conversation_repair": _on("conversations", repair.op12_conversation_repair),
        "op13_simhash_groups": _on("documents", simhash.op13_simhash_groups),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontaminate.SQL,
        "op3_tool_calls": tool_calls.SQL,
        "op4_substring_dedup": substring_dedup.SQL,
        "op5_exact_topk": knn.SQL,
        "op6_ngram_join": ngram_join.SQL,
        "op8_warc": warc.SQL,
        "op11_lexical_search": lexical.SQL,
    }
