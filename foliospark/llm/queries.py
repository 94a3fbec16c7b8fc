"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, ctw, decontam, exact_dedup, ngram_join, packing, sharding, toxicity, url_filters, warc
from .common import table
from .oracle import ORACLE


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers as lines of text."""
    found = warc.resolve(warc.records_of_pages(table(spark, sf_dir, "pages")))
    return found.selectExpr("record_id", "url_key", "ts", "response_id", "outcome", "digest", "array_join(transform(headers, h -> concat(h.name, ': ', h.value)), '\n') AS headers")


def op4_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.calls_of_conversations(table(spark, sf_dir, "conversations"))
    return chat.link(calls, results, chat.TOOLS).selectExpr("conv_id", "call_id", "turn", "name", "status", "result_turn", "content", "level", "position", "valid", "array_join(errors, '; ') AS errors", "arguments")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_toxicity, op3_warc_revisits, op4_chat_tool_calls, op5_decontamination, op6_best_fit_packing, op7_exact_dedup, op8_sharding, op9_ngram_jaccard, op10_context_tree)}

__all__ = ["ORACLE", "QUERIES"]
