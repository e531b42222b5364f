"""Queries of the operators in this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (linecrf, linededup, mixing, ngramjoin, ppm, prefixtrie, quality, sentencepieces, sharding, structure,
                         substrings, topk, toxicity)
from tessera.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, f = quality.judge(docs, table(spark, sf_dir, "labels"), drop_text=True)
    return judged.select("doc_id", f"{f}.*")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.line_dedup(docs, removed_col="n_removed")


SQL["op4_line_dedup"] = linededup.ORACLE


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digest(table(spark, sf_dir, "documents"))


@query
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


SQL["op5_exact_topk"] = topk.ORACLE


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.link_components(table(spark, sf_dir, "documents"))


SQL["op10_ngram_jaccard_join"] = ngramjoin.ORACLE


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.digest(table(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.digest(table(spark, sf_dir, "conversations"))


SQL["op11_prefix_trie"] = prefixtrie.ORACLE


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.digest(table(spark, sf_dir, "conversations"))


SQL["op13_structure_repair"] = structure.ORACLE


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linecrf.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
