"""The driver's parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Tables whose rows carry long texts: row-local work on them is spread over
# the cluster even when the file has a single split.
TEXT_TABLES = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"], "pages": ["page_id"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def turn_id(conversations: DataFrame) -> Column:
    """One number for (conv_id, turn): a scalar subquery takes the number of
    turns from the table, so no two turns share an id."""
    n_turns = conversations.select(F.max("turn") + 1).scalar()
    return F.col("conv_id") * n_turns + F.col("turn")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch queries: ``benchmark(item_id, text)`` -> ``(query_id, text)``."""
    return table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text")
