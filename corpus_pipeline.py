"""Training-data pipeline over `documents`: quality rules, line dedup, n-gram
Jaccard join, mixing, SentencePiece encoding and decoding.

Every stage is a function (spark, docs, sf_dir) -> DataFrame whose result is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents; the last adds ids, n_tokens and round_trip, the
check that the ids decode to the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import linededup, mixing, ngramjoin, quality, sentencepieces
from tessera.llm.common import SPACE, spare_name, table
from tessera.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or a learned rule rejects go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts and n_chars follows; documents
    that lose their last word by it go."""
    removed = spare_name(docs, "removed")
    cut = linededup.line_dedup(docs, removed_col=removed)
    empty = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, "") == ""
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.where((F.col(removed) == 0) | ~empty).withColumn("n_chars", n_chars).drop(removed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that of the lowest id."""
    return ngramjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the raked mixture takes."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it again.  A table with
    columns of these names keeps them; the new ones get spare names then."""
    out = sentencepieces.encode(docs, sentencepieces.load())
    made, taken = F.col(f"`{out.columns[-1]}`"), {c.lower() for c in docs.columns}
    new = [made[n].alias(spare_name(docs, n) if n in taken else n) for n in ("ids", "n_tokens", "round_trip")]
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *new)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix_sources), ("SentencePiece encoding", encode)]

#: SQL can't express learned rules, raked weights or SentencePiece.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
