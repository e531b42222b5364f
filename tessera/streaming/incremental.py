"""Incremental term counts over arriving documents (optional extension of
the incremental build, SURVEY 2.13 / B5).

Per-document term counts (E1) are append-only, so each micro-batch of new
documents is tokenised and counted and its rows are appended to a Parquet
table; document and collection frequencies (E3) and the collection size
are re-aggregations of that table.  The query is exactly-once through the
checkpoint location and the idempotent per-batch output folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import stats

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def start_term_counts(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                      glob: str = "*.parquet", schema: str = DOC_SCHEMA, available_now: bool = True,
                      max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tok = stats.tokenize(batch.select("doc_id", "text"))
        counts = stats.term_counts(tok).withColumn("batch_id", F.lit(batch_id))
        lengths = stats.doc_lengths(tok).withColumn("batch_id", F.lit(batch_id))
        # one folder per batch id: a replayed batch overwrites its own output
        counts.write.mode("overwrite").parquet(f"{sink_dir}/counts/batch_id={batch_id}")
        lengths.write.mode("overwrite").parquet(f"{sink_dir}/lengths/batch_id={batch_id}")

    w = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def term_stats(spark: SparkSession, sink_dir: str) -> DataFrame:
    """(term, df, cf) over everything indexed so far."""
    counts = spark.read.parquet(f"{sink_dir}/counts")
    return stats.term_stats(counts)


def collection_stats(spark: SparkSession, sink_dir: str) -> DataFrame:
    """(n_docs, avgdl) over everything indexed so far."""
    lens = spark.read.parquet(f"{sink_dir}/lengths")
    return lens.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.col("dl").cast("double")).alias("avgdl"))
