"""Operator 9 [native]: shuffled shards by a two-pass external shuffle.

Pass one scatters the records by seeded hashes: the shard by rendezvous hashing
of the document id (law ``key``: id and shard count decide, one more shard takes
rows only into itself), and inside a shard a bucket of bounded size.  Pass two
gathers one bucket at a time, puts it into Fisher-Yates order (Spark's
``shuffle`` of an array) and writes it.  Memory is bounded by the bucket size,
whatever the size of a shard: a task gathers at most 128 buckets at a time (Spark's
object aggregate sorts beyond that) and permutes one.  The slots of a shard follow
from a running sum of the buckets' counts.

Defined results: a null text has size 1 and the checksum of no bytes; a null id
is hashed like a value of its own; rows that repeat an id share its shard but
not its bucket, as the input split is part of the bucket's hash; an empty table
gives no rows.  Other columns travel along under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import spare_name
from tessera.session import scratch_path

N_SHARDS = 16
#: Mean bytes of text in a bucket, which one task holds in memory.
BUCKET_BYTES = 4 << 20
SEED = 20240229


def rendezvous(doc_id: Column, n_shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the id is highest."""
    scores = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), doc_id).alias("h"), F.lit(s).alias("s"))
              for s in range(n_shards)]
    return F.array_max(F.array(*scores))["s"]


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, id_col: str = "doc_id",
                 text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Writes `docs` under `path`, a folder per shard (``shard=K``), each file's
    rows in slot order, and reads it back with a struct column that holds size,
    text_crc32, bucket, place (in the bucket), shard, slot and grown_shard."""
    spark = docs.sparkSession
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    total = docs.agg(F.sum(text_bytes(text))).first()[0] or 0
    n_buckets = max(1, -(-total // (n_shards * bucket_bytes)))

    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scattered = docs.select(
        rendezvous(doc_id, n_shards, seed).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), doc_id, F.spark_partition_id()), F.lit(n_buckets)).alias("bucket"),
        F.struct(
            F.xxhash64(F.lit(seed + 2), doc_id, text).alias("order"),
            (text_bytes(text) + 1).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            rendezvous(doc_id, n_shards + 1, seed).alias("grown_shard"),
            record.alias("record")).alias("item"))
    # a fixed order before the seeded permutation: a retried task writes the same slots
    buckets = scattered.groupBy("shard", "bucket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    placed = (buckets.select("shard", "bucket", F.posexplode(F.shuffle("items", seed)).alias("place", "item"))
              .select("shard", "bucket", F.col("place").cast("long"), "item.*").drop("order"))
    placed.write.partitionBy("shard").parquet(path)

    written = spark.read.schema(placed.schema).parquet(path)
    counts = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    # one row per bucket: a running sum of totals, whatever the number of records
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    info = spare_name(docs, "shard_info")
    return written.join(offsets, ["shard", "bucket"]).select("record.*", F.struct(
        "size", "text_crc32", "bucket", "place", "shard", (F.col("offset") + F.col("place")).alias("slot"),
        "grown_shard").alias(info))


def shard_digest(docs: DataFrame) -> DataFrame:
    """The shards' index: a row per document, without its text."""
    written = write_shards(docs.select("doc_id", "text"), scratch_path(docs.sparkSession, "shards"))
    return written.select("doc_id", f"{written.columns[-1]}.*").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
