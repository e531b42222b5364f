"""Join helpers that keep broadcasts bounded and hot keys split.

* ``broadcast_checked``: broadcast a side only after measuring it; beyond the
  bound the plain join is kept (sort-merge, with AQE skew splitting).
* ``skew_safe_lookup``: join a big fact table with a lookup table that has one
  row per key and a known frequency of that key in the fact table.  The most
  frequent keys, as many as a measured byte bound holds, are broadcast and the
  fact rows carrying them never shuffle: a lookup table within the bound is
  broadcast whole.  Only the rows of the rarer keys go through a shuffle join,
  where none of them is frequent enough to unbalance it.
* ``lookup_lists``: the same lookup for the keys of an array column, without
  a row per key: frequent keys are looked up where the array lies, and only
  arrays that hold rarer ones are exchanged, with those keys.
* ``dense_index``: a gap-free 0-based rank over a total order without a
  single-partition window (range partitioning + per-partition offsets).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.session import materialize

# Broadcast bound for measured sides (bytes of key/value payload).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Keys of an array column that a task gathers for one lookup (and one batch more).
KEYS_AT_ONCE = 1 << 22


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row."""
    per_row = F.lit(16 + 8 * sum(not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType)) for f in df.schema.fields))
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            per_row = per_row + F.coalesce(F.size(c), F.lit(0)) * F.lit(8)
    return per_row


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of a DataFrame, in one aggregation job."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return int(row["n"] or 0), int(row["b"] or 0)


def broadcast_checked(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size is within ``max_bytes``."""
    _, nbytes = measured_size(df)
    return F.broadcast(df) if nbytes <= max_bytes else df


def hot_frequency(lookup: DataFrame, freq_col: str, max_bytes: int) -> int:
    """The lowest power of two such that the keys of at least this frequency fit
    into ``max_bytes``; 0 if the whole table does.  One job; its result has a
    row per power of two."""
    level = F.floor(F.log2(F.greatest(F.col(freq_col), F.lit(1)))).cast("int")
    sizes = (lookup.select(level.alias("level"), row_bytes(lookup).alias("b"))
             .groupBy("level").agg(F.sum("b").alias("b")).collect())
    total, at_least = 0, None
    for r in sorted(sizes, key=lambda r: -(r["level"] or 0)):
        total += r["b"]
        if total > max_bytes:
            return 1 << 62 if at_least is None else at_least
        at_least = 1 << (r["level"] or 0)
    return 0


def skew_safe_lookup(big: DataFrame, lookup: DataFrame, key: str, freq_col: str,
                     how: str = "inner", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with a unique-key ``lookup`` whose ``freq_col`` counts the
    rows of ``big`` per key.  Output has the columns of ``big`` and ``lookup``
    (without ``freq_col``).  ``how`` is ``inner`` or ``left``.  ``lookup`` is read
    once to measure it, so hand over one that is cheap to compute."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    at_least = hot_frequency(lookup, freq_col, max_bytes)
    if not at_least:
        return big.join(F.broadcast(lookup.drop(freq_col)), key, how)
    is_hot = F.coalesce(F.col(freq_col) >= at_least, F.lit(False))
    hot, cold = lookup.filter(is_hot).drop(freq_col), lookup.filter(~is_hot).drop(freq_col)
    hot_part = big.join(F.broadcast(hot), key, "inner")
    cold_part = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return hot_part.unionByName(cold_part)


def list_slices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, offsets of their lists ``name`` in the flattened values), the batches
    gathered to KEYS_AT_ONCE values or a batch more; null lists are empty."""
    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        lengths = pc.fill_null(pc.list_value_length(part.column(name)), 0).to_numpy(zero_copy_only=False)
        held.clear()
        return part, np.append(0, np.cumsum(lengths.astype(np.int64)))

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.list_value_length(batch.column(name))).as_py() or 0
        if size >= KEYS_AT_ONCE:
            yield joined()
            size = 0
    if held:
        yield joined()


def lookup_lists(rows: DataFrame, name: str, lookup: DataFrame, key: str, value: str, freq_col: str,
                 null_key: str | None = None, max_bytes: int | None = None) -> DataFrame:
    """``rows`` with the array ``name`` of keys replaced by the array of their values
    in the unique-key ``lookup``, whose ``freq_col`` counts a key's uses; null where a
    key is not listed.  A null array gives an empty one, and a null in it stands for
    ``null_key``.

    The keys of highest frequency, as many as ``max_bytes`` hold, are looked up
    batch by batch where the arrays lie.  Arrays that hold rarer keys are written
    once; those keys are joined and come back to their rows.  ``lookup`` is read up
    to three times, so hand over one that is cheap to compute."""
    at_least = hot_frequency(lookup, freq_col, MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)
    is_hot = F.coalesce(F.col(freq_col) >= at_least, F.lit(False)) if at_least else F.lit(True)
    hot = lookup.filter(is_hot).select(key, value).toArrow()  # within max_bytes
    sent = rows.sparkSession.sparkContext.broadcast(tuple(hot.column(c).combine_chunks() for c in (key, value)))
    kept = [c for c in rows.columns if c != name]
    types = lookup.schema
    rare = [T.StructField("_rare", T.ArrayType(types[key].dataType))] if at_least else []
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(name, T.ArrayType(types[value].dataType)), *rare])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = sent.value
        for part, offsets in list_slices(batches, name):
            flat = part.column(name).flatten()
            flat = flat if null_key is None else pc.fill_null(flat, null_key)
            at = pc.fill_null(pc.index_in(flat, value_set=keys), -1).to_numpy(zero_copy_only=False)
            ends = pa.array(offsets, pa.int32())
            out = [pa.ListArray.from_arrays(ends, values.take(pa.array(at, mask=at < 0)))]
            if rare:
                open_ = (at < 0) & flat.is_valid().to_numpy(zero_copy_only=False)
                some = np.diff(np.append(0, np.cumsum(open_))[offsets]) > 0
                asked = flat.take(pa.array(np.arange(len(flat)), mask=~open_))
                out.append(pa.ListArray.from_arrays(ends, asked, mask=pa.array(~some)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *out], names=schema.names)

    found = rows.select(*kept, name).mapInArrow(run, schema)
    if not at_least:
        return found.select(*rows.columns)
    found = materialize(found.withColumn("_row", F.monotonically_increasing_id()), "looked-up")
    open_rows = found.filter(F.col("_rare").isNotNull())
    asked = open_rows.select("_row", F.explode(F.array_compact(F.array_distinct("_rare"))).alias(key))
    cold = asked.join(lookup.filter(~is_hot).select(key, value), key).groupBy("_row").agg(
        F.map_from_entries(F.collect_list(F.struct(key, value))).alias("_cold"))
    filled = open_rows.join(cold, "_row", "left").withColumn(
        name, F.zip_with(name, "_rare", lambda v, k: F.coalesce(v, F.col("_cold")[k])))
    return found.filter(F.col("_rare").isNull()).select(*rows.columns).unionByName(filled.select(*rows.columns))


def dense_index(df: DataFrame, order_cols: list[str], name: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """Add a 0-based gap-free position in the order of ``order_cols`` (which
    must be a total order).  Range partitioning balances the work; only the
    per-partition row counts (one row per partition) are combined in order.
    The result is checkpointed so the positions are fixed."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    tagged = (tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
                    .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    # one count per partition (bounded by the partition count), combined in
    # order on the driver - the same bookkeeping RDD.zipWithIndex does
    counts = sorted((r["_pid"], r["_cnt"]) for r in
                    tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect())
    rows, acc = [], 0
    for pid, cnt in counts:
        rows.append((pid, acc))
        acc += cnt
    offsets = spark.createDataFrame(rows, "_pid long, _off long")
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_loc")).cast("long")).drop(
        "_mid", "_pid", "_loc", "_off")


def prefix_sum(df: DataFrame, order_cols: list[str], size_col: str, group_cols: list[str] | None = None,
               name: str = "start", partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of ``size_col`` within ``group_cols`` in the total
    order ``order_cols``, without a window over a whole group: rows are range
    partitioned, each partition sums locally, and only one row per
    (partition, group) is combined in order."""
    spark = df.sparkSession
    groups = group_cols or []
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *groups, *order_cols).sortWithinPartitions(*groups, *order_cols)
    tagged = materialize(ranged.withColumn("_pid", F.spark_partition_id()))
    local_w = (Window.partitionBy("_pid", *groups).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.withColumn("_loc", F.coalesce(F.sum(size_col).over(local_w), F.lit(0)))
    totals = tagged.groupBy("_pid", *groups).agg(F.sum(size_col).alias("_tot"))
    # one row per (partition, group): bounded by partitions x groups present
    off_w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *groups, F.coalesce(F.sum("_tot").over(off_w), F.lit(0)).alias("_off"))
    out = local.join(offsets, ["_pid", *groups])
    return out.withColumn(name, (F.col("_off") + F.col("_loc")).cast("long")).drop("_pid", "_loc", "_off")
