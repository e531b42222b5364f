"""Ordered turns of conversations, without a task that holds a conversation.

A conversation may hold a third of all rows, so positions and running values are
not computed by a window over it: rows are range partitioned in order, each
partition works on its own slice, and one row per (partition, conversation)
carries the totals on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.joins import prefix_sum
from tessera.session import materialize


def numbered(rows: DataFrame, key: str, order: list[str], name: str = "pos") -> DataFrame:
    """`rows` with their 0-based position within `key` in the total order `order`."""
    return prefix_sum(rows.withColumn("_one", F.lit(1)), order, "_one", [key], name).drop("_one")


def running(rows: DataFrame, key: str, order: str, xors: list[str], sums: list[str]) -> DataFrame:
    """`rows` with inclusive running values within `key`: ``run_X`` is the XOR
    (the sum) of the column X up to and with this row."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, key, order).sortWithinPartitions(key, order)
    cut = materialize(ranged.withColumn("_part", F.spark_partition_id()), "running")
    whole: dict[str, tuple] = {c: (F.bit_xor, lambda a, b: a.bitwiseXOR(b)) for c in xors}
    whole |= {c: (F.sum, lambda a, b: a + b) for c in sums}
    slices = cut.groupBy(key, "_part").agg(*[f(c).alias(c) for c, (f, _) in whole.items()])
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(key, "_part", *[F.coalesce(f(c).over(before), F.lit(0)).alias(f"_carry_{c}")
                                            for c, (f, _) in whole.items()])
    so_far = Window.partitionBy(key, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[f(c).over(so_far).alias(f"_local_{c}") for c, (f, _) in whole.items()])

    def joined(c: str, add) -> Column:
        return add(F.col(f"_local_{c}"), F.col(f"_carry_{c}")).alias(f"run_{c}")

    return local.join(carried, [key, "_part"]).select(*rows.columns, *[joined(c, add) for c, (_, add) in whole.items()])


#: DuckDB expression for the unsigned crc32 of a text of ASCII characters.
CRC32_SQL = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda i: 0::UBIGINT)),
    lambda r, z: CASE WHEN r & 1::UBIGINT = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)), 4294967295::UBIGINT)::BIGINT"""
