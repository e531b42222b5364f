"""Join helpers: hot/cold split equals a plain join; dense index and prefix
sums equal their single-partition definitions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators import joins


def test_skew_safe_lookup_equals_plain_join(spark):
    # key 0 holds a third of the rows, keys 1..40 the rest; key 99 has no lookup row
    big = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1 + i % 40) for i in range(600)] + [(1000, 99)],
                                "id long, k long")
    freq = big.groupBy("k").agg(F.count(F.lit(1)).alias("freq"))
    lookup = freq.filter("k <> 99").withColumn("v", F.col("k") * 10)
    # bounds that hold nothing, the hottest key and the whole table
    for how in ("inner", "left"):
        for max_bytes in (10, 60, 1 << 20):
            got = joins.skew_safe_lookup(big, lookup, "k", "freq", how=how, max_bytes=max_bytes)
            exp = big.join(lookup.drop("freq"), "k", how)
            assert sorted(map(tuple, got.select("id", "k", "v").collect())) == \
                sorted(map(tuple, exp.select("id", "k", "v").collect()))
    assert joins.hot_frequency(lookup, "freq", 60) == 128  # key 0 alone, 200 rows
    assert joins.hot_frequency(lookup, "freq", 10) > 200 and joins.hot_frequency(lookup, "freq", 1 << 20) == 0


def test_only_rows_of_rare_keys_are_shuffled(spark):
    big = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, id) AS k")
    lookup = big.groupBy("k").agg(F.count(F.lit(1)).alias("freq"))
    plan = joins.skew_safe_lookup(big, lookup, "k", "freq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    plan = joins.skew_safe_lookup(big, lookup, "k", "freq", max_bytes=60)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("Join") == 3


def test_dense_index_and_prefix_sum(spark):
    df = spark.createDataFrame([(i * 7 % 101, (i % 5) + 1, i % 3) for i in range(101)], "key long, size long, g int")
    got = {r.key: r.idx for r in joins.dense_index(df, ["key"], "idx", partitions=5).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}
    ps = joins.prefix_sum(df, ["key"], "size", ["g"], "start", partitions=4)
    w = Window.partitionBy("g").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("start", F.coalesce(F.sum("size").over(w), F.lit(0)))
    assert sorted(map(tuple, ps.select("key", "start").collect())) == sorted(map(tuple, exp.select("key", "start").collect()))


def test_broadcast_checked_respects_bound(spark):
    df = spark.range(100).withColumn("s", F.lit("x" * 100))
    small = joins.broadcast_checked(df, max_bytes=1 << 30)
    big = joins.broadcast_checked(df, max_bytes=10)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


@pytest.mark.parametrize("max_bytes", [1, 60, None])
def test_lookup_lists_of_frequent_and_rare_keys(spark, max_bytes):
    """Rows, orders, nulls and unlisted keys, wherever the frequent keys end; keys
    of rows with frequent ones only are never exchanged."""
    rows = [(1, ["a", "b", "a"]), (1, ["c", None, "x"]), (2, []), (None, None), (3, ["b"]), (4, ["c", "a", "c"])]
    values = {"a": 10, "b": 20, "c": 30}
    lookup = spark.createDataFrame([("a", 10, 30), ("b", 20, 20), ("c", 30, 1)], "k string, v int, n long")
    df = spark.createDataFrame(rows, "id int, keys array<string>")
    out = joins.lookup_lists(df, "keys", lookup, "k", "v", "n", null_key="b", max_bytes=max_bytes)
    assert out.columns == ["id", "keys"]
    want = [(i, [values.get("b" if k is None else k) for k in x or []]) for i, x in rows]
    assert sorted(map(repr, ((r["id"], r["keys"]) for r in out.collect()))) == sorted(map(repr, want))


def test_lookup_lists_gathers_batches(spark, monkeypatch):
    monkeypatch.setattr(joins, "KEYS_AT_ONCE", 5)
    lookup = spark.range(50).selectExpr("id AS k", "CAST(id * 2 AS STRING) AS v", "1L AS n")
    df = spark.range(40).selectExpr("id", "slice(sequence(0L, id), 1, CAST(id % 4 AS INT)) AS keys")
    out = {r["id"]: r["keys"] for r in joins.lookup_lists(df, "keys", lookup, "k", "v", "n").collect()}
    assert out == {i: [str(2 * k) for k in range(min(i % 4, i + 1))] for i in range(40)}
