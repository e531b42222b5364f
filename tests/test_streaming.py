"""Incremental term counts: two arrivals give the same statistics as one
batch over all documents."""

from tessera.operators import stats
from tessera.streaming import incremental


def test_incremental_equals_batch(spark, tmp_path):
    import pandas as pd

    src = tmp_path / "in"
    src.mkdir()
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    rows1 = [(0, "a b a", "en", "s", 5), (1, "b c", "en", "s", 3)]
    rows2 = [(2, "c c d", "en", "s", 5)]
    pd.DataFrame(rows1, columns=cols).to_parquet(src / "p1.parquet")
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    incremental.start_term_counts(spark, str(src), sink, ck, glob="*.parquet",
                                  schema=incremental.DOC_SCHEMA).awaitTermination()
    pd.DataFrame(rows2, columns=cols).to_parquet(src / "p2.parquet")
    incremental.start_term_counts(spark, str(src), sink, ck, glob="*.parquet",
                                  schema=incremental.DOC_SCHEMA).awaitTermination()
    got = sorted(tuple(r) for r in incremental.term_stats(spark, sink).collect())
    allrows = spark.createDataFrame(rows1 + rows2, incremental.DOC_SCHEMA)
    exp = sorted(tuple(r) for r in stats.term_stats(stats.term_counts(stats.tokenize(allrows))).collect())
    assert got == exp
    assert incremental.collection_stats(spark, sink).first().n_docs == 3


def test_stream_query_reads_single_files_and_folders_of_parts(spark, tmp_path):
    from tessera.plans.catalog_store import q_stream_term_stats

    docs = spark.createDataFrame([(k, f"cat w{k} cat", "en", "web", 9) for k in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "parts" / "documents.parquet"))
    (tmp_path / "single").mkdir()
    docs.toPandas().to_parquet(tmp_path / "single" / "documents.parquet")
    want = {("cat", 6, 12)} | {(f"w{k}", 1, 1) for k in range(6)}
    for name in ("parts", "single"):
        assert {(r.term, r.df, r.cf) for r in q_stream_term_stats(spark, str(tmp_path / name)).collect()} == want
