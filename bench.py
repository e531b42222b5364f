"""Bench: index build and batch search at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries":
{stage: seconds}, "sf", ...}.  Each index is written once (as a deployment
would) and searches run against the written index with the 200 (sf0.1)
benchmark texts as one batch of queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.functions.text import word_tokens  # noqa: E402
from tessera.operators import corpus, dense, encoders, lexical, lmprep, stats  # noqa: E402
from tessera.plans import catalog_dense  # noqa: E402
from tessera.session import get_spark, scratch_path  # noqa: E402
from tessera.sources.tables import benchmark_queries, documents, table  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    os.environ.setdefault("BENCH_CPUS", str(cpus))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=parts)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))
    docs = documents(spark, sf_dir)
    queries = benchmark_queries(spark, sf_dir)
    times: dict[str, list[float]] = {}

    def timed(name, fn):
        t = time.time()
        fn()
        times.setdefault(name, []).append(time.time() - t)

    # warm-up (JIT, class loading) on the small benchmark table, not timed
    stats.term_counts(stats.tokenize(queries.withColumnRenamed("query_id", "doc_id"))).collect()
    for _ in range(runs):
        root = scratch_path(spark, "bench")
        # one preprocessed collection (token counts + text keys) feeds every model
        coll = lexical.Collection(docs)
        timed("token_table", lambda: (coll.documents, coll.term_stats))
        timed("bm25_index", lambda: lexical.save_lexical(lexical.build_lexical(coll, "bm25"), f"{root}/bm25"))
        timed("tfidf_index", lambda: lexical.save_lexical(lexical.build_lexical(coll, "tfidf"), f"{root}/tfidf"))

        def ft_index():
            wv, dv = dense.fasttext_model(coll, table(spark, sf_dir, "embeddings"))
            wv.write.parquet(f"{root}/wv")
            dv.write.parquet(f"{root}/ft")

        timed("fasttext_index", ft_index)
        timed("sentence_index", lambda: encoders.sentence_vectors(docs).write.parquet(f"{root}/bert"))
        timed("contextual_index", lambda: dense.mixed_pool(
            dense.token_vectors_from_embeddings(table(spark, sf_dir, "embeddings")),
            catalog_dense.weights_table(spark)).write.parquet(f"{root}/elmo"))
        timed("level_counts", lambda: corpus.level_counts(
            corpus.group_counts(table(spark, sf_dir, "documents"), "lang", "source", word_tokens("text")))
            .write.parquet(f"{root}/levels"))
        timed("lm_batches", lambda: lmprep.lm_batches(
            lmprep.encode(*(lambda s: (s, lmprep.build_vocab(s, 5000)))(lmprep.sentences(docs))), 1, 20)
            .write.parquet(f"{root}/lm"))
        bm = lexical.load_lexical(spark, f"{root}/bm25", "bm25")
        tf = lexical.load_lexical(spark, f"{root}/tfidf", "tfidf")
        timed("bm25_search", lambda: lexical.search(bm, queries, 10).collect())
        timed("tfidf_search", lambda: lexical.search(tf, queries, 10).collect())
        ft, wv = spark.read.parquet(f"{root}/ft"), spark.read.parquet(f"{root}/wv")
        timed("fasttext_search", lambda: dense.cosine_topk(
            ft, dense.text_vectors(queries, wv, wv.select(F.max(F.size("vec"))).first()[0], "query_id").withColumnRenamed("doc_id", "query_id"),
            10).collect())

    med = {k: sorted(v)[len(v) // 2] for k, v in times.items()}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "index_build_and_batch_search", "value": round(sum(med.values()), 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in med.items()},
                      "sf": float(sf.group(1)) if sf else None, "runs": runs, "cpus": cpus,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
