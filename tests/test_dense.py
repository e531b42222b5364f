"""Vector rules S13-S15, S25 and the brute-force top-k against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import vectors as vx
from tessera.operators import dense, stats
from tests.conftest import docs_df


def test_cosine_topk_matches_numpy(spark):
    rng = np.random.default_rng(1)
    items = rng.normal(size=(300, 8)).astype(np.float32)
    items[5] = 0  # zero vector: no distance (S13)
    qs = rng.normal(size=(4, 8)).astype(np.float32)
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "doc_id long, vec array<float>")
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(qs)], "query_id long, vec array<float>")
    got = dense.cosine_topk(idf, qdf, 7).collect()
    x, q = items.astype(np.float64), qs.astype(np.float64)
    for j in range(4):
        with np.errstate(invalid="ignore", divide="ignore"):
            d = 1 - (x @ q[j]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(q[j]))
        ok = [i for i in np.argsort(d, kind="stable") if not np.isnan(d[i])][:7]
        mine = [r.doc_id for r in sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)]
        assert mine == ok
        assert 5 not in mine


def test_cosine_distance_null_for_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>")
    rows = df.select(vx.cosine_distance("a", "b").alias("d")).collect()
    assert rows[0].d is None and rows[1].d == pytest.approx(1.0)


def test_s14_s15_mean_divides_by_all_tokens(spark):
    wv = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vec array<float>")
    d = docs_df(spark, ["a b oov oov", "", "oov"])
    tok = stats.tokenize(d)
    out = {r.doc_id: r.vec for r in dense.mean_word_vectors(stats.term_counts(tok), stats.doc_lengths(tok), wv,
                                                              F.lit(2)).collect()}
    assert out[0] == pytest.approx([0.25, 0.5])
    assert out[1] == [0.0, 0.0] and out[2] == [0.0, 0.0]


def test_layer_mix_softmax_and_norm(spark):
    tv = spark.createDataFrame([(0, l, p, [float(l + 1), float(p)]) for l in range(2) for p in range(3)],
                               "sent_id long, layer int, pos int, vec array<float>")
    w = spark.createDataFrame([(0, 0.0), (1, 0.0)], "layer int, w double")
    mixed = {r.pos: r.vec for r in dense.layer_mix(tv, w).collect()}
    assert mixed[2] == pytest.approx([1.5, 2.0])
    ln = dense.layer_norm(tv, F.lit(0)).filter("layer = 0").select(F.explode("vec").alias("v"))
    vals = [r.v for r in ln.collect()]
    assert np.mean(vals) == pytest.approx(0.0, abs=1e-9) and np.var(vals) == pytest.approx(1.0, rel=1e-6)


def test_s25_token_similarity_last_occurrence(spark):
    wv = spark.createDataFrame([("q", [1.0, 0.0]), ("a", [2.0, 0.0]), ("b", [0.0, 1.0])], "word string, vec array<float>")
    toks = spark.createDataFrame([(0, 0, "q"), (1, 0, "a"), (1, 1, "b"), (1, 2, "a")], "sent_id long, pos int, word string")
    rows = {(r.word, r.pos, r.rank) for r in dense.token_similarity(toks, wv).collect()}
    assert rows == {("a", 2, 1), ("b", 1, 2)}


@pytest.mark.parametrize("dim", [1, 3, 400])
def test_vector_sum_of_any_dimension(spark, dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(20, dim)).astype(np.float32)
    df = spark.createDataFrame([(k % 3, v.tolist()) for k, v in enumerate(x)], "g long, v array<float>")
    got = {r.g: r.vec for r in dense.vector_sum(df, ["g"], F.col("v")).collect()}
    assert all(got[g] == pytest.approx(x[g::3].astype(np.float64).sum(axis=0)) for g in range(3))


def test_mixed_pool_equals_mix_then_pool(spark):
    rng = np.random.default_rng(4)
    tv = spark.createDataFrame([(s, l, p, rng.normal(size=5).tolist()) for s in range(4) for l in range(3) for p in range(s + 1)],
                               "sent_id long, layer int, pos int, vec array<double>")
    w = spark.createDataFrame([(0, 0.3), (1, -1.0), (2, 2.0)], "layer int, w double")
    want = {r.sent_id: r.vec for r in dense.mean_pool(dense.layer_mix(tv, w, 0.7)).collect()}
    fused = dense.mixed_pool(tv, w, 0.7)
    got = {r.sent_id: r.vec for r in fused.collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_cosine_topk_over_blocks_ties_and_odd_rows(spark, monkeypatch):
    """Several blocks of queries, slices of few rows, equal vectors in many groups."""
    monkeypatch.setattr(dense, "BLOCK_NUMBERS", 12)
    monkeypatch.setattr(dense, "HELD_NUMBERS", 21)
    vecs = [[1.0, 0.0, 0.0], [0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]
    items = spark.createDataFrame([(i, vecs[i % 4]) for i in range(120)] + [(500, None)], "doc_id long, vec array<double>")
    queries = spark.createDataFrame([(q, vecs[q % 3]) for q in range(9)] + [(50, None), (51, [0.0, 0.0, 0.0])],
                                    "query_id long, vec array<double>")
    got = {}
    for r in dense.cosine_topk(items, queries, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == {q: [q % 3 + 4 * n for n in range(5)] for q in range(9)}
    assert dense.cosine_topk(items.limit(0), queries, 5).count() == 0
    assert dense.cosine_topk(items, queries.limit(0), 5).count() == 0
    with pytest.raises(Exception, match="dimensions"):
        dense.cosine_topk(items.unionByName(spark.createDataFrame([(900, [1.0])], items.schema)), queries, 5).collect()


def test_softmax_of_large_weights(spark):
    w = spark.createDataFrame([(0, 800.0), (1, 800.0), (2, -5.0)], "layer int, w double")
    assert [round(r.sw, 6) for r in dense.layer_softmax(w).orderBy("layer").collect()] == [0.5, 0.5, 0.0]


@pytest.mark.parametrize("bound", [1 << 28, 100, 0])
def test_mean_vectors_with_words_beyond_the_broadcast(spark, monkeypatch, bound):
    """Broadcast words, joined words and both; ids that come twice or are null."""
    monkeypatch.setattr(dense, "HOT_WORD_BYTES", bound, raising=False)
    rng = np.random.default_rng(2)
    words = {f"w{i}": rng.normal(size=3) for i in range(30)}
    wv = spark.createDataFrame([(w, v.tolist()) for w, v in words.items()], "word string, vec array<double>")
    texts = [(i % 40, [f"w{j}" for j in rng.integers(0, 33, i % 9)]) for i in range(60)] + [(None, ["w1"])]
    tok = spark.createDataFrame(texts, "doc_id long, tokens array<string>")
    in_rows = tok.selectExpr("doc_id", "tokens", "size(tokens) AS dl").select("doc_id", "dl", tx.counted("tokens").alias("terms"))
    for counts in (stats.term_counts(tok), in_rows):
        got = sorted(((r.doc_id is None, r.doc_id or 0), [round(x, 9) + 0.0 for x in r.vec]) for r in dense.mean_word_vectors(
            counts, stats.doc_lengths(tok), wv, 3).collect())
        want = []
        for i, own in texts:
            total = sum((words.get(t, np.zeros(3)) for k, ts in texts if k == i and i is not None for t in ts), np.zeros(3))
            want.append(((i is None, i or 0), [round(float(x), 9) + 0.0 for x in total / max(1, len(own)) * bool(own)]))
        assert [g[0] for g in got] == [w[0] for w in sorted(want)]
        for (_, a), (_, b) in zip(got, sorted(want)):
            assert a == pytest.approx(b, abs=1e-8)
