"""BM25 / TF-IDF rules S1-S12 on hand-made micro tables, checked against a
brute-force Python evaluation of the definitions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.functions.text import counted, word_tokens
from tessera.operators import lexical, stats
from tessera.session import materialize
from tests.conftest import docs_df, queries_df

WORD = re.compile(r"[^\W]+", re.UNICODE)


def toks(t):
    return [w for w in re.findall(r"\w+", t.lower())]


def brute_bm25(texts, k=2.0, b=0.75, mode="document"):
    docs = [toks(t) for t in texts]
    n = len(docs)
    avgdl = sum(len(d) for d in docs) / n
    df = Counter(w for d in docs for w in set(d))
    cf = Counter(w for d in docs for w in d)
    nq = df if mode == "document" else cf
    out = {}
    for i, d in enumerate(docs):
        c = Counter(d)
        for w, cnt in c.items():
            ratio = (n - nq[w] + 0.5) / (nq[w] + 0.5)
            idf = math.log(ratio) if ratio > 0 else None
            if idf is None:
                out[(i, w)] = None
                continue
            tf = cnt / len(d)
            out[(i, w)] = cnt * idf * tf * (k + 1) / (tf + k * (1 - b + b * len(d) / avgdl))
    return out


def brute_search(texts, weights, queries, k=10):
    """Reference semantics: dict keyed by text (first position, last score),
    stable sort by score descending, every document takes part."""
    res = {}
    for qi, q in enumerate(queries):
        qt = set(toks(q))
        by_text = {}
        for i, t in enumerate(texts):
            s = sum((weights.get((i, w)) or 0.0) for w in qt if (i, w) in weights)
            by_text[t] = (by_text[t][0], s) if t in by_text else (i, s)
        ranked = sorted(by_text.values(), key=lambda p: (-round(p[1], 9), p[0]))[:k]
        res[qi] = [(i, round(s, 6)) for i, s in ranked]
    return res


def spark_search(spark, texts, queries, k=10, **opts):
    idx = lexical.build_lexical(docs_df(spark, texts), "bm25", **opts)
    rows = lexical.search(idx, queries_df(spark, queries), k).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    return out


M_DUP = ["alpha beta gamma", "alpha beta gamma", "beta delta"]
M_ZERO = ["red fish", "blue fish", "one two", "three four", "five six"]
M_NEG = ["the cat", "the dog", "the cow", "a bird", "the end"]
M_REPEAT = ["spam spam spam eggs", "eggs ham", "ham"]


def test_s1_duplicates_collapse(spark):
    res = spark_search(spark, M_DUP, ["beta"], k=10)
    assert [d for d, _ in res[0]] == [0, 2]  # copy 1 of text 0 never appears


def test_s3_zero_fill_order(spark):
    w = brute_bm25(M_ZERO)
    exp = brute_search(M_ZERO, w, ["fish", "nothing matches"], k=4)
    got = spark_search(spark, M_ZERO, ["fish", "nothing matches"], k=4)
    assert got == exp
    assert [d for d, _ in got[1]] == [0, 1, 2, 3]


def test_s3_s10_negative_idf_below_zero(spark):
    w = brute_bm25(M_NEG)
    assert w[(0, "the")] < 0  # term in more than half the documents
    exp = brute_search(M_NEG, w, ["the"], k=5)
    got = spark_search(spark, M_NEG, ["the"], k=5)
    assert got == exp
    assert got[0][0] == (3, 0.0)  # the only document without 'the' comes first


def test_s4_s7_repeats(spark):
    w = brute_bm25(M_REPEAT)
    exp = brute_search(M_REPEAT, w, ["spam spam eggs"], k=3)
    assert spark_search(spark, M_REPEAT, ["spam spam eggs"], k=3) == exp


def test_s8_s9_collection_mode_overflow(spark):
    texts = ["x x x x x x", "x y", "z"]  # x occurs 7 times > N + 0.5
    w = brute_bm25(texts, mode="collection")
    assert w[(0, "x")] is None
    got = spark_search(spark, texts, ["x", "y"], k=3, n_qi="collection")
    exp = brute_search(texts, w, ["x", "y"], k=3)
    assert got == exp


def test_s11_empty_document_counts(spark):
    from pyspark.sql import functions as F

    from tessera.operators import stats

    d = docs_df(spark, ["a b", "", "c"])
    tok = stats.tokenize(d)
    row = tok.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("tokens")).alias("avg")).first()
    assert row.n == 3 and row.avg == pytest.approx(1.0)


def test_s12_tfidf_drops_one_letter_and_norms_are_one(spark):
    from pyspark.sql import functions as F

    idx = lexical.build_lexical(docs_df(spark, ["a cat sat", "i am a dog-lover", "cat cat"]), "tfidf")
    terms = {r.term for r in idx.postings.select("term").collect()}
    assert "a" not in terms and "i" not in terms and "lover" in terms
    norms = idx.postings.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(r.n == pytest.approx(1.0) for r in norms)


def test_partitioning_does_not_change_results(spark):
    texts = ["w%d common" % (i % 7) for i in range(40)]
    base = spark_search(spark, texts, ["w3", "common w5"], k=5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = spark_search(spark, texts, ["w3", "common w5"], k=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == one


def test_engine_dispatch_and_unknown_model(spark):
    from tessera.plans.engine import Engine

    eng = Engine(docs_df(spark, M_ZERO))
    assert eng.search("BM25", queries_df(spark, ["fish"]), top=2).count() == 2
    with pytest.raises(KeyError):
        eng.search("nope", queries_df(spark, ["fish"]))


def test_persisted_index_with_bucket_pruning_equals_in_memory(spark, tmp_path):
    texts = ["w%d common x%d" % (i % 7, i % 3) for i in range(30)] + ["", "only zeros here"]
    idx = lexical.build_lexical(docs_df(spark, texts), "bm25")
    lexical.save_lexical(idx, str(tmp_path / "bm25"))
    back = lexical.load_lexical(spark, str(tmp_path / "bm25"), "bm25")
    qs = queries_df(spark, ["w3 x1", "nothing", "common"])
    a = sorted(tuple(r) for r in lexical.search(idx, qs, 6).collect())
    b = sorted(tuple(r) for r in lexical.search(back, qs, 6).collect())
    assert a == b
    plan = lexical.search(back, qs, 6, fill_zero=False)._jdf.queryExecution().executedPlan().toString()
    assert "term_bucket" in plan


def test_index_keeps_its_own_bucket_count(spark, tmp_path, monkeypatch):
    texts = ["w%d common x%d" % (i % 7, i % 3) for i in range(30)]
    idx = lexical.build_lexical(docs_df(spark, texts), "bm25")
    lexical.save_lexical(idx, str(tmp_path / "a"), buckets=5, partitions=4)
    monkeypatch.setattr(lexical, "TERM_BUCKETS", 1024)
    qs = queries_df(spark, ["w3 x1", "common"])
    want = sorted(tuple(r) for r in lexical.search(idx, qs, 6).collect())
    assert sorted(tuple(r) for r in lexical.search(lexical.load_lexical(spark, str(tmp_path / "a")), qs, 6).collect()) == want


def test_a_common_term_is_cut_over_files(spark, tmp_path):
    idx = lexical.build_lexical(docs_df(spark, [f"the t{i}" for i in range(2000)]), "bm25")
    lexical.save_lexical(idx, str(tmp_path / "a"), partitions=4)
    files = spark.read.parquet(str(tmp_path / "a" / "postings")).filter("term = 'the'").select("_metadata.file_path").distinct()
    assert files.count() > 1


def test_c6_query_coercion(spark):
    from tessera.plans.engine import as_queries

    assert [r.text for r in as_queries(spark, "one query").collect()] == ["one query"]
    assert [r.text for r in as_queries(spark, ["a b", ["c", "d"], 7]).orderBy("query_id").collect()] == ["a b", "c d", "7"]


def test_engine_build_all_shares_one_collection(spark):
    from tessera.plans.engine import Engine, as_queries

    eng = Engine(docs_df(spark, M_ZERO))
    assert eng.build_all(["BM25", "Tf-idf"]) == ["bm25", "tfidf"]
    assert eng.index("bm25").doc_keys is eng.index("tf-idf").doc_keys  # keys computed once
    q = as_queries(spark, queries_df(spark, ["fish"]).withColumnRenamed("text", "q"), text="q")
    assert eng.search("tf-idf", q, top=2).count() == 2


def test_cells_shards_and_blocks_give_the_same_results(spark, monkeypatch):
    """Many shards, groups and query blocks against the definition, with terms
    common and rare, weights negative and queries without a match."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(30)], k=rng.randint(0, 12))) for _ in range(700)]
    texts += texts[:40]
    queries = [" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(25)] + ["", "nothing here", "w0", "w0 w1 w2 w3 w4 w29"]
    for mode in ("document", "collection"):
        want = brute_search(texts, brute_bm25(texts, mode=mode), queries, k=10)
        assert spark_search(spark, texts, queries, k=10, n_qi=mode) == want
    monkeypatch.setattr(lexical, "QUERY_BLOCK_BYTES", 300)
    monkeypatch.setattr(lexical, "SHARD_TEXTS", 300)
    assert spark_search(spark, texts, queries, k=10, n_qi="collection") == want


def test_postings_and_queries_travel_packed(spark, monkeypatch):
    """several blocks of many queries, packed in small pieces, give the same
    results; a row of the exchange holds many postings, and blocks are large ones."""
    monkeypatch.setattr(lexical, "MANY_QUERIES", 4)
    monkeypatch.setattr(lexical, "QUERY_BLOCK_BYTES", 300)
    monkeypatch.setattr(lexical, "MANY_BLOCK_BYTES", 900)
    monkeypatch.setattr(lexical, "PACKED_AT_ONCE", 60)
    monkeypatch.setattr(lexical, "SHARD_TEXTS", 300)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(20)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(20)], k=rng.randint(0, 9))) for _ in range(600)]
    queries = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(40)] + ["", "nothing here", "w0"]
    qt = lexical.query_terms(queries_df(spark, queries))
    assert 1 < lexical._query_blocks(qt, True) < lexical._query_blocks(qt, False)
    for mode in ("document", "collection"):
        want = brute_search(texts, brute_bm25(texts, mode=mode), queries, k=10)
        assert spark_search(spark, texts, queries, k=10, n_qi=mode) == want
    rows = spark.createDataFrame([(0, 1, "a", 5, 5, 1.5), (0, 1, "b", 5, 5, 2.0), (0, 1, "a", 7, 7, 0.5), (1, 1, "a", 5, 5, 1.5)],
                                 "cell long, shard long, term string, text_idx long, doc_id long, weight double").coalesce(1)
    packed = rows.mapInArrow(lexical._packing(["term", "text_idx", "doc_id", "weight"]), lexical.PACKED).orderBy("cell").collect()
    assert [(r.cell, r.shard) for r in packed] == [(0, 1), (1, 1)]
    held = lexical._unpacked([lexical.pa.py_buffer(r.packed) for r in packed])
    assert [tuple(r.values()) for r in held.to_pylist()] == [("a", 5, 5, 1.5), ("b", 5, 5, 2.0), ("a", 7, 7, 0.5), ("a", 5, 5, 1.5)]


def test_early_end_of_a_shard_scan_equals_the_full_scan():
    rng = np.random.default_rng(2)
    ended = 0
    for _ in range(400):
        size, k = 400, int(rng.integers(1, 6))
        lists = []
        for n in rng.integers(1, 300, rng.integers(1, 7)):
            at = np.sort(rng.choice(size, n, replace=False))
            lists.append((at, np.round(rng.normal(3.0 / np.sqrt(n) * 5, 0.3 if n < 150 else 1.0, n), 1)))
        full = np.zeros(size)
        hit = np.zeros(size, bool)
        for at, w in lists:
            full[at] += w
            hit[at] = True
        floor = float(rng.choice([-np.inf, 1.0]))
        found, scores, seen = lexical.score_shard(lists, size, k, floor)
        every = sorted(((-round(full[p], 9), p) for p in np.flatnonzero(hit)))[:k]
        mine = sorted((-round(s, 9), p) for p, s in zip(found.tolist(), scores))[:k]
        if seen is None:
            ended += 1
            keep = [x for x in every if -x[0] >= floor]
            assert mine[:len(keep)] == keep and (len(keep) == len(every) or floor > 0)
            assert len([x for x in every if x[0] < 0]) == k or floor > 0
        else:
            assert mine == every and (seen == hit).all()
    assert ended > 50


def test_no_pair_of_query_and_text_is_exchanged(spark):
    """What leaves the cells is bounded by k per query, and what enters them has a
    row per posting, not per query that asks for it."""
    texts = [f"common t{i}" for i in range(500)]
    idx = lexical.build_lexical(docs_df(spark, texts), "bm25")
    plan = lexical.search(idx, queries_df(spark, ["common"] * 40), 3, fill_zero=False)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    # the idf and the batch's terms are looked up per posting
    assert "MapInArrow" in plan and len(joins) == 2 and not any("query_id" in x for x in joins)


def test_tfidf_norms_without_a_window_over_all_postings(spark):
    from tessera.operators import lexical

    docs = spark.createDataFrame([(0, "aa bb aa c"), (1, "aa"), (1, "bb cc"), (2, "c"), (3, None)], "doc_id long, text string")
    post = lexical.tfidf_postings(lexical.Collection(docs))
    assert "Window" not in post._jdf.queryExecution().executedPlan().toString()
    squares = {}
    for r in post.collect():
        squares[r.doc_id] = squares.get(r.doc_id, 0) + r.weight ** 2
    assert {k: round(v, 9) for k, v in squares.items()} == {0: 1.0, 1: 1.0}


@pytest.mark.parametrize("bound", [None, 150])
def test_lemma_counts_of_rows_that_share_an_id(spark, monkeypatch, bound):
    """forms are looked up and lemmas summed where the documents lie; rows of
    one id are one document, whatever the bound."""
    if bound:
        monkeypatch.setattr("tessera.operators.joins.MAX_BROADCAST_BYTES", bound)
    rows = [(1, "cats cat dogs"), (2, "cats"), (2, "cats dog"), (3, None), (4, ""), (None, "cat"), (5, "odd Cats !")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cats", "kitten"), ("dogs", "dog"), ("odd", "!")], "form string, lemma string")
    coll = lexical.Collection(docs, lemmas=lemmas)
    got = sorted((r["doc_id"] or 0, r["dl"], tuple((t["term"], t["cnt"]) for t in r["terms"])) for r in coll.documents.collect())
    two = (2, 3, (("cat", 2), ("dog", 1)))
    assert got == [(0, 0, ()), (1, 3, (("cat", 2), ("dog", 1))), two, two, (3, 0, ()), (4, 0, ()), (5, 1, (("cat", 1),))]


def test_lemma_counts_exchange_nothing(spark):
    """behind the frequencies of forms, no row per term is exchanged."""
    docs = spark.createDataFrame([(1, "cats cat dogs"), (2, "cats")], "doc_id long, text string")
    rows = materialize(docs.select("doc_id", counted(word_tokens("text")).alias("terms")))
    out = stats.lemma_counts(rows, spark.createDataFrame([("cats", "cat")], "form string, lemma string"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"]: (r["dl"], [(t["term"], t["cnt"]) for t in r["terms"]]) for r in out.collect()} == {
        1: (3, [("cat", 2), ("dogs", 1)]), 2: (1, [("cat", 1)])}


@pytest.mark.parametrize("n_qi", ["document", "collection"])
def test_many_queries_at_once_equal_one_by_one(spark, monkeypatch, n_qi):
    """scores, ties and zero fill of a block scored term by term, over small
    shards and slices; postings without weight take no part."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, weights=[40 // (i + 1) + 1 for i in range(40)], k=rng.randint(0, 9))) for _ in range(700)]
    asked = [" ".join(rng.sample(words, rng.randint(0, 5))) for _ in range(30)] + ["unknown", ""]
    idx = lexical.build_lexical(docs_df(spark, texts), "bm25", n_qi=n_qi)
    qs = queries_df(spark, asked)
    one = lexical.search(idx, qs, k=12).collect()
    monkeypatch.setattr(lexical, "MANY_QUERIES", 1)
    monkeypatch.setattr(lexical, "SCORES_AT_ONCE", 2000)
    many = lexical.search(idx, qs, k=12).collect()
    made = [sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 8)) for r in x) for x in (one, many)]
    assert made[0] == made[1] and len(made[0]) == 12 * len(asked)
    monkeypatch.setattr(lexical._Cell, "score", lambda *x: pytest.fail("one query at a time"))
    assert len(lexical.search(idx, qs, k=12).collect()) == 12 * len(asked)
