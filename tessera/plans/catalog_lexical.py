"""Registered queries: tokens, term statistics, BM25 / TF-IDF (SURVEY 2.3,
2.5, 2.7 E1-E5/E11, 2.8 F1-F6, 2.9 G1-G4, 2.6 D1/D5/D9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import lexical, stats
from tessera.operators.joins import broadcast_checked
from tessera.plans.registry import register, rounded
from tessera.plans.sqlparts import CNT, KEYS, LEMMA_TOK, TFIDF_CTES, TOK, WORD, bm25_ctes, search_sql
from tessera.session import materialize
from tessera.sources.tables import benchmark_queries, documents, table, turn_id


def _tok(spark, sf):
    return stats.tokenize(documents(spark, sf))


@register("word_tokens", rf"""
SELECT doc_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS term
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS t FROM documents)""")
def q_word_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", F.posexplode(tx.word_tokens("text")).alias("pos", "term"))


@register("ws_tokens", r"""
SELECT doc_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS token
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents)""")
def q_ws_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", F.posexplode(tx.ws_tokens("text")).alias("pos", "token"))


@register("vectorizer_tokens", rf"""
SELECT doc_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS term
FROM (SELECT doc_id, regexp_extract_all(lower(array_to_string(regexp_extract_all(lower(text), '{WORD}'), ' ')),
      '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM documents)""")
def q_vectorizer_tokens(spark, sf):
    return documents(spark, sf).select(
        "doc_id", F.posexplode(tx.vectorizer_tokens(tx.word_tokens("text"))).alias("pos", "term"))


@register("tokens_join", rf"""
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '{WORD}'), ' ') AS joined FROM documents""")
def q_tokens_join(spark, sf):
    return documents(spark, sf).select("doc_id", tx.tokens_join(tx.word_tokens("text")).alias("joined"))


_LEMMA_SQL = rf"""
WITH {TOK},
vocab AS (SELECT DISTINCT unnest(toks) AS form FROM tok),
lemmas AS (SELECT form, CASE WHEN form LIKE '%ing' AND length(form) > 5 THEN substring(form, 1, length(form) - 3)
                             WHEN form LIKE '%s' AND length(form) > 3 THEN substring(form, 1, length(form) - 1)
                             ELSE form END AS lemma FROM vocab),
ex AS (SELECT doc_id, unnest(range(len(toks)))::INT AS pos, unnest(toks) AS form FROM tok)
SELECT ex.doc_id, ex.pos, coalesce(l.lemma, lower(ex.form)) AS lemma
FROM ex LEFT JOIN lemmas l USING (form)
WHERE regexp_matches(coalesce(l.lemma, lower(ex.form)), '[\p{{L}}\p{{N}}_]')"""


@register("lemma_tokens", _LEMMA_SQL)
def q_lemma_tokens(spark, sf):
    tok = _tok(spark, sf)
    vocab = tok.select(F.explode("tokens").alias("term")).distinct()
    return stats.lemma_tokens(tok, stats.lemma_table_from_vocab(vocab))


@register("known_terms", rf"""
WITH {TOK}, vocab AS (SELECT DISTINCT unnest(toks) AS term FROM tok)
SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM benchmark)
WHERE term IN (SELECT term FROM vocab)""")
def q_known_terms(spark, sf):
    vocab = _tok(spark, sf).select(F.explode("tokens").alias("term"))
    return stats.known_terms(lexical.query_terms(benchmark_queries(spark, sf)), vocab)


@register("term_counts", f"WITH {TOK}, {CNT} SELECT doc_id, term, cnt::BIGINT AS cnt FROM cnt")
def q_term_counts(spark, sf):
    return stats.term_counts(_tok(spark, sf)).select("doc_id", "term", "cnt")


@register("corpus_frequency", f"WITH {TOK}, {CNT} SELECT term, sum(cnt)::BIGINT AS cnt FROM cnt GROUP BY term")
def q_corpus_frequency(spark, sf):
    return stats.corpus_frequency(stats.term_counts(_tok(spark, sf)))


@register("term_stats", f"WITH {TOK}, {CNT} SELECT term, df, cf FROM st")
def q_term_stats(spark, sf):
    return stats.term_stats(stats.term_counts(_tok(spark, sf)))


@register("doc_lengths", f"WITH {TOK}, {CNT} SELECT doc_id, dl FROM lens")
def q_doc_lengths(spark, sf):
    return stats.doc_lengths(_tok(spark, sf))


@register("avg_doc_length", f"WITH {TOK}, {CNT} SELECT n::BIGINT AS n_docs, round(avgdl, 6) AS avgdl FROM nn")
def q_avg_doc_length(spark, sf):
    tok = _tok(spark, sf)
    return rounded(tok.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size("tokens").cast("double")).alias("avgdl")))


@register("vocab_size", f"WITH {TOK}, {CNT} SELECT count(DISTINCT term)::BIGINT AS vocab_size FROM cnt")
def q_vocab_size(spark, sf):
    return stats.vocab_size(stats.term_counts(_tok(spark, sf)))


@register("bm25_idf", f"WITH {bm25_ctes()} SELECT term, n_qi::BIGINT AS n_qi, round(idf, 6) AS idf FROM idf")
def q_bm25_idf(spark, sf):
    tok = _tok(spark, sf)
    idf = lexical.bm25_idf(stats.term_counts(tok), stats.collection_size(tok))
    return rounded(idf.select("term", "n_qi", "idf"))


@register("bm25_idf_collection",
          f"WITH {bm25_ctes('collection')} SELECT term, n_qi::BIGINT AS n_qi, round(idf, 6) AS idf FROM idf")
def q_bm25_idf_collection(spark, sf):
    tok = _tok(spark, sf)
    idf = lexical.bm25_idf(stats.term_counts(tok), stats.collection_size(tok), n_qi="collection")
    return rounded(idf.select("term", "n_qi", "idf"))


@register("bm25_index", f"""WITH {bm25_ctes()}
SELECT doc_id, term, cnt::BIGINT AS cnt, round(weight, 6) AS weight FROM post""")
def q_bm25_index(spark, sf):
    idx = lexical.build_lexical(documents(spark, sf), "bm25")
    return rounded(idx.postings.select("doc_id", "term", "cnt", "weight"))


@register("tfidf_index", f"WITH {TFIDF_CTES} SELECT doc_id, term, round(weight, 6) AS weight FROM post")
def q_tfidf_index(spark, sf):
    idx = lexical.build_lexical(documents(spark, sf), "tfidf")
    return rounded(idx.postings.select("doc_id", "term", "weight"))


_BENCH_Q = "SELECT item_id AS query_id, text FROM benchmark"


def _search_out(res):
    return rounded(res.select("query_id", "rank", "doc_id", "score"))


@register("bm25_search", f"""WITH {bm25_ctes()}, {KEYS}, {search_sql(_BENCH_Q)}
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def q_bm25_search(spark, sf):
    idx = lexical.build_lexical(documents(spark, sf), "bm25")
    return _search_out(lexical.search(idx, benchmark_queries(spark, sf), k=10))


@register("tfidf_search", f"""WITH {TFIDF_CTES}, {KEYS}, {search_sql(_BENCH_Q)}
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def q_tfidf_search(spark, sf):
    idx = lexical.build_lexical(documents(spark, sf), "tfidf")
    return _search_out(lexical.search(idx, benchmark_queries(spark, sf), k=10))


_TURN_Q = "SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS query_id, text FROM conversations"


@register("bm25_zero_fill", f"""WITH {bm25_ctes('collection')}, {KEYS}, {search_sql(_TURN_Q)}
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def q_bm25_zero_fill(spark, sf):
    """S3 + S8/S9: collection-frequency BM25 where common terms have negative
    or no idf, so zero-score documents fill the top-k."""
    idx = lexical.build_lexical(documents(spark, sf), "bm25", n_qi="collection")
    conv = table(spark, sf, "conversations")
    qs = conv.select(turn_id(conv).alias("query_id"), "text")
    return _search_out(lexical.search(idx, qs, k=10))


@register("search_with_text", f"""WITH {bm25_ctes()}, {KEYS}, {search_sql(_BENCH_Q)}
SELECT r.query_id, r.rank, r.doc_id, round(r.score, 6) AS score, d.text
FROM ranked r JOIN documents d USING (doc_id) WHERE rank <= 10""")
def q_search_with_text(spark, sf):
    docs = documents(spark, sf)
    idx = lexical.build_lexical(docs, "bm25")
    res = lexical.attach_text(lexical.search(idx, benchmark_queries(spark, sf), k=10), docs)
    return rounded(res.select("query_id", "rank", "doc_id", "score", "text"))


@register("distinct_results", rf"""WITH {bm25_ctes()}, {KEYS},
q AS (SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM benchmark)),
s AS (SELECT q.query_id, p.doc_id, sum(p.weight) AS score FROM q JOIN post p USING (term) GROUP BY ALL)
SELECT s.query_id, k.text_key, min(s.doc_id) AS doc_id, round(arg_max(s.score, s.doc_id), 6) AS score
FROM s JOIN keys k USING (doc_id) GROUP BY s.query_id, k.text_key""")
def q_distinct_results(spark, sf):
    """G4 on undeduplicated scores: first position, score of the last copy."""
    idx = lexical.build_lexical(documents(spark, sf), "bm25")
    qt = lexical.query_terms(benchmark_queries(spark, sf))
    scored = (idx.postings.join(broadcast_checked(qt), "term")
              .groupBy("query_id", "doc_id").agg(F.sum("weight").alias("score")))
    return rounded(lexical.dedupe_by_text(scored, idx.doc_keys))


@register("score_format", f"""WITH {bm25_ctes()}, {KEYS}, {search_sql(_BENCH_Q)}
SELECT query_id, rank, doc_id, printf('%.2f', score) AS score FROM ranked WHERE rank <= 10""")
def q_score_format(spark, sf):
    """C17: two-decimal display strings of the BM25 results (display only)."""
    idx = lexical.build_lexical(documents(spark, sf), "bm25")
    res = lexical.search(idx, benchmark_queries(spark, sf), k=10)
    return res.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id",
                      tx.score_format("score").alias("score"))


def lemma_collection(spark, sf) -> lexical.Collection:
    """The documents as lemmas of a table derived from their vocabulary."""
    docs = documents(spark, sf)
    vocab = stats.tokenize(docs).select(F.explode("tokens").alias("term")).distinct()
    return lexical.Collection(docs, lemmas=materialize(stats.lemma_table_from_vocab(vocab), "lemma-table"),
                              lemma_name="final ing or s")


@register("term_counts_lemma", f"WITH {LEMMA_TOK}, {CNT} SELECT doc_id, term, cnt::BIGINT AS cnt FROM cnt")
def q_term_counts_lemma(spark, sf):
    """Term counts of a collection of lemmas."""
    return lemma_collection(spark, sf).counts.select("doc_id", "term", "cnt")


@register("bm25_search_lemma", f"""WITH {bm25_ctes(tok=LEMMA_TOK)}, {KEYS}, {search_sql(_BENCH_Q, lemmas=True)}
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def q_bm25_search_lemma(spark, sf):
    """F5/F6 over lemmas; the queries' words are looked up in the same table."""
    idx = lexical.build_lexical(lemma_collection(spark, sf), "bm25")
    return _search_out(lexical.search(idx, benchmark_queries(spark, sf), k=10))
