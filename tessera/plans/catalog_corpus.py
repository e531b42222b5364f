"""Registered queries: corpus counting at three levels (SURVEY 2.7 E2,
E6-E9, E14-E15; 2.9 G5-G7; 2.10 H1-H4).  ``documents`` maps to the corpus
with ``lang`` as season and ``source`` as episode; the pair is the document."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import word_tokens
from tessera.operators import corpus, stats
from tessera.plans.registry import register
from tessera.plans.sqlparts import LEMMAS, WORD
from tessera.session import materialize
from tessera.sources.tables import table

# The two and six words asked about (stand-ins for the
# reference's fixed character-name lists, chosen to exist in the tables).
TWO_WORDS = ["the", "de"]
SIX_WORDS = ["the", "de", "la", "der", "que", "und"]


def _gc(spark, sf):
    docs = table(spark, sf, "documents")
    return corpus.group_counts(docs, "lang", "source", word_tokens("text"))


def _groups(spark, sf):
    return corpus.document_groups(table(spark, sf, "documents"), "lang", "source")


GC = rf"""gc AS (SELECT lang AS season, source AS episode, term, count(*)::BIGINT AS cnt FROM
   (SELECT lang, source, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents) GROUP BY ALL),
gen AS (SELECT term, sum(cnt)::BIGINT AS cnt FROM gc GROUP BY term)"""


def _words_sql(words):
    return "(VALUES " + ", ".join(f"({i}, '{w}')" for i, w in enumerate(words)) + ") AS wl(pos, word)"


@register("level_counts", f"""WITH {GC}
SELECT 'general' AS level, NULL::VARCHAR AS season, NULL::VARCHAR AS episode, term, cnt FROM gen
UNION ALL SELECT 'seasons', season, NULL, term, sum(cnt)::BIGINT FROM gc GROUP BY season, term
UNION ALL SELECT 'series', season, episode, term, cnt FROM gc""")
def q_level_counts(spark, sf):
    return corpus.level_counts(_gc(spark, sf))


@register("level_counts_lemma", rf"""WITH {LEMMAS},
gc AS (SELECT lang AS season, source AS episode, lemma AS term, count(*)::BIGINT AS cnt FROM
   (SELECT lang, source, unnest(regexp_extract_all(lower(text), '{WORD}')) AS form FROM documents) JOIN lemmas USING (form) GROUP BY ALL)
SELECT 'general' AS level, NULL::VARCHAR AS season, NULL::VARCHAR AS episode, term, sum(cnt)::BIGINT AS cnt FROM gc GROUP BY term
UNION ALL SELECT 'seasons', season, NULL, term, sum(cnt)::BIGINT FROM gc GROUP BY season, term
UNION ALL SELECT 'series', season, episode, term, cnt FROM gc""")
def q_level_counts_lemma(spark, sf):
    """E6 over lemmas (C1/L3): forms are counted per group, then looked up."""
    gc = materialize(_gc(spark, sf), "group-counts")
    return corpus.level_counts(corpus.lemma_counts(gc, stats.lemma_table_from_vocab(gc.select("term").distinct())))


@register("word_lookup_general", f"""WITH {GC}
SELECT wl.pos::INT AS pos, wl.word, coalesce(g.cnt, 0)::BIGINT AS cnt FROM {_words_sql(SIX_WORDS)} LEFT JOIN gen g ON g.term = wl.word""")
def q_word_lookup_general(spark, sf):
    return corpus.word_lookup(_gc(spark, sf), SIX_WORDS, "general")


@register("word_lookup_seasons", f"""WITH {GC}, s AS (SELECT season, term, sum(cnt) AS cnt FROM gc GROUP BY ALL)
SELECT g.season, wl.pos::INT AS pos, wl.word, coalesce(s.cnt, 0)::BIGINT AS cnt
FROM (SELECT DISTINCT lang AS season FROM documents) g CROSS JOIN {_words_sql(SIX_WORDS)}
LEFT JOIN s ON s.season = g.season AND s.term = wl.word""")
def q_word_lookup_seasons(spark, sf):
    return corpus.word_lookup(_gc(spark, sf), SIX_WORDS, "seasons", _groups(spark, sf))


_SERIES_SQL = f"""WITH {GC}
SELECT g.season, g.episode, wl.pos::INT AS pos, wl.word, coalesce(c.cnt, 0)::BIGINT AS cnt
FROM (SELECT DISTINCT lang AS season, source AS episode FROM documents) g CROSS JOIN {_words_sql(SIX_WORDS)}
LEFT JOIN gc c ON c.season = g.season AND c.episode = g.episode AND c.term = wl.word"""


@register("word_lookup_series", _SERIES_SQL)
def q_word_lookup_series(spark, sf):
    return corpus.word_lookup(_gc(spark, sf), SIX_WORDS, "series", _groups(spark, sf))


@register("dense_counts", _SERIES_SQL)
def q_dense_counts(spark, sf):
    return corpus.dense_counts(_gc(spark, sf), SIX_WORDS, _groups(spark, sf))


@register("pivot_counts", f"""WITH {GC}
SELECT season, episode, {", ".join(f"coalesce(sum(cnt) FILTER (WHERE term = '{w}'), 0)::BIGINT AS {w}" for w in SIX_WORDS)}
FROM (SELECT DISTINCT lang AS season, source AS episode FROM documents) LEFT JOIN gc USING (season, episode) GROUP BY season, episode""")
def q_pivot_counts(spark, sf):
    return corpus.pivot_counts(_gc(spark, sf), SIX_WORDS, _groups(spark, sf))


@register("words_in_all_docs", rf"""WITH gc AS (SELECT source, term, count(*) AS cnt FROM
   (SELECT source, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents) GROUP BY ALL)
SELECT term FROM gc GROUP BY term HAVING count(*) = (SELECT count(DISTINCT source) FROM documents)""")
def q_words_in_all_docs(spark, sf):
    """E9/H3 with ``source`` as the document (20 sources)."""
    docs = table(spark, sf, "documents")
    return corpus.words_in_all_docs(corpus.group_counts(docs, F.lit(""), "source", word_tokens("text")),
                                    corpus.document_groups(docs, F.lit(""), "source"))


@register("most_frequent_word", f"WITH {GC} SELECT term, cnt FROM gen ORDER BY cnt DESC, term LIMIT 1")
def q_most_frequent_word(spark, sf):
    return corpus.most_frequent_word(_gc(spark, sf))


@register("rarest_words", f"WITH {GC} SELECT term, cnt FROM gen WHERE cnt = (SELECT min(cnt) FROM gen)")
def q_rarest_words(spark, sf):
    return corpus.rarest_words(_gc(spark, sf))


@register("rarest_sample", f"""WITH {GC} SELECT term, cnt FROM gen WHERE cnt = (SELECT min(cnt) FROM gen)
ORDER BY md5(term || '#42'), term LIMIT 10""")
def q_rarest_sample(spark, sf):
    return corpus.rarest_sample(_gc(spark, sf), 10, seed=42)


@register("best_season", f"""WITH {GC}, s AS (SELECT season, term, sum(cnt) AS cnt FROM gc GROUP BY ALL),
t AS (SELECT wl.pos, wl.word, g.season, coalesce(s.cnt, 0)::BIGINT AS hits
   FROM (SELECT DISTINCT lang AS season FROM documents) g CROSS JOIN {_words_sql(TWO_WORDS)} LEFT JOIN s ON s.season = g.season AND s.term = wl.word)
SELECT pos::INT AS pos, word, season, hits FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY hits DESC, season) AS r FROM t) WHERE r = 1""")
def q_best_season(spark, sf):
    return corpus.best_season(_gc(spark, sf), TWO_WORDS, _groups(spark, sf))


@register("most_mentioned", f"""WITH {GC}
SELECT wl.word, coalesce(g.cnt, 0)::BIGINT AS cnt FROM {_words_sql(SIX_WORDS)} LEFT JOIN gen g ON g.term = wl.word
ORDER BY cnt DESC, wl.pos LIMIT 1""")
def q_most_mentioned(spark, sf):
    return corpus.most_mentioned(_gc(spark, sf), SIX_WORDS)


@register("counter_union", rf"""WITH a AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents),
b AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM conversations),
ca AS (SELECT term, count(*) AS cnt FROM a GROUP BY term), cb AS (SELECT term, count(*) AS cnt FROM b GROUP BY term)
SELECT term, sum(cnt)::BIGINT AS cnt FROM (SELECT * FROM ca UNION ALL SELECT * FROM cb) GROUP BY term""")
def q_counter_union(spark, sf):
    def counter(name):
        t = table(spark, sf, name).select(F.explode(word_tokens("text")).alias("term"))
        return t.groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))
    return corpus.counter_union(counter("documents"), counter("conversations"))


@register("distinct_groups", "SELECT DISTINCT lang AS season, source AS episode FROM documents")
def q_distinct_groups(spark, sf):
    return table(spark, sf, "documents").select(F.col("lang").alias("season"), F.col("source").alias("episode")).distinct()


@register("conversation_levels", rf"""WITH t AS (SELECT role, conv_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM conversations),
gc AS (SELECT role AS season, conv_id::VARCHAR AS episode, term, count(*)::BIGINT AS cnt FROM t GROUP BY ALL)
SELECT 'general' AS level, NULL::VARCHAR AS season, NULL::VARCHAR AS episode, term, sum(cnt)::BIGINT AS cnt FROM gc GROUP BY term
UNION ALL SELECT 'seasons', season, NULL, term, sum(cnt)::BIGINT FROM gc GROUP BY season, term
UNION ALL SELECT 'series', season, episode, term, cnt FROM gc""")
def q_conversation_levels(spark, sf):
    """E6 on conversations: role as season, conversation as episode."""
    conv = table(spark, sf, "conversations").withColumn("episode", F.col("conv_id").cast("string"))
    return corpus.level_counts(corpus.group_counts(conv, "role", "episode", word_tokens("text")))
