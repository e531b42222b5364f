"""Corpus counting at three grouping levels and the fixed questions on them
(SURVEY E2, E6-E9, E14-E15, G5-G7, H1-H4; rules S19-S23).

A "document" here is a group of rows identified by ``(season, episode)``;
counts are computed once per (season, episode, term) with map-side partial
aggregation and every level is derived from that pre-aggregated table, so a
hot term or a huge season never sends raw tokens through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import has_word_char
from tessera.operators import stats
from tessera.session import materialize

LEVELS = ("general", "seasons", "series")


def check_level(level: str) -> str:
    """Level must be one of general / seasons / series."""
    if level not in LEVELS:
        raise ValueError("level must be one of general, seasons, series")
    return level


def group_counts(rows: DataFrame, season, episode, tokens: Column) -> DataFrame:
    """(season, episode, term, cnt) - term counts per document group."""
    s = F.col(season) if isinstance(season, str) else season
    e = F.col(episode) if isinstance(episode, str) else episode
    ex = rows.select(s.alias("season"), e.alias("episode"), F.explode(tokens).alias("term"))
    return ex.groupBy("season", "episode", "term").agg(F.count(F.lit(1)).alias("cnt"))


def lemma_counts(gc: DataFrame, lemmas: DataFrame) -> DataFrame:
    """C1/L3 on counts per group: forms become lemmas after they are counted, so a
    form is looked up once per group; lemmas without a word character go."""
    found = stats.lemma_lookup(materialize(gc.withColumnRenamed("term", "form"), "group-forms"), lemmas)
    return (found.filter(has_word_char(F.col("lemma"))).groupBy("season", "episode", F.col("lemma").alias("term"))
            .agg(F.sum("cnt").alias("cnt")))


def level_counts(gc: DataFrame) -> DataFrame:
    """One table with all three levels via GROUPING SETS on the
    pre-aggregated counts: (level, season, episode, term, cnt)."""
    agg = gc.groupingSets([["term"], ["season", "term"], ["season", "episode", "term"]],
                          "season", "episode", "term").agg(
        F.sum("cnt").alias("cnt"), F.grouping("season").alias("_gs"), F.grouping("episode").alias("_ge"))
    level = F.when(F.col("_gs") == 1, "general").when(F.col("_ge") == 1, "seasons").otherwise("series")
    return agg.select(level.alias("level"), "season", "episode", "term", F.col("cnt").cast("long").alias("cnt"))


def general(gc: DataFrame) -> DataFrame:
    """(term, cnt) over the whole collection."""
    return gc.groupBy("term").agg(F.sum("cnt").cast("long").alias("cnt"))


def checked_words(words) -> list[str]:
    """A string is one word; otherwise a list or tuple of strings."""
    if isinstance(words, str):
        return [words]
    if not isinstance(words, (list, tuple)) or not all(isinstance(w, str) for w in words):
        raise TypeError("words must be a string or a list of strings")
    return list(words)


def document_groups(rows: DataFrame, season, episode) -> DataFrame:
    """(season, episode) of every document, also of those without a token."""
    s = F.col(season) if isinstance(season, str) else season
    e = F.col(episode) if isinstance(episode, str) else episode
    return rows.select(s.alias("season"), e.alias("episode")).distinct()


def words_frame(words: list[str]) -> list[Column]:
    """Fixed word list as (pos, word) columns, lower-cased like the query."""
    return [F.posexplode(F.array(*[F.lit(w.lower()) for w in words])).alias("pos", "word")]


def word_lookup(gc: DataFrame, words: str | list[str], level: str = "general", groups: DataFrame | None = None) -> DataFrame:
    """Counts of the given words at a level, 0 when missing.

    ``groups`` (``document_groups``) names the documents; without it only those
    that have a token are known.  The words filter the counts before they are
    summed; the list itself is a literal array exploded on each group row (no
    join to produce the product), joined on (group, term)."""
    check_level(level)
    words = checked_words(words)
    keys = [] if level == "general" else (["season"] if level == "seasons" else ["season", "episode"])
    counts = gc.filter(F.col("term").isin([w.lower() for w in words])).groupBy(*keys, "term").agg(F.sum("cnt").alias("cnt"))
    if level == "general":
        base = gc.sparkSession.range(1).select(*words_frame(words))
    else:
        base = (gc if groups is None else groups).select(*keys).distinct().select(*keys, *words_frame(words))
    out = base.join(counts.withColumnRenamed("term", "word"), [*keys, "word"], "left")
    return out.select(*keys, "pos", "word", F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("cnt"))


def dense_counts(gc: DataFrame, words: list[str], groups: DataFrame | None = None) -> DataFrame:
    """E7 (long form): zero-filled word x document table for a word list."""
    return word_lookup(gc, words, "series", groups)


def pivot_counts(gc: DataFrame, words: list[str], groups: DataFrame | None = None) -> DataFrame:
    """E7 (wide form): one column per word, explicit value list, zeros filled."""
    ws = [w.lower() for w in words]
    wide = (gc.filter(F.col("term").isin(ws)).groupBy("season", "episode")
            .pivot("term", ws).agg(F.sum("cnt")))
    allg = (gc if groups is None else groups).select("season", "episode").distinct()
    out = allg.join(wide, ["season", "episode"], "left")
    return out.select("season", "episode", *[F.coalesce(F.col(f"`{w}`"), F.lit(0)).cast("long").alias(w) for w in ws])


def words_in_all_docs(gc: DataFrame, groups: DataFrame) -> DataFrame:
    """Relational division - terms present in every document group; a
    document without a token (it is in ``groups``) leaves none."""
    n_docs = groups.select("season", "episode").distinct().select(F.count(F.lit(1))).scalar()
    per_term = gc.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return per_term.filter(F.col("n") == n_docs).select("term")


def most_frequent_word(gc: DataFrame) -> DataFrame:
    """Most frequent term, ties by term."""
    return general(gc).orderBy(F.col("cnt").desc(), F.col("term")).limit(1)


def rarest_words(gc: DataFrame) -> DataFrame:
    """Every term tied at the minimum count."""
    g = general(gc)
    return g.filter(F.col("cnt") == g.select(F.min("cnt")).scalar())


def rarest_sample(gc: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """N distinct terms of G6 in a seeded hash order; fewer if fewer exist."""
    return rarest_words(gc).orderBy(F.md5(F.concat("term", F.lit(f"#{seed}"))), F.col("term")).limit(n)


def best_season(gc: DataFrame, words: list[str], groups: DataFrame | None = None) -> DataFrame:
    """Per word, the season with most hits; strict '>' so the first
    season in order wins ties, and all-zero words get the first season."""
    t = word_lookup(gc, words, "seasons", groups)
    w = Window.partitionBy("word").orderBy(F.col("cnt").desc(), F.col("season"))
    return (t.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("pos", "word", "season", F.col("cnt").alias("hits")))


def most_mentioned(gc: DataFrame, words: list[str]) -> DataFrame:
    """The true arg-max of a word list (first in list order on ties)."""
    t = word_lookup(gc, words, "general")
    return t.orderBy(F.col("cnt").desc(), F.col("pos")).limit(1).select("word", "cnt")


def counter_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """H1: multiset union with summed counts of two (term, cnt) tables."""
    return a.unionByName(b).groupBy("term").agg(F.sum("cnt").cast("long").alias("cnt"))
