"""Corpus counting rules S19-S23 and level totals."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import word_tokens
from tessera.operators import corpus

ROWS = [("s1", "e1", "Ross ross Monica"), ("s1", "e2", "Ross"), ("s2", "e3", "Monica monica joey"),
        ("s2", "e3", "rare")]


def gc(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "season string, episode string, text string")
    return corpus.group_counts(df, "season", "episode", word_tokens("text"))


def test_levels_sum_to_token_total(spark):
    lc = corpus.level_counts(gc(spark))
    totals = {r.level: r.n for r in lc.groupBy("level").agg(F.sum("cnt").alias("n")).collect()}
    assert totals == {"general": 8, "seasons": 8, "series": 8}


def test_s23_missing_word_is_zero_at_every_level(spark):
    g = gc(spark)
    for level in corpus.LEVELS:
        rows = corpus.word_lookup(g, ["nobody"], level).collect()
        assert rows and all(r.cnt == 0 for r in rows)


def test_p3_level_validation(spark):
    with pytest.raises(ValueError):
        corpus.word_lookup(gc(spark), ["ross"], "episodes")


def test_s21_true_argmax_and_ties_first_in_list(spark):
    g = gc(spark)
    assert corpus.most_mentioned(g, ["joey", "ross", "monica"]).first().word == "ross"  # 3 vs 3: first listed
    assert corpus.most_mentioned(g, ["joey", "monica", "ross"]).first().word == "monica"


def test_e14_best_season_strict_first_wins(spark):
    rows = {r.word: (r.season, r.hits) for r in corpus.best_season(gc(spark), ["ross", "monica", "zzz"]).collect()}
    assert rows["ross"] == ("s1", 3)
    assert rows["monica"] == ("s2", 2)
    assert rows["zzz"] == ("s1", 0)


def test_e9_words_in_all_docs(spark):
    rows = [("a", "1", "x y"), ("a", "2", "y z"), ("b", "3", "y x")]

    def groups(rows):
        return corpus.document_groups(spark.createDataFrame(rows, "season string, episode string, text string"), "season", "episode")
    assert [r.term for r in corpus.words_in_all_docs(gc(spark, rows), groups(rows)).collect()] == ["y"]
    mute = [*rows, ("b", "4", "...")]  # a document without a token holds no word
    assert corpus.words_in_all_docs(gc(spark, mute), groups(mute)).count() == 0
    assert corpus.word_lookup(gc(spark, mute), "y", "series", groups(mute)).count() == 4


def test_e8_takes_a_string_and_filters_early(spark):
    g = gc(spark)
    assert [(r.word, r.cnt) for r in corpus.word_lookup(g, "Ross").collect()] == [("ross", 3)]
    with pytest.raises(TypeError):
        corpus.word_lookup(g, 7)
    with pytest.raises(TypeError):
        corpus.word_lookup(g, ["ross", None])
    plan = corpus.word_lookup(g, ["ross", "joey"], "seasons")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("IN (ross,joey)") > plan.index("Aggregate")


def test_g6_g7_rarest(spark):
    g = gc(spark)
    rare = {r.term for r in corpus.rarest_words(g).collect()}
    assert rare == {"joey", "rare"}
    sample = corpus.rarest_sample(g, 10).collect()
    assert len(sample) == 2  # fewer than ten exist: no endless loop (S22)


def test_pivot_counts_zero_filled(spark):
    p = corpus.pivot_counts(gc(spark), ["ross", "joey"]).orderBy("episode").collect()
    assert [(r.episode, r.ross, r.joey) for r in p] == [("e1", 2, 0), ("e2", 1, 0), ("e3", 0, 1)]
