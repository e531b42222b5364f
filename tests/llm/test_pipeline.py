"""The pipeline's stages against plain Python over a small table."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_joins import brute_components
from tests.llm.test_operators import base_counts, brute_lines, frame, long_words


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = []
    for k in range(160):
        lines = [long_words(12, 100 * k + j) for j in range(5)]
        if k % 4 == 0:
            lines += [long_words(9, 7), long_words(9, 8), long_words(9, 9)]
        text = "\n".join(lines)
        if k % 10 == 3:
            text = " ".join(w + "#%" for w in text.split())
        if k % 20 == 19:
            text = rows[k - 2][1].replace("a", "a", 1) + " and more"
        rows.append((k, text))
    rows += [(500, None), (501, ""), (502, rows[0][1]), (503, "too short")]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = (frame(spark, rows).withColumn("lang", F.lit("en")).withColumn("source", F.concat(F.lit("src"), F.col("doc_id") % 3))
            .withColumn("n_chars", F.length("text").cast("long")))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k % 10 != 3), 0) for k in range(0, 160)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality rules"](spark, docs, folder)
    kept = {r.doc_id: r.text for r in one.collect()}
    want = {k for k, t in rows if base_counts(t)[0] >= 20 and k % 10 != 3 and "#%" not in t}
    assert set(kept) == want and one.columns == docs.columns

    two = stages["line dedup"](spark, one, folder)
    cut = {d: t for (d, _), t in brute_lines(sorted(kept.items())).items()}
    got = {r.doc_id: r for r in two.collect()}
    assert {k: r.text for k, r in got.items()} == {k: t for k, t in cut.items() if re.search(r"\S", t)}
    assert all(r.n_chars == len(r.text) for r in got.values()) and 502 not in got and two.columns == docs.columns

    three = stages["n-gram Jaccard join"](spark, two, folder)
    parts = brute_components([(k, r.text) for k, r in got.items()])
    assert {r.doc_id for r in three.collect()} == {k for k, c in parts.items() if k == c} and three.columns == docs.columns

    four = stages["mixing sources"](spark, three, folder)
    left = {r.doc_id for r in four.collect()}
    assert left and left <= {r.doc_id for r in three.collect()} and four.columns == docs.columns

    five = stages["SentencePiece encoding"](spark, four, folder)
    assert {r.doc_id for r in five.collect()} == left and five.columns == [*docs.columns, "ids", "n_tokens", "round_trip"]
    assert all(r.round_trip and len(r.ids) == r.n_tokens > 0 for r in five.collect())


def test_stages_take_odd_tables(spark, corpus):
    """Nulls in every column, empty texts, repeated rows, names that clash with
    new columns, and no rows at all."""
    folder, _ = corpus
    text = "\n".join(long_words(9, k) for k in range(6))
    rows = [(1, text, "en", "src1", 7, 1, "a"), (1, text, "en", "src1", 7, 1, "a"), (None, text, None, None, None, None, None),
            (2, None, "en", None, None, 2, None), (3, "", None, "src2", 0, 3, "b"), (4, " \n\t ", "xx", "src9", 4, 4, "c"),
            (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids int, Round_Trip string")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, folder)
            got = out.collect()
            assert out.columns[:len(docs.columns)] == docs.columns and len({c.lower() for c in out.columns}) == len(out.columns), name
            assert len(got) <= len(rows) and (table is docs or not got), name
    assert len(out.columns) == len(docs.columns) + 3
    full = corpus_pipeline.encode(spark, docs, folder).collect()
    assert len(full) == len(rows) and all(r[-1] for r in full)


def test_run_is_the_chain(spark, corpus):
    folder, _ = corpus
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and out.where(F.size("ids") != F.col("n_tokens")).count() == 0
