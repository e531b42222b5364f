"""Pluggable encoders: blank guard, layer layout, registration."""

import numpy as np
import pytest

from tessera.operators import encoders


def test_sentence_vectors_blank_is_zero(spark):
    df = spark.createDataFrame([(0, "hello world"), (1, "")], "doc_id long, text string")
    rows = {r.doc_id: r.vec for r in encoders.sentence_vectors(df).collect()}
    assert len(rows[0]) == encoders.DIM and any(v != 0 for v in rows[0])
    assert rows[1] == [0.0] * encoders.DIM


def test_token_layer_vectors_layout(spark):
    df = spark.createDataFrame([(0, ["a", "b", "c"]), (1, []), (2, ["a"])], "sent_id long, tokens array<string>")
    rows = encoders.token_layer_vectors(df).collect()
    assert len(rows) == (3 + 0 + 1) * 3
    by = {(r.sent_id, r.layer, r.pos): np.array(r.vec) for r in rows}
    assert np.allclose(by[(0, 2, 1)], 3 * by[(0, 0, 1)])


def test_register_custom_encoder(spark):
    encoders.register_encoder("ones", lambda texts: np.ones((len(texts), 4), dtype=np.float32))
    df = spark.createDataFrame([(0, "x")], "doc_id long, text string")
    assert encoders.sentence_vectors(df, "ones").first().vec == [1.0] * 4


def test_null_text_is_a_zero_vector(spark):
    from tessera.operators import encoders

    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a word")], "doc_id long, text string")
    got = {r.doc_id: sum(map(abs, r.vec)) for r in encoders.sentence_vectors(docs).collect()}
    assert got[1] == got[2] == 0 and got[3] > 0


def test_a_factory_loads_once_per_worker(spark, tmp_path):
    """The factory leaves a line with its process id whenever it is called."""
    log = str(tmp_path / "loads")

    def load():
        import os

        with open(log, "a") as fh:
            fh.write(f"{os.getpid()}\n")
        return lambda texts: np.ones((len(texts), 2), dtype=np.float32)

    encoders.register_encoder("slow", factory=load)
    df = spark.range(400).selectExpr("id AS doc_id", "string(id) AS text").repartition(16)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for _ in range(3):
            assert encoders.sentence_vectors(df, "slow").filter("size(vec) = 2").count() == 400
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    loads = open(log).read().split()
    assert len(loads) == len(set(loads)) >= 1


def test_unknown_encoders_are_refused(spark):
    with pytest.raises(KeyError, match="nothing"):
        encoders.sentence_vectors(spark.createDataFrame([(0, "x")], "doc_id long, text string"), "nothing")
    with pytest.raises(ValueError):
        encoders.register_encoder("both", lambda x: x, factory=lambda: None)


def test_pooled_vectors_equal_the_pool_of_layer_vectors(spark, monkeypatch):
    from tessera.operators import dense

    monkeypatch.setattr(encoders, "TOKENS_AT_ONCE", 4)
    df = spark.createDataFrame([(0, ["a", "b", None, "c"]), (1, []), (2, ["a"]), (2, ["d", "e", "f"]), (3, None)],
                               "sent_id long, tokens array<string>")
    w = spark.createDataFrame([(0, 0.3), (1, -1.0), (2, 2.0)], "layer int, w double")
    want = {r.sent_id: r.vec for r in dense.mixed_pool(encoders.token_layer_vectors(df), w, 0.7).collect()}
    got = {r.sent_id: r.vec for r in encoders.pooled_layer_vectors(df, w, gamma=0.7).collect()}
    assert got.keys() == want.keys() == {0, 2} and all(got[k] == pytest.approx(want[k]) for k in want)


def test_an_encoder_is_given_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(encoders, "CHARS_AT_ONCE", 10)
    encoders.register_encoder("counted", lambda texts: np.full((len(texts), 1), len(texts), np.float32))
    df = spark.createDataFrame([(i, "abcd") for i in range(9)], "doc_id long, text string").coalesce(1)
    assert max(r.vec[0] for r in encoders.sentence_vectors(df, "counted").collect()) == 2.0


def test_norms_of_vectors_of_any_length(spark):
    """norms are taken a batch at a time, without a lambda per component."""
    rows = [(1, [3.0, 4.0]), (2, []), (3, None), (4, [1.0, None]), (5, [-2.0]), (6, [1.0, 2.0, 2.0])]
    df = spark.createDataFrame(rows, "id int, vec array<float>")
    out = encoders.add_norms(df, "vec")
    assert out.columns == ["id", "norm"]
    assert {r["id"]: r["norm"] for r in out.collect()} == {1: 5.0, 2: 0.0, 3: None, 4: None, 5: 2.0, 6: 3.0}
    even = encoders.add_norms(df.filter("id IN (1, 6) AND size(vec) = 2"), "vec")
    assert [r["norm"] for r in even.collect()] == [5.0]


def test_packed_vectors_are_those_of_the_lists(spark, tmp_path):
    """a dump holds one value per vector; its numbers and norms are the same."""
    rows = [(0, ["a", "b", "a"]), (1, []), (2, None), (3, ["é", None, "zz"]), (4, ["x"] * 40)]
    s = spark.createDataFrame(rows, "sent_id long, tokens array<string>")
    path = str(tmp_path / "dump")
    encoders.token_layer_vectors(s, packed=True).write.option("compression", "zstd").parquet(path)
    back = spark.read.parquet(path)
    assert back.schema["vec"].dataType.simpleString() == "binary"
    want = {(r.sent_id, r.layer, r.pos): r.vec for r in encoders.token_layer_vectors(s).collect()}
    assert {(r.sent_id, r.layer, r.pos): np.frombuffer(r.vec, "<f4").tolist() for r in back.collect()} == want
    norms = {(r.sent_id, r.layer, r.pos): r.norm for r in encoders.add_norms(back, "vec").collect()}
    assert norms == {k: pytest.approx(np.linalg.norm(np.array(x, np.float64))) for k, x in want.items()}


def test_norms_of_packed_vectors_with_nulls_and_several_lengths(spark):
    vecs = [[1.0, 2.0], None, [], [3.0, 4.0, 12.0], [5.0]]
    rows = [(k, None if v is None else bytearray(np.array(v, "<f4").tobytes())) for k, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, vec binary").coalesce(1)
    got = {r.id: r.norm for r in encoders.add_norms(df, "vec").collect()}
    assert got == {0: pytest.approx(5 ** 0.5), 1: None, 2: 0.0, 3: 13.0, 4: 5.0}
    got = {r.id: r.norm for r in encoders.add_norms(df.filter("id <> 1"), "vec").collect()}
    assert got == {0: pytest.approx(5 ** 0.5), 2: 0.0, 3: 13.0, 4: 5.0}
