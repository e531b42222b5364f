"""Readers, store round trip and incremental builds."""

from pyspark.sql import functions as F

from tessera.plans.engine import Engine
from tessera.sources import readers
from tessera.sources.store import IndexStore
from tests.conftest import docs_df


def test_csv_third_column_and_limit(spark, tmp_path):
    p = str(tmp_path / "q.csv")
    with open(p, "w") as fh:
        fh.write('id,qid,question\n1,2,"first, with comma"\n3,4,second\n5,6,"multi\nline"\n')
    rows = [r.text for r in readers.read_csv_docs(spark, p).collect()]
    assert rows == ["first, with comma", "second", "multi\nline"]
    assert readers.read_csv_docs(spark, p, limit=2).count() == 2  # S17: exactly `limit`


def test_corpus_files_bom_and_metadata(spark, tmp_path):
    """A byte order mark is dropped; groups of the file name become columns."""
    folder = tmp_path / "logbooks" / "north"
    folder.mkdir(parents=True)
    (folder / "b07_p3__harbour.txt").write_bytes("\ufeffhello\r\nworld".encode())
    df = readers.read_corpus_files(spark, str(tmp_path / "logbooks"), r"b(\d+)_p(\d+)__(\w+)\.txt$",
                                   {"season": 1, "episode": 2, "title": 3})
    r = df.first()
    assert (r.season, r.episode, r.title) == ("07", "3", "harbour")
    assert r.text.startswith("hello")


def test_store_incremental_build(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "idx"))
    engine = Engine(docs_df(spark, ["a b", "b c"]))
    assert engine.save(store, ["bm25"]) == ["bm25"]
    assert engine.save(store, ["bm25"]) == []  # second build does nothing
    assert store.postings("bm25").count() == 4
    missing = [r.model for r in store.models_to_build(["bm25", "tfidf"]).collect()]
    assert missing == ["tfidf"]
    assert store.manifest().filter(F.col("model") == "bm25").count() == 1
    assert sorted(engine.save(store, ["bm25", "tfidf", "bert"])) == ["bert", "tfidf"]
    assert store.postings("tfidf").count() == 0  # no word of two letters: an index without postings
    assert Engine.from_store(store).search("tf-idf", "a", 2).count() == 2
    entered = store.manifest().filter("model <> 'bm25'").collect()
    assert len({(r.build_id, r.created) for r in entered}) == 1 and {r.kind for r in entered} == {"postings", "vectors"}


def test_reader_dispatch_by_path_and_format(spark, tmp_path):
    (tmp_path / "q.csv").write_text("id,qid,question\n1,2,first\n3,4,second\n")
    (tmp_path / "lines.txt").write_text("one\n two \n")
    docs_df(spark, ["stored"]).write.parquet(str(tmp_path / "d.parquet"))
    assert [r.text for r in readers.read_docs(spark, str(tmp_path / "q.csv")).collect()] == ["first", "second"]
    assert [r.text for r in readers.read_docs(spark, str(tmp_path / "lines.txt")).collect()] == ["one", " two "]
    assert [r.text for r in readers.read_docs(spark, str(tmp_path / "d.parquet"), limit=5).collect()] == ["stored"]
    assert [r.text for r in readers.read_lines(spark, str(tmp_path / "lines.txt"), strip=True).collect()] == ["one", "two"]
