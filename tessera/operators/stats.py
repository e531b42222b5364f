"""Token tables and term statistics.

Long tables only: ``tokens(doc_id, tokens ARRAY<STRING>)`` keeps one row per
document (tokenising and counting are row-local, no shuffle); ``term_counts
(doc_id, term, dl, cnt)`` feeds statistics with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import counted, has_word_char, word_tokens
from tessera.operators.joins import list_slices, lookup_lists, skew_safe_lookup
from tessera.session import materialize


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             tokenizer=word_tokens) -> DataFrame:
    """(doc_id, tokens) - one row per document, empty documents kept."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(tokenizer(F.col(text_col)), F.array().cast("array<string>")).alias("tokens"))


def lemma_table_from_vocab(vocab: DataFrame, term_col: str = "term") -> DataFrame:
    """Derived lemma table (form, lemma) for tests and benches: strip a final
    'ing' (words longer than five characters) or a final 's' (longer than
    three).  A real deployment supplies its own table."""
    t = F.col(term_col)
    lemma = (F.when(t.endswith("ing") & (F.length(t) > 5), F.expr(f"substring({term_col}, 1, length({term_col}) - 3)"))
             .when(t.endswith("s") & (F.length(t) > 3), F.expr(f"substring({term_col}, 1, length({term_col}) - 1)"))
             .otherwise(t))
    return vocab.select(t.alias("form"), lemma.alias("lemma"))


def used_lemmas(forms: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(form, n, lemma) of each ``form``, n being its rows: of a form that the lemma
    table lists twice the smallest, of one that it lacks the lower case."""
    listed = lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
    used = forms.groupBy("form").agg(F.count(F.lit(1)).alias("n")).join(listed, "form", "left")
    return used.select("form", "n", F.coalesce("lemma", F.lower("form")).alias("lemma"))


def lemma_lookup(forms: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``forms`` with a column ``lemma`` for their ``form`` (`used_lemmas`).
    Frequent forms are joined by broadcast, rare ones beyond its bound by a
    shuffle (`skew_safe_lookup`); ``forms`` is read twice."""
    return skew_safe_lookup(forms, materialize(used_lemmas(forms, lemmas), "lemmas"), "form", "n")


def lemma_counts(rows: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``rows`` whose array ``terms`` of (term, cnt) counts lemmas instead of forms,
    those with a word character, by name; with ``dl``, the sum of their counts.  A
    row's forms are looked up and its lemmas summed where it lies (`lookup_lists`);
    ``rows`` is read twice."""
    forms = rows.select(F.explode("terms.term").alias("form"))
    used = used_lemmas(forms, lemmas).withColumn("lemma", F.when(has_word_char(F.col("lemma")), F.col("lemma")))
    kept = [c for c in rows.columns if c != "terms"]
    ready = rows.select(*kept, F.col("terms.cnt").alias("cnts"), F.col("terms.term").alias("lemmas"))
    found = lookup_lists(ready, "lemmas", materialize(used, "lemmas"), "form", "lemma", "n")
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("dl", T.IntegerType()), rows.schema["terms"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, offsets in list_slices(batches, "lemmas"):
            coded = part.column("lemmas").flatten().dictionary_encode()
            names, cnt = coded.dictionary, part.column("cnts").flatten().to_numpy(zero_copy_only=False)
            order = pc.array_sort_indices(names).to_numpy()
            rank = np.empty(len(names) + 1, np.int64)
            rank[order], rank[-1] = np.arange(len(names)), -1  # a null is no term
            rank = rank[pc.fill_null(coded.indices, len(names)).to_numpy(zero_copy_only=False)]
            listed = rank >= 0
            row = np.repeat(np.arange(part.num_rows), np.diff(offsets))[listed]
            keys, place = np.unique(row * (len(names) + 1) + rank[listed], return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, cnt[listed])
            of_row = keys // (len(names) + 1)
            ends = pa.array(np.searchsorted(of_row, np.arange(part.num_rows + 1)), pa.int32())
            terms = pa.StructArray.from_arrays([names.take(pa.array(order[keys % (len(names) + 1)])), pa.array(sums)], names=["term", "cnt"])
            dl = np.zeros(part.num_rows, np.int32)
            np.add.at(dl, of_row, sums.astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(dl), pa.ListArray.from_arrays(ends, terms)],
                                             names=schema.names)

    return found.mapInArrow(run, schema)


def lemma_tokens(tok: DataFrame, lemmas: DataFrame) -> DataFrame:
    """C1 as a long table (doc_id, pos, lemma): look every token up in the
    lemma table (missing -> the lower-cased form) and keep tokens with a word
    character."""
    exploded = tok.select("doc_id", F.posexplode("tokens").alias("pos", "form"))
    return lemma_lookup(exploded, lemmas).select("doc_id", "pos", "lemma").filter(has_word_char(F.col("lemma")))


def term_counts(tok: DataFrame) -> DataFrame:
    """(doc_id, term, dl, cnt); dl = document length in tokens.  A document
    is one row, so its terms are counted where it lies, without a shuffle."""
    return tok.select("doc_id", F.size("tokens").alias("dl"), F.inline(counted("tokens"))).select("doc_id", "term", "dl", "cnt")


def doc_lengths(tok: DataFrame) -> DataFrame:
    """(doc_id, dl) - row-local, no join: empty documents have dl = 0."""
    return tok.select("doc_id", F.size("tokens").cast("long").alias("dl"))


def collection_size(tok: DataFrame) -> Column:
    """E5: N as a scalar subquery (evaluated once, then a literal)."""
    return tok.select(F.count(F.lit(1))).scalar()


def avg_doc_length(tok: DataFrame) -> Column:
    """Average length over all documents, including empty ones."""
    return tok.select(F.avg(F.size("tokens").cast("double"))).scalar()


def term_stats(counts: DataFrame) -> DataFrame:
    """(term, df, cf) - document and collection frequency."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("cnt").alias("cf"))


def corpus_frequency(counts: DataFrame) -> DataFrame:
    """Multiset union of per-document counters."""
    return counts.groupBy("term").agg(F.sum("cnt").alias("cnt"))


def vocab_size(counts: DataFrame) -> DataFrame:
    """E11."""
    return counts.agg(F.count_distinct("term").alias("vocab_size"))


def known_terms(terms: DataFrame, vocab: DataFrame, key: str = "term") -> DataFrame:
    """Keep terms present in the vocabulary."""
    return terms.join(vocab.select(key).distinct(), key, "left_semi")
