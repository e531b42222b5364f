"""Lexical ranking models: BM25 and TF-IDF indexes and search (SURVEY F1-F6,
D1, D5, D9, G1-G4 and rules S1-S12).

Index tables
------------
``doc_keys(doc_id, text_key, text_idx)``: ``text_key`` is the smallest doc_id
with the same text (S1); ``text_idx`` is the dense 0-based position of the
distinct text in collection order (used by the exact zero fill, S3).

``postings(term, doc_id, text_key, text_idx, cnt, dl, weight)``: one row per
(document, term); the weight already folds in duplicates (S7) and document
normalisation, so a score is a sum over the query terms.

A collection is counted once, row by row, into one row per document that holds its
keys, length and term counts; postings are exploded from it where it lies, and the
term weights are looked up by a broadcast that its measured size bounds.  A search
scores shards of consecutive positions: the postings of the batch's terms meet its
queries in cells (shard group, query block), each cell keeps the best k and the
first k positions without a match of every query, and only these are exchanged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.text import VEC_TOKEN_RE, counted, has_word_char, word_tokens, ws_tokens
from tessera.operators import stats
from tessera.operators.joins import broadcast_checked, dense_index, measured_size, skew_safe_lookup
from tessera.session import materialize

# Scores are compared at this precision when ordering, so that sums taken in
# a different order (other partitioning, other engine) give the same ranks.
SCORE_DIGITS = 9


# ---------------------------------------------------------------- doc keys
def _text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def text_groups(docs: DataFrame) -> DataFrame:
    """(h, mult, text_key, text_idx) of each distinct text, by a SHA-256 of it;
    a null text counts as an empty one."""
    groups = docs.select("doc_id", _text_hash(F.col("text")).alias("h")).groupBy("h").agg(
        F.min("doc_id").alias("text_key"), F.count(F.lit(1)).alias("mult"))
    return dense_index(groups, ["text_key"], "text_idx")


def doc_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, text_idx).

    Documents are grouped by a hash of the text, so no text is shuffled; the
    copies of one text may be a third of all rows, so the join back broadcasts
    the groups with most copies."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = skew_safe_lookup(docs.select("doc_id", _text_hash(F.col("text")).alias("h")), text_groups(docs), "h", "mult")
    return materialize(keyed.select("doc_id", "text_key", "text_idx"), "doc-keys")


# ---------------------------------------------------------------- BM25
def bm25_idf(counts: DataFrame, n_docs: Column, n_qi: str = "document", st: DataFrame | None = None) -> DataFrame:
    """(term, n_qi, idf, df).  idf = ln((N - n + 0.5) / (n + 0.5)), no
    floor (S10).  ``n_qi='collection'`` counts occurrences (S8); a term
    occurring at least N + 0.5 times then has no idf (NULL, S9)."""
    if n_qi not in ("document", "collection"):
        raise ValueError("n_qi must be 'document' or 'collection'")
    st = st if st is not None else stats.term_stats(counts)
    n = F.col("df") if n_qi == "document" else F.col("cf")
    ratio = (n_docs - n + F.lit(0.5)) / (n + F.lit(0.5))
    idf = F.when(ratio > 0, F.ln(ratio))
    return st.select("term", n.cast("long").alias("n_qi"), idf.alias("idf"), "df")


def bm25_weight(cnt: Column, dl: Column, idf: Column, avgdl: Column, k: float, b: float,
                tf: str = "relative", dup: str = "sum") -> Column:
    """F4 per (document, term): idf * TF * (k+1) / (TF + k (1 - b + b dl/avgdl)).
    ``tf='relative'`` uses count/length (S6); ``dup='sum'`` multiplies by the
    count because the reference stores one entry per occurrence (S7)."""
    if tf not in ("relative", "raw") or dup not in ("sum", "once"):
        raise ValueError("tf in {relative, raw}, dup in {sum, once}")
    cnt_d = cnt.cast("double")
    tfv = F.try_divide(cnt_d, dl.cast("double")) if tf == "relative" else cnt_d
    w = idf * tfv * F.lit(k + 1.0) / (tfv + F.lit(k) * (F.lit(1.0 - b) + F.lit(b) * dl.cast("double") / avgdl))
    return w * cnt_d if dup == "sum" else w


def bm25_postings(coll: "Collection", k: float = 2.0, b: float = 0.75,
                  n_qi: str = "document", tf: str = "relative", dup: str = "sum") -> DataFrame:
    """BM25 postings for every document (all copies keep their row).

    N counts every document (empty ones too) and avgdl = total tokens / N
    (S11), both from the counted documents: no statistic re-reads text, and
    nothing but the idf of rare terms beyond the broadcast bound is exchanged."""
    n_docs = coll.n_docs
    avgdl = coll.documents.select(F.sum("dl").cast("double")).scalar() / n_docs
    idf = bm25_idf(coll.counts, n_docs, n_qi, coll.term_stats)
    joined = skew_safe_lookup(coll.keyed_counts, idf, "term", "df")
    weight = bm25_weight(F.col("cnt"), F.col("dl"), F.col("idf"), avgdl, k, b, tf, dup)
    return joined.select("doc_id", "term", "cnt", "dl", "idf", weight.alias("weight"), "text_key", "text_idx")


# ---------------------------------------------------------------- TF-IDF
def vectorizer_counts(counts: DataFrame) -> DataFrame:
    """C4 on the term counts: re-extracting runs of two or more word
    characters from the space-joined tokens equals doing it token by token
    (a run cannot cross the joining space), so counts are split per token
    and re-summed; no text is re-read."""
    rest = [c for c in counts.columns if c not in ("term", "cnt")]
    sub = counts.select(*rest, "cnt", F.explode(F.regexp_extract_all(F.lower("term"), F.lit(VEC_TOKEN_RE), 0)).alias("term"))
    return sub.groupBy("term", *rest).agg(F.sum("cnt").alias("cnt"))


def tfidf_postings(coll: "Collection") -> DataFrame:
    """vectoriser tokens (C4), smooth idf = ln((1+N)/(1+df)) + 1,
    w = count * idf divided by the L2 norm of the document's row."""
    plain = coll.tokenizer is word_tokens and coll.lemmas is None
    if plain:
        # word tokens are maximal word-character runs already: the vectoriser
        # keeps exactly those of two or more characters, no regrouping
        counts, st = coll.keyed_counts.filter(F.length("term") >= 2), coll.term_stats.filter(F.length("term") >= 2)
    else:
        counts = materialize(vectorizer_counts(coll.keyed_counts), "tfidf-counts")
        st = materialize(stats.term_stats(counts), "tfidf-stats")
    idf = st.select("term", "df", (F.ln((F.lit(1.0) + coll.n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    raw = F.col("cnt").cast("double") * F.col("idf")
    # a document's terms lie in one task: its squares are summed there, a row per
    # document is exchanged, and the norm meets the document before its terms are exploded
    norms = skew_safe_lookup(counts, idf, "term", "df").groupBy("doc_id").agg(F.sqrt(F.sum(raw * raw)).alias("norm"))
    norms = broadcast_checked(materialize(norms, "tfidf-norms"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc"))
    norms = norms.withColumnRenamed("doc_id", "_doc")
    if plain:
        held = coll.documents.join(norms, same).select("doc_id", "text_key", "text_idx", "dl", "norm", F.inline("terms"))
        counts = held.filter(F.length("term") >= 2)
    else:
        counts = counts.join(norms, same).drop("_doc")
    joined = skew_safe_lookup(counts, idf, "term", "df")
    return joined.select("doc_id", "term", "cnt", "dl", "idf", F.try_divide(raw, F.col("norm")).alias("weight"), "text_key", "text_idx")


class Collection:
    """one preprocessed collection shared by every model.  Documents are
    tokenised and counted once, row by row, and written with their text keys to
    the shared checkpoint folder on first use.

    ``tokenizer`` cuts texts; ``tokens`` (doc_id, tokens) takes ready tokens from
    any source instead.  ``lemmas`` (form, lemma) replaces every token by its lemma
    (C1; a form without one by its lower case) and keeps those with a word
    character; queries are treated alike, and an index records ``lemma_name``."""

    def __init__(self, docs: DataFrame, tokenizer=word_tokens, id_col: str = "doc_id", text_col: str = "text",
                 tokens: DataFrame | None = None, lemmas: DataFrame | None = None, lemma_name: str = "lemmas"):
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.tokenizer = tokenizer
        self._given = None if tokens is None else tokens.select("doc_id", "tokens")
        self.lemmas = None if lemmas is None else lemmas.select("form", "lemma")
        self.lemma_name = None if lemmas is None else lemma_name
        self._documents = self._keys = self._stats = None

    @property
    def tokens(self) -> DataFrame:
        """(doc_id, tokens) as cut, before any lemma."""
        return stats.tokenize(self.docs, tokenizer=self.tokenizer) if self._given is None else self._given

    def _lemma_rows(self, hashed: DataFrame) -> DataFrame:
        """(doc_id, h, dl, terms) of texts as lemmas, counted where they lie.  Rows that
        share an id are one document, so each has the terms of all; rows without an id
        have none."""
        no_tokens = F.array().cast("array<string>")
        tokens = F.when(F.col("doc_id").isNotNull(), F.coalesce(self.tokenizer(F.col("text")), no_tokens)).otherwise(no_tokens)
        cut = hashed.select("doc_id", "h", tokens.alias("tokens"))
        rows = stats.lemma_counts(materialize(cut.select("doc_id", "h", counted("tokens").alias("terms")), "forms"), self.lemmas)
        again = materialize(self.docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(
            "n > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated-ids")
        if again.isEmpty():
            return rows
        rows, again = materialize(rows, "lemma-rows"), broadcast_checked(again)
        shared = rows.join(again, "doc_id", "left_semi")
        pooled = self._pooled(shared)
        return rows.join(again, "doc_id", "left_anti").select("doc_id", "h", "dl", "terms").unionByName(
            shared.select("doc_id", "h").join(pooled, "doc_id", "left").select("doc_id", "h", "dl", "terms"))

    @staticmethod
    def _pooled(rows: DataFrame) -> DataFrame:
        """(doc_id, dl, terms): the counts of all rows of a document, if any."""
        ex = rows.select("doc_id", F.explode("terms").alias("t")).groupBy("doc_id", F.col("t.term").alias("term")).agg(F.sum("t.cnt").alias("cnt"))
        return ex.groupBy("doc_id").agg(F.sum("cnt").cast("int").alias("dl"),
                                        F.sort_array(F.collect_list(F.struct("term", "cnt"))).alias("terms"))

    @property
    def documents(self) -> DataFrame:
        """(doc_id, text_key, text_idx, dl, terms): one row per document."""
        if self._documents is None:
            no_terms = F.array().cast("array<struct<term:string,cnt:bigint>>")
            hashed = self.docs.select("doc_id", _text_hash(F.col("text")).alias("h"), "text")
            if self._given is None and self.lemmas is None:
                tokens = F.coalesce(self.tokenizer(F.col("text")), F.array().cast("array<string>"))
                cut = hashed.select("doc_id", "h", tokens.alias("tokens"))
                rows = cut.select("doc_id", "h", F.size("tokens").alias("dl"), counted("tokens").alias("terms"))
            elif self._given is None:
                rows = self._lemma_rows(hashed)
            else:
                forms = self.tokens.select("doc_id", F.size("tokens").alias("dl"), counted("tokens").alias("terms"))
                if self.lemmas is not None:
                    forms = self._pooled(stats.lemma_counts(materialize(forms.select("doc_id", "terms"), "forms"), self.lemmas))
                rows = hashed.select("doc_id", "h").join(forms, "doc_id", "left")
            if self._given is not None or self.lemmas is not None:
                rows = rows.select("doc_id", "h", F.greatest(F.coalesce("dl", F.lit(0)), F.lit(0)).alias("dl"),
                                   F.coalesce("terms", no_terms).alias("terms"))
            keyed = skew_safe_lookup(rows, text_groups(self.docs), "h", "mult")
            self._documents = materialize(keyed.select("doc_id", "text_key", "text_idx", "dl", "terms"), "documents")
        return self._documents

    @property
    def keyed_counts(self) -> DataFrame:
        """(doc_id, text_key, text_idx, dl, term, cnt), exploded in place."""
        return self.documents.select("doc_id", "text_key", "text_idx", "dl", F.inline("terms"))

    @property
    def counts(self) -> DataFrame:
        """(doc_id, term, dl, cnt)."""
        return self.keyed_counts.select("doc_id", "term", "dl", "cnt")

    @property
    def term_stats(self) -> DataFrame:
        """(term, df, cf), shared by the idf tables and the vector joins."""
        if self._stats is None:
            self._stats = materialize(stats.term_stats(self.counts), "term-stats")
        return self._stats

    @property
    def keys(self) -> DataFrame:
        if self._keys is None:
            self._keys = self.documents.select("doc_id", "text_key", "text_idx")
        return self._keys

    @property
    def n_docs(self) -> Column:
        return self.documents.select(F.count(F.lit(1))).scalar()

    def query_terms(self, queries: DataFrame, qid: str = "query_id", text: str = "text") -> DataFrame:
        return query_terms(queries, qid, text, self.tokenizer, self.lemmas)


# Tokenisers by the name that an index records.
TOKENIZERS = {"word": word_tokens, "whitespace": ws_tokens}


def tokenizer_name(tokenizer) -> str:
    """The name an index records; a tokeniser of one's own is ``custom``."""
    return next((k for k, f in TOKENIZERS.items() if f is tokenizer), "custom")


@dataclass
class LexicalIndex:
    postings: DataFrame
    doc_keys: DataFrame
    model: str
    tokenizer: str = "word"  # queries are cut like the documents were
    buckets: int = 0  # of a persisted index
    cut: object = field(default=None, repr=False)  # the tokeniser itself, where it is known
    lemmas: DataFrame | None = None
    lemma_name: str | None = None

    @property
    def n_texts(self) -> int:
        last = self.doc_keys.agg(F.max("text_idx")).first()[0]
        return 0 if last is None else last + 1


def build_lexical(docs, model: str = "bm25", tokenizer=word_tokens, **opts) -> LexicalIndex:
    """``docs`` is a documents DataFrame or a shared ``Collection``."""
    coll = docs if isinstance(docs, Collection) else Collection(docs, tokenizer)
    if model == "bm25":
        post = bm25_postings(coll, **opts)
    elif model == "tfidf":
        post = tfidf_postings(coll)
    else:
        raise ValueError(f"unknown lexical model {model!r}")
    return LexicalIndex(post, coll.keys, model, tokenizer_name(coll.tokenizer), cut=coll.tokenizer, lemmas=coll.lemmas,
                        lemma_name=coll.lemma_name)


# ---------------------------------------------------------------- search
# Distinct texts whose scores a task holds at a time, at most.
SHARD_TEXTS = 16_384
# Bytes of the queries of one block, which a task holds; where they are scored all at
# once it holds only numbers of them, so a block is larger and postings travel less often.
QUERY_BLOCK_BYTES = 8 << 20
MANY_BLOCK_BYTES = 64 << 20
# Rows that a task gathers before it packs them by cell and shard.
PACKED_AT_ONCE = 1 << 20
# A block of as many queries is scored all at once, term by term, if positions without
# a match count too; and how many scores (queries x positions) are held for it.
MANY_QUERIES = 1000
SCORES_AT_ONCE = 1 << 22


def query_terms(queries: DataFrame, qid: str = "query_id", text: str = "text",
                tokenizer=word_tokens, lemmas: DataFrame | None = None) -> DataFrame:
    """Distinct query terms (weight 1 each), as lemmas if a table is given."""
    forms = queries.select(F.col(qid).alias("query_id"), F.explode(tokenizer(F.col(text))).alias("term")).distinct()
    if lemmas is None:
        return forms
    found = stats.lemma_lookup(materialize(forms.withColumnRenamed("term", "form"), "query-forms"), lemmas)
    return found.filter(has_word_char(F.col("lemma"))).select("query_id", F.col("lemma").alias("term")).distinct()


def _top_k(df: DataFrame, k: int, order: list[Column], part: str = "query_id") -> DataFrame:
    """Per-query top-k; plans a partial group limit before the shuffle."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def score_shard(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Best positions of one query in a shard of ``size`` positions, from the
    postings (sorted positions, weights) of its terms: (positions, scores, which
    positions have a term at all).

    The terms of highest weight are added first.  Once the k-th best score is out
    of reach for a position without any of them (`floor`: the k-th best of earlier
    shards, if positive), the scan ends: the terms left are only looked up for the
    positions that can still be among the best, and None stands for the matches,
    as no position without a match (score 0) is among the best either."""
    lists = sorted(lists, key=lambda x: -x[1].max())
    most = np.cumsum([max(0.0, w.max()) for _, w in lists][::-1])[::-1]  # of this term and those behind it
    least = np.cumsum([min(0.0, w.min()) for _, w in lists][::-1])[::-1]
    scores, seen = np.zeros(size), np.zeros(size, bool)
    slack = 10.0 ** -SCORE_DIGITS * 2
    for n, (at, w) in enumerate(lists):
        if n and sum(len(x) for x, _ in lists[n:]) > 4 * k:
            touched = np.flatnonzero(seen)
            kth = np.partition(scores[touched], -k)[-k] + least[n] if len(touched) >= k else -np.inf
            kth = max(kth, floor)
            if kth > most[n] + slack:
                best, sums = touched, scores[touched]
                for m, (at, w) in enumerate(lists[n:], n):
                    if len(best) > k:
                        kth = max(kth, np.partition(sums, -k)[-k] + least[m])
                    hold = sums + most[m] >= kth - slack
                    best, sums = best[hold], sums[hold]
                    place = np.searchsorted(at, best)
                    place[place == len(at)] = 0
                    sums = sums + np.where(at[place] == best, w[place], 0.0)
                return best, sums, None
        scores[at] += w
        seen[at] = True
    touched = np.flatnonzero(seen)
    return touched, scores[touched], seen


class _Cell:
    """Running results of the queries of a block over the shards of a group."""

    def __init__(self, terms: dict, queries: list, group: int, groups: int, shard_texts: int, n_texts: int, k: int, fill: bool):
        self.queries, self.k, self.fill = queries, k, fill
        self.by_term: dict[str, list[int]] = terms
        self.next, self.groups, self.size, self.n_texts = group, groups, shard_texts, n_texts
        none = np.zeros(0, np.int64)
        self.best = [(none, none, np.zeros(0)) for _ in queries]  # position, document, score
        self.free: list[list[int]] = [[] for _ in queries]

    def _needy(self, q: int) -> bool:
        """Whether positions without a match may be among the query's best."""
        best = self.best[q][2]
        return self.fill and len(self.free[q]) < self.k and (len(best) < self.k or np.round(best[-1], SCORE_DIGITS) <= 0)

    def _add_free(self, q: int, shard: int, seen: np.ndarray | None) -> None:
        start, end = shard * self.size, min((shard + 1) * self.size, self.n_texts)
        wanted = self.k - len(self.free[q])
        free = np.arange(min(end - start, wanted)) if seen is None else np.flatnonzero(~seen[:end - start])[:wanted]
        self.free[q] += (free + start).tolist()

    def skip_to(self, shard: int) -> None:
        """The group's shards before `shard` that hold none of the batch's terms."""
        while self.next < shard and self.next * self.size < self.n_texts:
            needy = [q for q in range(len(self.queries)) if self._needy(q)]
            if not needy:
                break
            for q in needy:
                self._add_free(q, self.next, None)
            self.next += self.groups
        self.next = max(self.next, shard)

    def score(self, shard: int, terms: np.ndarray, at: np.ndarray, docs: np.ndarray, weights: np.ndarray, names: list[str]) -> None:
        self.skip_to(shard)
        self.next = shard + self.groups
        order = np.lexsort((at, terms))
        terms, at, docs, weights = terms[order], at[order] - shard * self.size, docs[order], weights[order]
        doc_at = np.zeros(self.size, np.int64)
        doc_at[at] = docs
        cuts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
        lists: dict[int, list] = {}
        for a, b in zip(cuts, np.r_[cuts[1:], len(terms)]):
            for q in self.by_term[names[terms[a]]]:
                lists.setdefault(q, []).append((at[a:b], weights[a:b]))
        for q in range(len(self.queries)):
            if q not in lists:
                if self._needy(q):
                    self._add_free(q, shard, None)
                continue
            held, held_docs, held_scores = self.best[q]
            floor = held_scores[-1] if len(held) >= self.k and held_scores[-1] > 0 else -np.inf
            found, scores, seen = score_shard(lists[q], self.size, self.k, floor)
            places = np.concatenate([held, found + shard * self.size])
            scores = np.concatenate([held_scores, scores])
            top = np.lexsort((places, -np.round(scores, SCORE_DIGITS)))[:self.k]
            self.best[q] = places[top], np.concatenate([held_docs, doc_at[found]])[top], scores[top]
            if seen is not None and self._needy(q):
                self._add_free(q, shard, seen)

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        self.skip_to(self.n_texts // self.size + 1)
        out: list[tuple] = []
        for q, name in enumerate(self.queries):
            out += [(name, p, d, s) for p, d, s in zip(*(x.tolist() for x in self.best[q]))]
            out += [(name, p, None, 0.0) for p in self.free[q]]
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), pa.int64(), pa.float64()))],
                                          names=["query_id", "text_idx", "doc_id", "score"])


class _ManyCell:
    """A cell of many queries where positions without a match score 0: a shard's scores
    are a table (queries, positions), to which each term adds its weights for all
    queries that ask for it, and the best k of each row are merged into the results."""

    UNKNOWN = -(1 << 63)  # document of a position without a match, named later
    NO_PLACE = (1 << 63) - 1

    def __init__(self, terms: dict, queries: list, group: int, groups: int, shard_texts: int, n_texts: int, k: int):
        self.queries, self.k = queries, k
        self.by_term = {t: np.sort(np.asarray(q, np.int64)) for t, q in terms.items()}
        self.next, self.groups, self.size, self.n_texts = group, groups, shard_texts, n_texts
        shape = (len(queries), k)
        self.places, self.docs = np.full(shape, self.NO_PLACE), np.full(shape, self.UNKNOWN)
        self.scores = np.full(shape, -np.inf)

    def _merge(self, a: int, b: int, places: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """The best of the queries from a to b, those of a shard included."""
        held = [np.concatenate([own[a:b], x], axis=1) for own, x in ((self.places, places), (self.docs, docs), (self.scores, scores))]
        top = np.lexsort((held[0], -np.round(held[2], SCORE_DIGITS)), axis=-1)[:, :self.k]
        self.places[a:b], self.docs[a:b], self.scores[a:b] = (np.take_along_axis(x, top, axis=1) for x in held)

    def skip_to(self, shard: int) -> None:
        """The group's shards before `shard` hold none of the batch's terms."""
        while self.next < shard and self.next * self.size < self.n_texts:
            if (np.round(self.scores[:, -1], SCORE_DIGITS) > 0).all():
                break
            start = self.next * self.size
            first = np.arange(start, min(start + self.k, start + self.size, self.n_texts))
            shape = (len(self.queries), len(first))
            self._merge(0, len(self.queries), np.broadcast_to(first, shape), np.full(shape, self.UNKNOWN), np.zeros(shape))
            self.next += self.groups
        self.next = max(self.next, shard)

    def score(self, shard: int, terms: np.ndarray, at: np.ndarray, docs: np.ndarray, weights: np.ndarray, names: list[str]) -> None:
        self.skip_to(shard)
        self.next = shard + self.groups
        start = shard * self.size
        width = min(self.size, self.n_texts - start)
        order = np.lexsort((at, terms))
        terms, at, weights = terms[order], at[order] - start, weights[order]
        doc_at = np.full(width, self.UNKNOWN)
        doc_at[at] = docs[order]
        cuts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1], True]).tolist()
        lists = [(self.by_term[names[terms[i]]], at[i:j], weights[i:j]) for i, j in zip(cuts, cuts[1:])]
        step, best = max(1, SCORES_AT_ONCE // width), min(self.k, width)
        for a in range(0, len(self.queries), step):
            b = min(len(self.queries), a + step)
            sums = np.zeros((b - a, width))
            for asking, places, w in lists:
                own = asking[np.searchsorted(asking, a):np.searchsorted(asking, b)] - a
                if len(own):
                    sums[own[:, None], places] += w
            ranked = np.round(sums, SCORE_DIGITS)
            kth = np.partition(ranked, width - best, axis=1)[:, width - best, None]
            above, tied = ranked > kth, ranked == kth
            left = best - above.sum(axis=1, keepdims=True)  # of those that tie, the first places
            row, place = np.nonzero(above | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= left)))
            shape = (b - a, best)
            self._merge(a, b, place.reshape(shape) + start, doc_at[place].reshape(shape), sums[row, place].reshape(shape))

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        self.skip_to(self.n_texts // self.size + 1)
        row, column = np.nonzero(self.places != self.NO_PLACE)
        docs = self.docs[row, column]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.queries, id_type).take(pa.array(row)), pa.array(self.places[row, column]),
             pa.array(docs, mask=docs == self.UNKNOWN), pa.array(self.scores[row, column])], names=["query_id", "text_idx", "doc_id", "score"])


def _packing(names: list[str]):
    """Rows (cell, shard, term, ...) to (cell, shard, packed): the columns `names` of
    the rows of the same cell and shard as one compressed value, in the order they
    came (a document's postings lie together), their terms coded."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        table = pa.Table.from_batches(held).combine_chunks()
        cell, shard = (table.column(c).to_numpy() for c in ("cell", "shard"))
        order = np.lexsort((shard, cell))  # stable
        table, cell, shard = table.take(pa.array(order)), cell[order], shard[order]
        cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (shard[1:] != shard[:-1]), True]).tolist()
        values = []
        for a, b in zip(cuts, cuts[1:]):
            part = table.slice(a, b - a).select(names).combine_chunks()
            at = names.index("term")
            part = part.set_column(at, "term", part.column(at).combine_chunks().dictionary_encode())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_table(part)
            values.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(cell[cuts[:-1]]), pa.array(shard[cuts[:-1]]), pa.array(values, pa.binary())],
                                          names=["cell", "shard", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= PACKED_AT_ONCE:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


PACKED = "cell long, shard long, packed binary"


def _unpacked(values: list[pa.Buffer]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in values]).unify_dictionaries().combine_chunks()


def _score_cells(groups: int, blocks: int, shard_texts: int, n_texts: int, k: int, fill: bool):
    """Streams cells (their queries, then their postings by shard) into results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell, held, id_type = None, None, [], None
        terms, queries = {}, {}

        def opened() -> _Cell | _ManyCell:
            asking = {t: np.concatenate(places) for t, places in terms.items()}
            if fill and len(queries) >= MANY_QUERIES:
                return _ManyCell(asking, list(queries), int(now[0]) // blocks, groups, shard_texts, n_texts, k)
            return _Cell({t: x.tolist() for t, x in asking.items()}, list(queries), int(now[0]) // blocks, groups, shard_texts, n_texts, k, fill)

        def flush() -> None:
            """Scores the shard whose postings are held."""
            if held:
                part = _unpacked(held)
                held.clear()
                coded = part.column("term").combine_chunks()
                cell.score(int(now[1]), coded.indices.to_numpy(), part.column("text_idx").to_numpy(),
                           part.column("doc_id").to_numpy(), part.column("weight").to_numpy(), coded.dictionary.to_pylist())

        for batch in batches:
            if not batch.num_rows:
                continue
            key, shard = batch.column("cell").to_numpy(), batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])]).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(key)]):
                part = batch.slice(a, b - a)
                if (key[a], shard[a]) != now:
                    flush()
                    if now is not None and key[a] != now[0]:
                        yield (cell or opened()).rows(id_type)
                        terms, queries, cell = {}, {}, None
                    now = (key[a], shard[a])
                if shard[a] < 0:  # the queries come first
                    for value in part.column("packed"):
                        asked = _unpacked([value.as_buffer()])
                        id_type = asked.schema.field("query_id").type
                        place = np.array([queries.setdefault(q, len(queries)) for q in asked.column("query_id").to_pylist()], np.int64)
                        coded = asked.column("term").combine_chunks()
                        some = np.flatnonzero(coded.is_valid().to_numpy(zero_copy_only=False))
                        code = coded.indices.take(pa.array(some)).to_numpy(zero_copy_only=False)
                        order = np.argsort(code, kind="stable")
                        code, place = code[order], place[some][order]
                        cuts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else []
                        names = coded.dictionary.to_pylist()
                        for at, own in zip(cuts, np.split(place, cuts[1:])):
                            terms.setdefault(names[code[at]], []).append(own)
                else:
                    cell = cell or opened()
                    held.extend(x.as_buffer() for x in part.column("packed"))
        flush()
        if now is not None:
            yield (cell or opened()).rows(id_type)

    return run


def _query_blocks(qt: DataFrame, fill: bool) -> int:
    """Number of blocks of the queries (query_id, term).  Where positions without a
    match count too, blocks are large ones if each still has MANY_QUERIES."""
    size = measured_size(qt)[1]
    large = max(1, -(-size // MANY_BLOCK_BYTES))
    if fill and size > QUERY_BLOCK_BYTES and qt.select(F.approx_count_distinct("query_id")).first()[0] >= 2 * MANY_QUERIES * large:
        return large
    return max(1, -(-size // QUERY_BLOCK_BYTES))


def search(index: LexicalIndex, queries: DataFrame, k: int = 10, fill_zero: bool = True,
           qid: str = "query_id", text: str = "text", tokenizer=None) -> DataFrame:
    """(query_id, rank, doc_id, score) for many queries at once.

    Documents are deduplicated by text (S1, representative = smallest doc_id);
    ties are broken by collection order (S2); documents without any query term
    take score 0 and fill the top-k (S3) unless ``fill_zero=False``.

    Postings of the batch's terms and copies of the queries meet in cells
    (group of shards, block of queries).  What is exchanged is a posting per block
    that asks for its term, packed with those of its shard, a packed copy of the
    queries per group, and at most 2 k results per cell and query; a pair
    of query and text is never a row."""
    cut = tokenizer or index.cut or TOKENIZERS.get(index.tokenizer)
    if cut is None:
        raise ValueError("the index was built with a tokenizer of your own: pass it to the search too")
    spark = index.postings.sparkSession
    qids = queries.select(F.col(qid).alias("query_id")).distinct()
    qt = qids.join(query_terms(queries, qid, text, cut, index.lemmas), "query_id", "left")
    qt = materialize(qt, "query-terms")
    blocks = _query_blocks(qt, fill_zero)
    n_texts = index.n_texts
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = -(-2 * parts // blocks)  # groups of shards: about 2 cells a partition in all
    size = max(256, min(SHARD_TEXTS, -(-n_texts // spans)))
    groups = max(1, min(spans, -(-n_texts // size)))
    qt = qt.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("long"))

    wanted, on = qt.filter(F.col("term").isNotNull()).select("term", "block").distinct(), ["term"]
    if index.buckets:
        # the bucket is a partition column: dynamic partition pruning reads
        # only the buckets of the batch's terms, whatever the batch's size
        wanted, on = wanted.withColumn("term_bucket", term_bucket("term", index.buckets)), ["term_bucket", "term"]
    shard = F.floor(F.col("text_idx") / size).cast("long")
    # where positions without a match take score 0, a weight of 0 (S9: no idf) changes
    # nothing: such postings, of the commonest terms, stay out of the exchange
    some = F.coalesce("weight", F.lit(0.0)) != 0 if fill_zero else F.lit(True)
    hits = (index.postings.filter((F.col("doc_id") == F.col("text_key")) & some).join(broadcast_checked(wanted), on)
            .select((shard % groups * blocks + F.col("block")).alias("cell"), shard.alias("shard"), "term", "text_idx",
                    F.col("text_key").alias("doc_id"), F.coalesce("weight", F.lit(0.0)).alias("weight")))  # S9: no idf, nothing added
    every_group = F.sequence(F.col("block"), F.col("block") + (groups - 1) * blocks, F.lit(blocks).cast("long"))
    asked = qt.select(F.col("block").alias("cell"), F.lit(-1).cast("long").alias("shard"), "term", "query_id").mapInArrow(
        _packing(["term", "query_id"]), PACKED).withColumnRenamed("cell", "block")
    asked = asked.select(F.explode(every_group).alias("cell"), "shard", "packed")
    id_type = qt.schema["query_id"].dataType.simpleString()
    hits = hits.mapInArrow(_packing(["term", "text_idx", "doc_id", "weight"]), PACKED)
    cells = (hits.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "shard")
             .mapInArrow(_score_cells(groups, blocks, size, n_texts, k, fill_zero),
                         f"query_id {id_type}, text_idx long, doc_id long, score double"))
    order = [F.round(F.col("score"), SCORE_DIGITS).desc(), F.col("text_idx").asc()]
    top = _top_k(cells, k, order)
    if not fill_zero:
        return top.select("query_id", "rank", "doc_id", "score")
    # at most k rows per query; positions without a match are looked up by position
    top = materialize(top, "search-topk")
    free = top.filter("doc_id IS NULL")
    if free.isEmpty():
        return top.select("query_id", "rank", "doc_id", "score")
    first = index.doc_keys.filter(F.col("doc_id") == F.col("text_key")).select("text_idx", "doc_id")
    named = first.join(broadcast_checked(free.drop("doc_id")), "text_idx")
    return top.filter("doc_id IS NOT NULL").unionByName(named).select("query_id", "rank", "doc_id", "score")


def attach_text(results: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Original text for the (at most k per query) result rows; the texts
    stay where they are if the rows are few enough to broadcast."""
    results = broadcast_checked(materialize(results, "search-results"))
    return results.join(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id")


def dedupe_by_text(scored: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per (query, text): first position, score of the last copy."""
    j = scored.join(keys.select("doc_id", "text_key"), "doc_id")
    return j.groupBy("query_id", "text_key").agg(
        F.min("doc_id").alias("doc_id"), F.max_by("score", "doc_id").alias("score"))


# Default number of hash buckets that a persisted index's postings are
# partitioned by; an index records its own number.
TERM_BUCKETS = 8


def term_bucket(term, buckets: int) -> Column:
    t = F.col(term) if isinstance(term, str) else term
    return F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")


def save_lexical(index: LexicalIndex, path: str, partitions: int | None = None, buckets: int = TERM_BUCKETS) -> int:
    """Persist postings partitioned by term bucket and sorted by term inside
    each file (row-group statistics prune too), the doc keys, and what a
    reader must know of the layout: bucket count, model, tokeniser and lemma
    table.  Returns the number of postings.

    Postings are written by the task that holds their documents, without an
    exchange (``partitions`` deals them by position first): a term that most
    documents hold lies in the files of all tasks."""
    spark = index.postings.sparkSession
    order = ["term_bucket", "term", "text_idx"]
    post = index.postings.withColumn("term_bucket", term_bucket("term", buckets))
    post = post.repartition(partitions, "text_idx", "doc_id") if partitions else post
    post.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/postings")
    index.doc_keys.write.mode("overwrite").parquet(f"{path}/doc_keys")
    if index.lemmas is not None:
        index.lemmas.write.mode("overwrite").parquet(f"{path}/lemmas")
    # the schema too: an index without postings has no files to tell it
    (spark.createDataFrame([(index.model, index.tokenizer, buckets, index.lemma_name, post.schema.json())],
                           "model string, tokenizer string, buckets int, lemma_name string, schema string")
     .write.mode("overwrite").parquet(f"{path}/layout"))
    return spark.read.schema(post.schema).parquet(f"{path}/postings").count()  # from the files' footers


def load_lexical(spark, path: str, model: str | None = None) -> LexicalIndex:
    layout = spark.read.parquet(f"{path}/layout").first()
    if model is not None and model != layout["model"]:
        raise ValueError(f"{path} holds {layout['model']!r}, not {model!r}")
    read = spark.read.parquet
    lemmas = read(f"{path}/lemmas") if layout["lemma_name"] else None
    postings = spark.read.schema(T.StructType.fromJson(json.loads(layout["schema"]))).parquet(f"{path}/postings")
    return LexicalIndex(postings, read(f"{path}/doc_keys"), layout["model"], layout["tokenizer"],
                        layout["buckets"], lemmas=lemmas, lemma_name=layout["lemma_name"])
