"""Dense vector models.

* Vector sums per key use MLlib's ``Summarizer``: a JVM aggregate with map-side
  partial aggregation that takes any dimension.
* Mean word vectors are summed where the documents lie: the vectors of frequent
  words are broadcast up to a measured bound and multiplied there by the counts, so
  what is exchanged is one sum per document, and only the tail of rare words beyond
  the bound is joined by a shuffle.
* Brute-force cosine top-k (D4) deals queries and items into cells (item group,
  query block) by one shuffle; a cell holds a block of queries as a NumPy matrix,
  streams its items past it in slices of bounded size, and only its running
  top-k per query leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import counted, word_tokens
from tessera.operators import stats
from tessera.operators.joins import broadcast_checked, dense_index, hot_frequency, skew_safe_lookup
from tessera.session import materialize

# Numbers of the query matrix of a block, and of the distances held at a time.
BLOCK_NUMBERS = 1 << 20
HELD_NUMBERS = 1 << 21
# Bound of the broadcast word vectors, at eight bytes a number.
HOT_WORD_BYTES = 256 * 1024 * 1024
DIST_DIGITS = 9


def scaled(vec, w) -> Column:
    vc = F.col(vec) if isinstance(vec, str) else vec
    wc = F.col(w) if isinstance(w, str) else w
    return F.transform(vc, lambda x: x.cast("double") * wc.cast("double"))


def vector_sum(df: DataFrame, keys: list[str], vec: Column, extra: dict | None = None) -> DataFrame:
    """M4: element-wise sum of ARRAY vectors of any dimension per key (double
    accumulation), with map-side partial aggregation."""
    extra_aggs = [c.alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(*keys).agg(vector_to_array(Summarizer.sum(array_to_vector(vec.cast("array<double>")))).alias("vec"), *extra_aggs)


# ------------------------------------------------------------- word vectors
def derived_word_vectors(vocab: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Test-data rule: a term's 0-based rank in the sorted
    vocabulary modulo the number of embedding rows is its ``vec_id``."""
    n_emb = embeddings.select(F.count(F.lit(1))).scalar()
    ranked = dense_index(vocab.select("term").distinct(), ["term"], "rank")
    keyed = ranked.select("term", F.pmod(F.col("rank"), n_emb).alias("vec_id"))
    return keyed.join(embeddings.select("vec_id", "embedding"), "vec_id").select(
        F.col("term").alias("word"), F.col("embedding").alias("vec"))


def _word_matrix(words: DataFrame, dim: int) -> tuple[pa.Array, np.ndarray]:
    """(words, a row of numbers per word) of a bounded table (term, vec); the
    vectors of a word listed twice are added."""
    held = words.select("term", "vec").filter(F.col("vec").isNotNull()).toArrow().combine_chunks()
    if not held.num_rows:
        return pa.array([], pa.string()), np.zeros((0, dim), np.float32)
    coded = pc.dictionary_encode(pc.cast(held.column("term").combine_chunks(), pa.string()))
    column = held.column("vec").combine_chunks()
    matrix = column.flatten().to_numpy(zero_copy_only=False)
    if len(matrix) != len(column) * dim:
        raise ValueError(f"vectors of other than {dim} dimensions")
    matrix = matrix.reshape(len(column), dim)
    if len(coded.dictionary) < len(coded):
        total = np.zeros((len(coded.dictionary), dim))
        np.add.at(total, coded.indices.to_numpy(), matrix)
        matrix = total
    return coded.dictionary, matrix


def _known_sums(words, dim: int):
    """(doc_id, part): the sum of count times vector over the broadcast words of a
    row (doc_id, terms)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = words.value
        rows = max(1, HELD_NUMBERS // max(1, dim))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                own = batch.slice(start, rows)
                lists = own.column("terms")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                at = pc.fill_null(pc.index_in(flat.field("term"), value_set=names), -1).to_numpy(zero_copy_only=False)
                hit = np.flatnonzero(at >= 0)
                row, at = np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]
                cnt = flat.field("cnt").to_numpy(zero_copy_only=False).astype(np.float64)[hit]
                sums = np.zeros((len(sizes), dim))
                for a in range(0, len(hit), rows):
                    r = row[a:a + rows]
                    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                    sums[r[first]] += np.add.reduceat(matrix[at[a:a + rows]] * cnt[a:a + rows, None], first, axis=0)
                found = np.unique(row)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id").take(pa.array(found)), double_lists(sums[found])], names=["doc_id", "part"])

    return run


def double_lists(x: np.ndarray, null: np.ndarray | None = None) -> pa.ListArray:
    """Rows as Arrow lists; those of ``null`` are null."""
    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int64) * x.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x, np.float64).reshape(-1)),
                                    mask=None if null is None else pa.array(null))


def _means(dim: int):
    """(doc_id, vec) for every length of a document, from rows sorted by document:
    its lengths, the sums over its broadcast words, and its other words' vectors
    with their counts.  Null where there is no vector or no token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document that goes on: id (one row), sum, whether it has a vector, lengths

        def made(ids: pa.Array, total: np.ndarray, some: np.ndarray, dl: np.ndarray) -> pa.RecordBatch:
            vec = total / np.maximum(dl, 1)[:, None]
            return pa.RecordBatch.from_arrays([ids, double_lists(vec, ~some | (dl <= 0))], names=["doc_id", "vec"])

        def flush() -> pa.RecordBatch:
            own, total, some, dl = held
            n = len(dl)
            return made(own.take(pa.array(np.zeros(n, np.int64))), np.repeat(total[None, :], n, 0), np.full(n, some), np.array(dl, np.int64))

        rows = max(1, HELD_NUMBERS // max(1, dim))
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                column = batch.column("doc_id")
                ids = column.to_numpy(zero_copy_only=False)
                x, some = np.zeros((len(ids), dim)), np.zeros(len(ids), bool)
                for name, cnt in (("part", None), ("vec", batch.column("cnt"))):
                    has = batch.column(name).is_valid().to_numpy(zero_copy_only=False)
                    part = _matrix(batch.column(name).drop_null(), dim)
                    x[has] = part if cnt is None else part * cnt.to_numpy(zero_copy_only=False)[has][:, None]
                    some |= has
                cuts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
                total, some = np.add.reduceat(x, cuts, axis=0), np.logical_or.reduceat(some, cuts)
                long = np.flatnonzero(batch.column("dl").is_valid().to_numpy(zero_copy_only=False))
                dl = batch.column("dl").take(pa.array(long)).to_numpy(zero_copy_only=False)
                group = np.searchsorted(cuts, long, "right") - 1
                before: list[int] = []
                if held is not None:
                    if held[0][0].as_py() == column[0].as_py():
                        total[0] += held[1]
                        some[0] |= held[2]
                        before = held[3]
                    elif held[3]:
                        yield flush()
                last = len(cuts) - 1
                if before and last:  # lengths of the first document that came with earlier rows
                    held = column.slice(0, 1), total[0], some[0], before
                    yield flush()
                    before = []
                done = group < last
                if done.any():
                    yield made(column.take(pa.array(long[done])), total[group[done]], some[group[done]], dl[done])
                held = column.slice(cuts[last], 1), total[last].copy(), bool(some[last]), [*before, *dl[~done].tolist()]
        if held is not None and held[3]:
            yield flush()

    return run


def mean_word_vectors(counts: DataFrame, lengths: DataFrame, word_vectors: DataFrame, dim: Column,
                      term_freq: DataFrame | None = None) -> DataFrame:
    """(doc_id, vec) = sum of word vectors over all tokens divided by
    the token count (S14); words without a vector add zero (S15); a document
    with no token or no vector gets a zero vector.

    ``counts`` are (doc_id, term, cnt), or (doc_id, terms) with all terms of a
    document in one row.  The words of most documents, as many as HOT_WORD_BYTES
    hold, are broadcast, and their sums are made where the document lies: what is
    exchanged is one sum per document and the vectors of its rare words."""
    if "terms" not in counts.columns:
        counts = counts.groupBy("doc_id").agg(F.collect_list(F.struct("term", F.col("cnt").cast("long").alias("cnt"))).alias("terms"))
    counts = counts.select("doc_id", "terms")
    hits = counts.select("doc_id", F.inline("terms"))
    df_per_term = (term_freq.select("term", F.col("df").alias("freq")) if term_freq is not None
                   else hits.groupBy("term").agg(F.count(F.lit(1)).alias("freq")))
    wv = materialize(word_vectors.select(F.col("word").alias("term"), "vec").join(df_per_term, "term"), "word-vectors-used")
    size = vector_dim(wv)
    at_least = hot_frequency(wv, "freq", HOT_WORD_BYTES)
    is_hot = F.coalesce(F.col("freq") >= at_least, F.lit(False)) if at_least else F.lit(True)
    hot = wv.filter(is_hot)
    sent = counts.sparkSession.sparkContext.broadcast(_word_matrix(hot, size))
    id_type = counts.schema["doc_id"].dataType.simpleString()
    rows = lengths.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("dl").cast("long").alias("dl")).unionByName(
        counts.mapInArrow(_known_sums(sent, size), f"doc_id {id_type}, part array<double>"), allowMissingColumns=True)
    if at_least:
        cold = wv.filter(~is_hot).select("term", "vec")
        rest = hits.join(F.broadcast(hot.select("term").distinct()), "term", "left_anti").join(cold, "term").select(
            "doc_id", F.col("cnt").cast("double").alias("cnt"), "vec")
        rows = rows.unionByName(rest, allowMissingColumns=True)
    else:
        rows = rows.withColumns({"cnt": F.lit(None).cast("double"), "vec": F.lit(None).cast("array<float>")})
    known = F.col("doc_id").isNotNull()  # a row without an id has no terms of its own
    means = (rows.filter(known).repartition("doc_id").sortWithinPartitions("doc_id").select("doc_id", "dl", "part", "cnt", "vec")
             .mapInArrow(_means(size), f"doc_id {id_type}, vec array<double>"))
    zero = F.array_repeat(F.lit(0.0), F.lit(dim) if isinstance(dim, int) else dim)
    unknown = lengths.select("doc_id").filter(~known).withColumn("vec", F.lit(None).cast("array<double>"))
    return means.unionByName(unknown).select("doc_id", F.coalesce("vec", zero).alias("vec"))


def fasttext_model(coll, embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F7 over a shared ``Collection`` (or a documents DataFrame):
    (word_vectors, doc_vectors).  The vocabulary comes from the same
    checkpointed term counts that feed the mean vectors."""
    from tessera.operators.lexical import Collection

    coll = coll if isinstance(coll, Collection) else Collection(coll)
    wv = collection_words(coll, embeddings)
    return wv, collection_vectors(coll, wv)


def collection_words(coll, embeddings: DataFrame) -> DataFrame:
    """Word vectors (word, vec) of a ``Collection``'s vocabulary, from its term counts."""
    return materialize(derived_word_vectors(coll.term_stats.select("term"), embeddings), "word-vectors")


def vector_dim(word_vectors: DataFrame) -> int:
    return word_vectors.select(F.max(F.size("vec"))).first()[0] or 0


def collection_vectors(coll, word_vectors: DataFrame) -> DataFrame:
    """F7 with word vectors (word, vec) of your own: (doc_id, vec)."""
    return mean_word_vectors(coll.documents.select("doc_id", "terms"), coll.documents.select("doc_id", "dl"), word_vectors,
                             vector_dim(word_vectors), coll.term_stats)


def text_vectors(texts: DataFrame, word_vectors: DataFrame, dim: Column, id_col: str = "doc_id",
                 text_col: str = "text", tokenizer=word_tokens, lemmas: DataFrame | None = None) -> DataFrame:
    """E12 for texts of their own (queries), cut like the collection that they
    are compared with."""
    tok = stats.tokenize(texts, id_col, text_col, tokenizer)
    if lemmas is not None:
        found = stats.lemma_tokens(tok, lemmas).groupBy("doc_id").agg(F.collect_list("lemma").alias("tokens"))
        tok = tok.select("doc_id").join(found, "doc_id", "left").select(
            "doc_id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    tok = materialize(tok, "text-tokens")
    counts = materialize(tok.select("doc_id", counted("tokens").alias("terms")), "vec-counts")
    return mean_word_vectors(counts, stats.doc_lengths(tok), word_vectors, dim)


def first_of_text(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of the rows that share a text the one with the smallest id; a null
    text counts as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return texts.groupBy(text.alias(text_col)).agg(F.min(id_col).alias(id_col))


# ------------------------------------------------------------- brute force
def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * dim:
        raise ValueError(f"vectors of other than {dim} dimensions")
    return flat.reshape(len(column), dim)


def nearest(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries x k ids, queries x k distances) of the nearest rows of ``x``, equal
    distances in order of id; missing ones have distance infinity."""
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    den = np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((queries * queries).sum(axis=1))[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        dist = np.where(den == 0, np.inf, 1.0 - (x @ queries.T) / den)  # S13: zero vector -> no distance
    dist[np.isnan(dist)] = np.inf
    key = np.round(dist, DIST_DIGITS)
    k = min(k, len(x))
    kth = np.partition(key, k - 1, axis=0)[k - 1]
    less, same = key < kth, key == kth
    # the k rows of each query: all below the k-th distance, and of those at it the first
    take = (less | same & (np.cumsum(same, axis=0) <= k - less.sum(axis=0))).T
    q, row = np.nonzero(take)
    return ids[row].reshape(len(queries), k), dist[row, q].reshape(len(queries), k)


class _Nearest:
    """Running top-k of a block of queries."""

    def __init__(self, names: list, queries: np.ndarray, k: int):
        self.names, self.queries, self.k = names, queries, k
        self.ids, self.dist = np.zeros((len(names), 0), np.int64), np.zeros((len(names), 0))

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        rows = max(1, HELD_NUMBERS // max(1, len(self.names)))
        for at in range(0, len(ids), rows):
            found, dist = nearest(x[at:at + rows], ids[at:at + rows], self.queries, self.k)
            found, dist = np.hstack([self.ids, found]), np.hstack([self.dist, dist])
            best = np.lexsort((found, np.round(dist, DIST_DIGITS)), axis=1)[:, :self.k]
            self.ids, self.dist = np.take_along_axis(found, best, 1), np.take_along_axis(dist, best, 1)

    def rows(self) -> pa.RecordBatch:
        q, place = np.nonzero(np.isfinite(self.dist))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(self.names, np.int64)[q], pa.int64()), pa.array(self.ids[q, place], pa.int64()),
             pa.array(self.dist[q, place])], names=["query_id", "item", "score"])


def _nearest_cells(dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, parts, block = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, is_item = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (is_item[1:] != is_item[:-1])]).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(key)]):
                if key[a] != now:
                    if block is not None:
                        yield block.rows()
                    now, names, parts, block = key[a], [], [], None
                part = batch.slice(a, b - a)
                if not is_item[a]:  # the queries come first
                    names += part.column("id").to_pylist()
                    parts.append(_matrix(part.column("asked"), dim))
                elif names:
                    block = block or _Nearest(names, np.concatenate(parts), k)
                    block.add(part.column("id").to_numpy(), _matrix(part.column("vec"), dim))
        if block is not None:
            yield block.rows()

    return run


def cosine_topk(items: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Per query the k items with the smallest cosine
    distance (ascending, ties by item id, NULL distances excluded).

    ``items(id_col, vec)``, ``queries(query_id, vec)``; rows without a vector take
    no part.  A block has at most BLOCK_NUMBERS numbers of queries; an item is
    shuffled once per block, a query once per item group."""
    spark = items.sparkSession
    items, queries = items.filter(F.col("vec").isNotNull()), queries.filter(F.col("vec").isNotNull())
    n_q, dim = queries.select(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    blocks = max(1, -(-n_q * (dim or 1) // BLOCK_NUMBERS))
    groups = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    group, block = F.pmod(F.xxhash64(id_col), F.lit(groups)) * blocks, F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    dealt = items.select(F.explode(F.sequence(group, group + (blocks - 1))).alias("cell"),
                         F.lit(1).alias("kind"), F.col(id_col).cast("long").alias("id"), "vec")
    asked = queries.select(F.explode(F.sequence(block, block + (groups - 1) * blocks, F.lit(blocks).cast("long"))).alias("cell"),
                           F.lit(0).alias("kind"), F.col("query_id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("asked"))
    cells = (dealt.unionByName(asked, allowMissingColumns=True).repartition("cell").sortWithinPartitions("cell", "kind")
             .select("cell", "kind", "id", "vec", "asked")
             .mapInArrow(_nearest_cells(dim or 0, k), "query_id long, item long, score double"))
    w = Window.partitionBy("query_id").orderBy(F.round("score", DIST_DIGITS), F.col("item"))
    best = cells.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("item").alias(id_col), "score", "rank")


# ------------------------------------------------------------- layers
def token_vectors_from_embeddings(emb: DataFrame, n_layers: int = 3, per_sentence: int = 10) -> DataFrame:
    """Test-data rule: vec_id -> (sent_id = vec_id div 10,
    pos = vec_id % 10); layer l is the embedding scaled by l + 1."""
    base = emb.select((F.col("vec_id") / per_sentence).cast("long").alias("sent_id"),
                      F.pmod("vec_id", F.lit(per_sentence)).cast("int").alias("pos"),
                      "embedding", F.explode(F.sequence(F.lit(0), F.lit(n_layers - 1))).alias("layer"))
    return base.select("sent_id", "layer", "pos", scaled("embedding", F.col("layer") + 1).alias("vec"))


def layer_softmax(weights: DataFrame) -> DataFrame:
    """M5: softmax over the (small) layer weight table; adding 1/n cancels, and
    so does the maximum, whose removal keeps the exponentials finite."""
    top = weights.select(F.max("w")).scalar()
    e = F.exp(F.col("w") - top)
    total = weights.select(F.sum(e)).scalar()
    return weights.select("layer", "w", (e / total).alias("sw"))


def layer_norm(tv: DataFrame, batch: Column, eps: float = 1e-12) -> DataFrame:
    """M7: per (batch, layer) mean / population variance over all values of
    the batch, then (v - mean) / sqrt(var + eps)."""
    tb = tv.withColumn("batch", batch)
    vals = tb.select("batch", "layer", F.explode("vec").alias("v"))
    mom = vals.groupBy("batch", "layer").agg(F.avg("v").alias("m"), F.var_pop("v").alias("var"))
    j = tb.join(mom, ["batch", "layer"])
    vec = F.transform("vec", lambda x: (x - F.col("m")) / F.sqrt(F.col("var") + F.lit(eps)))
    return j.select("sent_id", "layer", "pos", "batch", vec.alias("vec"))


def layer_mix(tv: DataFrame, weights: DataFrame, gamma: float = 1.0, top_only: bool = False) -> DataFrame:
    """M6: sum_l softmax(w)_l * vec_l per token, times gamma; or the top layer."""
    if top_only:
        top = tv.select(F.max("layer")).scalar()
        return tv.filter(F.col("layer") == top).select("sent_id", "pos", scaled("vec", F.lit(gamma)).alias("vec"))
    sw = broadcast_checked(layer_softmax(weights).select("layer", "sw"))
    mixed = vector_sum(tv.join(sw, "layer"), ["sent_id", "pos"], scaled("vec", "sw"))
    return mixed.select("sent_id", "pos", scaled("vec", F.lit(gamma)).alias("vec"))


def mean_pool(tv: DataFrame, key: str = "sent_id") -> DataFrame:
    """Mean of token vectors per sentence."""
    s = vector_sum(tv, [key], F.col("vec"), {"n": F.count(F.lit(1))})
    return s.select(key, F.transform("vec", lambda x: x / F.col("n").cast("double")).alias("vec"))


def mixed_pool(tv: DataFrame, weights: DataFrame, gamma: float = 1.0) -> DataFrame:
    """the mean over a sentence's tokens of their layer mix, as one aggregate
    per sentence over the weighted layer vectors: the mixed token vectors are
    never made, and one partial sum per sentence is exchanged."""
    sw = broadcast_checked(layer_softmax(weights).select("layer", "sw"))
    first = tv.select(F.min("layer")).scalar()
    n = F.count_if(F.col("layer") == first)  # a token has a vector in every layer
    s = vector_sum(tv.join(sw, "layer"), ["sent_id"], scaled("vec", "sw"), {"n": n})
    return s.select("sent_id", F.transform("vec", lambda x: x * F.lit(gamma) / F.col("n").cast("double")).alias("vec"))


# ------------------------------------------------------------- token similarity
def token_similarity(tokens: DataFrame, word_vectors: DataFrame) -> DataFrame:
    """Dot product of one query token vector (first token of the
    first sentence that has a vector) with every word of every other
    sentence; one row per (sentence, word) - the last occurrence wins -
    ranked per sentence by similarity.

    ``tokens(sent_id, pos, word)``.  The query vector is a one-row scalar
    subquery, so no join produces pairs."""
    freq = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    used = materialize(word_vectors.join(freq, "word"), "similar-words")
    known = skew_safe_lookup(tokens, used.select("word", "freq"), "word", "freq")
    q = materialize(known.orderBy("sent_id", "pos").limit(1), "first-token")
    q_sent = q.select("sent_id").scalar()
    q_vec = q.join(used, "word").select(F.col("vec").alias("v")).limit(1).scalar()
    dot = F.aggregate(F.zip_with("vec", "qvec", lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0).cast("double"), lambda s, v: s + v)
    # a word's similarity does not depend on where it stands: one number per word meets the tokens
    scored = materialize(used.withColumn("qvec", q_vec).select("word", "freq", dot.alias("sim")), "word-similarities")
    sims = skew_safe_lookup(tokens.filter(F.col("sent_id") != q_sent), scored, "word", "freq")
    last = sims.groupBy("sent_id", "word").agg(F.max_by("sim", "pos").alias("sim"), F.max("pos").alias("pos"))
    w = Window.partitionBy("sent_id").orderBy(F.round("sim", DIST_DIGITS).desc(), F.col("word"))
    return last.withColumn("rank", F.row_number().over(w))


def long_form(df: DataFrame, keys: list[str], vec: str = "vec") -> DataFrame:
    """Explode a vector column to (keys..., dim, val) for checks and exports."""
    return df.select(*keys, F.posexplode(vec).alias("dim", "val")).select(
        *keys, "dim", F.col("val").cast("double").alias("val"))
