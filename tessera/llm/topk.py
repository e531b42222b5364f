"""Operator 5: exact top-k search by exhaustive term-at-a-time accumulation.

A component of a vector is a term, its value the weight.  Queries and candidates
are dealt into cells, a block of queries against a block of candidates, so a
task holds two bounded blocks.  In a cell the postings of one term after the
other are scattered, times the queries' weights, into a dense array of integer
scores; a partition selection keeps the k best of each query, and the cells'
lists are merged by a ranked window.

The queries are a stated set (ids divisible by QUERY_EVERY) against all rows.  A
candidate is copied once per block of queries, never paired row by row.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; vectors of different lengths are not
compared; of rows that share an id the lexicographically smallest vector counts
once; ties go to the smaller id; a query without candidates has no rows; scores
beyond 64 bits raise an error.  Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_EVERY = 50
K = 5
SCALE = 256
#: Rows of a cell, in the mean.
QUERIES_PER_CELL = 1024
CANDIDATES_PER_CELL = 16_384
#: Entries of a dense score array.
SCORES_AT_ONCE = 1 << 21


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v: floor(SCALE * x) of each component x as a double."""
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
            .select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("v")))


def _distinct(ids: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by id; of equal ids the smallest vector."""
    order = np.lexsort((*v.T[::-1], ids))
    ids, v = ids[order], v[order]
    first = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
    return ids[first], v[first]


def accumulate(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of queries (rows) against candidates (columns), term by term."""
    most = lambda a: int(np.abs(a).max(initial=0)) if a.dtype != object else 1 << 62
    small = most(q) * most(c) * max(1, q.shape[1]) < 1 << 62
    scores = np.zeros((len(q), len(c)), np.int64 if small else object)
    q, c = (q, c) if small else (q.astype(object), c.astype(object))
    for term in range(q.shape[1]):
        rows, postings = np.flatnonzero(q[:, term]), np.flatnonzero(c[:, term])
        if len(rows) == len(q) and len(postings) == len(c):
            scores += q[:, term, None] * c[:, term]
        elif len(rows) and len(postings):
            scores[np.ix_(rows, postings)] += q[rows, term, None] * c[postings, term]
    return scores


def best_of(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, best first, ties to the
    smaller column; `own` is the column that a row leaves out, or -1.  -1 where
    a row has fewer."""
    n = scores.shape[1]
    rank = np.arange(n - 1, -1, -1)
    wide = scores.dtype == object or int(np.abs(scores).max(initial=0)) >= (1 << 62) // max(1, n)
    key = scores.astype(object) * n + rank if wide else scores * n + rank
    low = key.min(initial=0) - 1
    rows = np.flatnonzero(own >= 0)
    key[rows, own[rows]] = low
    if n > k and not wide:
        top = np.argpartition(key, n - k, axis=1)[:, n - k:]
    else:
        top = np.tile(np.arange(n), (len(key), 1))
    found = np.take_along_axis(key, top, 1)
    order = np.argsort(-found, axis=1, kind="stable")[:, :k]
    return np.where(np.take_along_axis(found, order, 1) > low, np.take_along_axis(top, order, 1), -1)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score."""
    rows = integer_vectors(vectors, id_col, vector_col)
    is_query = F.col("vec_id") % query_every == 0
    n, n_queries = vectors.agg(F.count("*"), F.count(F.when(F.col(f"`{id_col}`") % query_every == 0, 1))).first()
    q_blocks = max(1, -(-n_queries // QUERIES_PER_CELL))
    c_blocks = max(1, -(-n // CANDIDATES_PER_CELL))
    seeded = F.xxhash64("vec_id")
    size = F.size("v").alias("dim")

    def copies(blocks: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)

    candidates = rows.select(size, copies(q_blocks, "q"), F.pmod(seeded, F.lit(c_blocks)).cast("int").alias("c"),
                             F.lit(False).alias("is_query"), "vec_id", "v")
    queries = rows.where(is_query).select(size, F.pmod(seeded, F.lit(q_blocks)).cast("int").alias("q"),
                                          copies(c_blocks, "c"), F.lit(True).alias("is_query"), "vec_id", "v")

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        asks = frame["is_query"].to_numpy()
        sides = []
        for side in (asks, ~asks):
            part = frame[side]
            v = np.array(part["v"].tolist(), np.int64).reshape(len(part), int(frame["dim"].iloc[0]))
            sides.append(_distinct(part["vec_id"].to_numpy(), v))
        (q_ids, q), (c_ids, c) = sides
        step = max(1, SCORES_AT_ONCE // max(1, len(c_ids)))
        for at in range(0, len(q_ids) if len(c_ids) else 0, step):
            ids = q_ids[at:at + step]
            scores = accumulate(q[at:at + step], c)
            own = np.searchsorted(c_ids, ids)
            own = np.where((own < len(c_ids)) & (c_ids[np.minimum(own, len(c_ids) - 1)] == ids), own, -1)
            best = best_of(scores, own, k)
            r, p = np.nonzero(best >= 0)
            out.append(pd.DataFrame({"query_id": ids[r], "vec_id": c_ids[best[r, p]], "score": scores[r, best[r, p]]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (queries.unionByName(candidates).groupBy("dim", "q", "c")
             .applyInPandas(cell, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
