"""Operator 3: toxicity by FTRL-proximal logistic regression.

Features of a text are the hashed unigrams, bigrams and skip-grams (one word
left out) of its lower-cased words, each counted once.  FTRL-proximal keeps a
learning rate per coordinate and sets weights to exactly zero by L1, so what is
broadcast is the list of non-zero weights, at most one per hash bucket.

The model is fitted on a bounded sample: the MAX_TRAINING labelled documents
with the lowest seeded hash of their id.  Their features are computed where the
texts lie, and one task runs the sequential updates over these rows of integers.  A part
of the sample that takes no part in them sets the intercept, so that 0.5 is the
score that separates best.
Every whole text is then scored, batch by batch.

Defined results: null and empty texts score as a text without features (the
intercept); null labels are ignored, of several labels of a document the highest
counts, and of rows that repeat a labelled id one is learned from; without any label to learn from every score is the prior 0; repeated
rows are each scored; only id and text are read, so other columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod

#: Labelled documents that the model is fitted on, at most.
MAX_TRAINING = 12_000
HASH_BITS = 20
SEED = 7


@dataclass(frozen=True)
class Settings:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    epochs: int = 6
    calibrated_on: int = 5  # every so many-th document of the sample sets the intercept


class _Hashes(dict):
    """Hash of each word seen, with bounded memory."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = zlib.crc32(word.encode("utf-8", "replace")) + 1
        return out


def _hashed(text: str | None, seen: _Hashes) -> np.ndarray:
    """Hash buckets of a text's n-grams and skip-grams, with repeats."""
    found = re.findall(r"\w+", (text or "").lower())
    h = np.fromiter(map(seen.__getitem__, found), dtype=np.uint64, count=len(found))
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    parts = [h * a, h[:-1] * a + h[1:] * b, h[:-2] * b + (h[2:] * a ^ a)]
    mixed = np.concatenate(parts)
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * a) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = _Hashes()
    for batch in batches:
        rows = [np.unique(_hashed(t, seen)).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), pa.array(rows, pa.binary())],
            names=["place", "label", "features"])


class Ftrl:
    """FTRL-proximal over 2**HASH_BITS coordinates and an intercept, which has
    no penalty."""

    def __init__(self, settings: Settings) -> None:
        self.s = settings
        self.z = np.zeros((1 << HASH_BITS) + 1)
        self.n = np.zeros((1 << HASH_BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        free = at == 1 << HASH_BITS
        l1, l2 = np.where(free, 0.0, s.l1), np.where(free, 0.0, s.l2)
        return np.where(np.abs(z) <= l1, 0.0,
                        -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(n)) / s.alpha + l2))

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut between two scores with the highest F1 of what lies above it; of
    equal ones the widest gap.  0 without both labels."""
    if labels.min() == labels.max():
        return 0.0
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    f1 = 2 * np.cumsum(y)[:-1] / (np.arange(1, len(y)) + y.sum())
    gap = s[:-1] - s[1:]
    best = np.flatnonzero((gap > 0) & (f1 >= f1[gap > 0].max(initial=0) - 1e-12))
    if not len(best):
        return 0.0
    k = best[gap[best].argmax()]
    return float((s[k] + s[k + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", max_training: int = MAX_TRAINING) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of the non-zero weights; the intercept's index is
    2**HASH_BITS.  `labels` has doc_id and toxic."""
    doc_id = F.col("doc_id")
    known = (labels.where(F.col("toxic").isNotNull() & doc_id.isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("label"))
             .select("doc_id", F.col("label").cast("int"), F.xxhash64(F.lit(SEED), "doc_id").alias("place")))
    sample = F.broadcast(known.orderBy("place", "doc_id").limit(max_training))  # bounded by max_training rows
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).join(
        sample, "doc_id").select("place", "label", "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(y, np.append(np.frombuffer(x, np.int32).astype(np.int64), 1 << HASH_BITS))
                    for b in batches for y, x in zip(b.column("label").to_pylist(), b.column("features").to_pylist())]
        model = Ftrl(settings)
        fitted = [x for k, x in enumerate(examples) if k % settings.calibrated_on]
        for _ in range(settings.epochs):
            for y, at in fitted or examples:
                model.learn(at, y)
        at = np.flatnonzero(model.z) if examples else np.zeros(0, np.int64)
        w = model.weights(at)
        others = examples[::settings.calibrated_on]
        if fitted and others:
            cut = best_cut(np.array([model.weights(x).sum() for _, x in others]), np.array([y for y, _ in others]))
            bias = at == 1 << HASH_BITS
            w[bias] -= cut
        yield pa.RecordBatch.from_arrays([pa.array(at[w != 0]), pa.array(w[w != 0])], names=["at", "w"])

    got = (rows.mapInArrow(_feature_batches, "place long, label int, features binary")
           .groupBy("place", "label").agg(F.min("features").alias("features"))  # one row per id
           .repartition(1).sortWithinPartitions("place", "features")
           .mapInArrow(train, "at long, w double").collect())
    return np.array([r.at for r in got], np.int64), np.array([r.w for r in got], np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """id_col and score for every row of `docs`."""
    at, w = model
    sent = docs.sparkSession.sparkContext.broadcast((at, w))  # at most 2**HASH_BITS + 1 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = sent.value
        dense = np.zeros((1 << HASH_BITS) + 1)
        dense[at] = w
        seen, bias = _Hashes(), dense[1 << HASH_BITS] if len(at) else -np.inf
        for batch in batches:
            out = np.empty(batch.num_rows)
            for k, text in enumerate(batch.column("text")):
                h = _hashed(text.as_py(), seen)
                out[k] = bias + dense[np.unique(h[dense[h] != 0])].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.where(np.isneginf(out), 0.0, 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))))], names=["id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the held-out fold of the query contract: the model learns
    from the other labelled rows only."""
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = score(docs, fit(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
