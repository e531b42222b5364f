"""Operator 12: document quality from a linear-chain CRF over lines.

Each line is labelled good or bad.  Its features are binned statistics (lengths,
shares of symbols, capitals, digits, repeated words, copies of the line in its
document and the like) of the line itself and of the lines before and behind it;
transition weights tie neighbouring labels.  Forward and backward messages give
each line's marginal, and the mean of the marginals, weighted by line length,
is the document's quality.

The model is fitted on a bounded sample: the MAX_TRAINING labelled documents with
the lowest seeded hash of their id, of each at most MAX_LINES lines in a row, at
a seeded place.  A line takes its document's label.  Line features are computed
where the texts lie; one task runs the updates over these rows of small integers.  A part of
the sample that takes no part in them sets the cut, which becomes score 0.3.
Every whole text is then scored, batch by batch, at most PIECE bytes of lines at a time.

Defined results: lines are what stands between line feeds; null and empty texts
are one empty line; null labels are ignored, of several labels of a document the
highest counts, of rows that repeat a labelled id one (the lowest text) is learned
from; without both labels to learn from every score is their share of good ones,
or 0 without any; repeated rows are each scored; only id and text are read, so
other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod

MAX_TRAINING = 12_000
MAX_LINES = 400
PIECE = 1 << 20
SEED = 11
#: Score of the cut between bad and good.
CUT_SCORE = 0.3

# classes of bytes
LETTER, UPPER, DIGIT, SPACE, STOP, LOUD, SYMBOL, OTHER = range(8)
_CLASS = np.full(256, OTHER, np.uint8)
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", LETTER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), (b"0123456789", DIGIT),
                   (b" \t\r\x0b\x0c\n", SPACE), (b".,;:", STOP), (b"!?", LOUD), (b"#*$%&|<>@^~=+_\\/{}[]", SYMBOL)):
    _CLASS[list(_chars)] = _k
_CLASS[0xC2:] = LETTER  # first byte of a character beyond ASCII

_RATIO = [1e-9, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6]
#: Limits of the bins of each line statistic.
BINS = [
    [1, 2, 4, 8, 16, 32, 64],       # words
    [2, 3, 4, 5, 6, 8, 12],         # characters a word
    _RATIO, _RATIO, _RATIO, _RATIO,  # of characters: symbols, ! and ?, digits, stops
    [1e-9, 0.03, 0.08, 0.15, 0.3, 0.6, 0.9],  # capitals of letters
    _RATIO,                         # words equal to the one before, of words
    [1e-9, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75],  # words seen before in the line, of words
    _RATIO,                         # words without letter or digit, of words
    _RATIO,                         # words that end in a symbol or ! or ?, of words
    [1.5, 2.5, 4.5, 8.5, 16.5, 64.5, 256.5],  # copies of the line in the document
    [0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5],      # class of the last visible byte
]
N_BINS = 8
WIDTH = len(BINS) * N_BINS
#: Own, previous and next line's bins, no previous or next line, and a bias.
N_WEIGHTS = 3 * WIDTH + 3


def _powers(n: int, odd: int, held: dict[tuple[int, int], np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """odd ** (0 .. n-1) modulo 2**64."""
    size = 1 << max(12, (n - 1).bit_length())
    if (size, odd) not in held:
        p = np.full(size, odd, np.uint64)
        p[0] = 1
        held[size, odd] = np.cumprod(p, dtype=np.uint64)
    return held[size, odd][:n]


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _line_statistics(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics (all but the copies), hash and bytes of each line of `data`."""
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [n]])
    kind = _CLASS[data]
    late = np.zeros(n, bool)  # capitals of the Latin-1 block: C3 80 to C3 9E
    late[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(np.float64)

    chars = per_line((data & 0xC0) != 0x80)
    kinds = {k: per_line(kind == k) for k in (LETTER, UPPER, DIGIT, STOP, LOUD, SYMBOL)}
    upper = kinds[UPPER] + per_line(late)
    letters = kinds[LETTER] + kinds[UPPER]

    seen = kind != SPACE
    first = seen.copy()
    first[1:] &= ~seen[:-1]
    last = seen.copy()
    last[:-1] &= ~seen[1:]
    w0, w1 = np.flatnonzero(first), np.flatnonzero(last)
    # polynomial hashes of words and lines from one running sum
    run = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, _ODD), dtype=np.uint64)])
    inverse = _powers(n + 1, _INVERSE)
    line_hash = (run[ends] - run[starts]) * inverse[starts]
    words = (run[w1 + 1] - run[w0]) * inverse[w0]
    line_of = np.searchsorted(starts, w0, "right") - 1
    n_words = np.bincount(line_of, minlength=len(starts)).astype(np.float64)

    def count(at: np.ndarray) -> np.ndarray:
        return np.bincount(line_of[at], minlength=len(starts)).astype(np.float64)

    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])
    mixed = (words ^ (words >> np.uint64(29))) * np.uint64(_ODD)
    keys = np.unique((line_of.astype(np.uint64) << np.uint64(40)) | (mixed >> np.uint64(24)))
    distinct = np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=len(starts)).astype(np.float64)
    plain = np.concatenate([[0], np.cumsum((kind <= DIGIT) | (data >= 0x80), dtype=np.int64)])
    bare = plain[w1 + 1] == plain[w0]
    tail = kind[w1]
    last_word = np.full(len(starts), OTHER)
    last_word[line_of] = np.where(data[w1] >= 0x80, LETTER, tail)  # the last assignment stays

    def share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.divide(x, of, out=np.zeros_like(x), where=of > 0)

    stats = np.stack([
        n_words, share(chars, n_words), share(kinds[SYMBOL], chars), share(kinds[LOUD], chars), share(kinds[DIGIT], chars),
        share(kinds[STOP], chars), share(upper, letters), share(count(again), n_words), share(n_words - distinct, n_words),
        share(count(bare), n_words), share(count((tail == SYMBOL) | (tail == LOUD)), n_words),
        np.zeros(len(starts)), last_word.astype(np.float64)], axis=1)
    return stats, line_hash, ends - starts


def line_bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins of every line, its bytes, lines of each text)."""
    joined = b"\n".join(texts)
    pieces, at = [], 0
    while at <= len(joined):  # whole lines, PIECE bytes and the rest of a line
        end = joined.find(b"\n", at + PIECE)
        end = len(joined) if end < 0 else end
        pieces.append(_line_statistics(np.frombuffer(joined, np.uint8, end - at, at)))
        at = end + 1
    stats, hashes, sizes = (np.concatenate(x) for x in zip(*pieces))
    n_lines = np.array([t.count(b"\n") + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), n_lines)
    _, which, copies = np.unique((hashes ^ (hashes >> np.uint64(31))) * np.uint64(_ODD) + doc * np.uint64(_INVERSE),
                                 return_inverse=True, return_counts=True)
    stats[:, 11] = copies[which]
    bins = np.stack([np.searchsorted(limits, stats[:, k], "right") for k, limits in enumerate(BINS)], axis=1)
    return bins.astype(np.uint8), sizes, n_lines


def emissions(bins: np.ndarray, n_lines: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-odds of a good label that a line's own features give."""
    at = bins + np.arange(len(BINS)) * N_BINS
    own = weights[at].sum(axis=1)
    before, behind = weights[at + WIDTH].sum(axis=1), weights[at + 2 * WIDTH].sum(axis=1)
    ends = np.cumsum(n_lines)
    first, last = ends - n_lines, ends - 1
    out = own + weights[3 * WIDTH]
    out[1:] += before[:-1]
    out[:-1] += behind[1:]
    # across a border between texts there is no neighbour
    out[first[1:]] -= before[first[1:] - 1]
    out[last[:-1]] -= behind[last[:-1] + 1]
    out[first] += weights[3 * WIDTH + 1]
    out[last] += weights[3 * WIDTH + 2]
    return out


def messages(emitted: np.ndarray, n_lines: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds (good against bad) of every line; t[i, j] is
    the weight of label j behind label i.  Texts are advanced together, line by
    line, the longest first."""
    order = np.argsort(-n_lines, kind="stable")
    sizes = n_lines[order]
    starts = (np.cumsum(n_lines) - n_lines)[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    forward, backward = emitted.copy(), np.zeros_like(emitted)
    for k in range(1, len(alive)):
        at = starts[:alive[k]] + k
        x = forward[at - 1]
        forward[at] += np.logaddexp(t[1, 1] + x, t[0, 1]) - np.logaddexp(t[1, 0] + x, t[0, 0])
    for k in range(len(alive) - 1, 0, -1):
        at = starts[:alive[k]] + k
        x = emitted[at] + backward[at]
        backward[at - 1] = np.logaddexp(t[1, 1] + x, t[1, 0]) - np.logaddexp(t[0, 1] + x, t[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def marginals(bins: np.ndarray, n_lines: np.ndarray, weights: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Probability that a line is good."""
    forward, backward = messages(emissions(bins, n_lines, weights), n_lines, t)
    return _sigmoid(forward + backward)


def pooled(good: np.ndarray, sizes: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Log-odds of the length-weighted mean of the lines' marginals."""
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    mass = sizes + 1.0
    mean = np.bincount(doc, good * mass, len(n_lines)) / np.bincount(doc, mass, len(n_lines))
    mean = np.clip(mean, 1e-12, 1 - 1e-12)
    return np.log(mean / (1 - mean))


@dataclass(frozen=True)
class Settings:
    epochs: int = 8
    batch: int = 256
    rate: float = 0.05
    l2: float = 1e-3
    calibrated_on: int = 5  # every so many-th document of the sample sets the cut


def gradient(bins: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, share: np.ndarray, weights: np.ndarray,
             t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log-likelihood that all lines of text d have label
    `labels[d]`, each text weighted by `share[d]`."""
    emitted = emissions(bins, n_lines, weights)
    forward, backward = messages(emitted, n_lines, t)
    y, s = np.repeat(labels, n_lines), np.repeat(share, n_lines)
    g = (_sigmoid(forward + backward) - y) * s
    at = bins + np.arange(len(BINS)) * N_BINS
    ends = np.cumsum(n_lines)
    first, last = ends - n_lines, ends - 1
    dw = np.zeros(N_WEIGHTS)
    inner_next, inner_prev = np.ones(len(g), bool), np.ones(len(g), bool)
    inner_prev[first], inner_next[last] = False, False
    g_behind = np.zeros_like(g)  # a line's bins act on the next line as its previous, and the other way round
    g_behind[:-1] = g[1:]
    g_before = np.zeros_like(g)
    g_before[1:] = g[:-1]
    for shift, part in ((0, g), (WIDTH, g_behind * inner_next), (2 * WIDTH, g_before * inner_prev)):
        dw += np.bincount((at + shift).ravel(), np.repeat(part, len(BINS)), N_WEIGHTS)
    dw[3 * WIDTH] += g.sum()
    dw[3 * WIDTH + 1] += g[first].sum()
    dw[3 * WIDTH + 2] += g[last].sum()
    k = np.flatnonzero(inner_prev)
    a, b = forward[k - 1], emitted[k] + backward[k]
    joint = np.stack([np.full(len(k), t[0, 0]), t[0, 1] + b, t[1, 0] + a, t[1, 1] + a + b])
    joint = np.exp(joint - joint.max(axis=0)) if len(k) else joint
    joint = joint / joint.sum(axis=0) * s[k]
    dt = joint.sum(axis=1).reshape(2, 2)
    dt[1, 1] -= (s[k] * y[k]).sum()
    dt[0, 0] -= (s[k] * (1 - y[k])).sum()
    return dw, dt


def best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The cut between two values that tells most of them rightly apart; of equal
    ones the middle of the widest gap."""
    order = np.argsort(values, kind="stable")
    v, y = values[order], labels[order]
    right = (np.cumsum(1 - y) + y.sum() - np.cumsum(y))[:-1]
    gap = np.diff(v)
    usable = gap > 0
    if not usable.any():
        return float(v[0]) - 1.0
    best = np.flatnonzero(usable & (right >= right[usable].max()))
    k = best[gap[best].argmax()]
    return float((v[k] + v[k + 1]) / 2)


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], s: Settings = Settings()) -> np.ndarray:
    """Weights, the four transition weights and the cut, of (label, bins, sizes)."""
    fitted = [x for k, x in enumerate(examples) if k % s.calibrated_on] or examples
    n_good = sum(y for y, _, _ in fitted)
    share = {1: len(fitted) / max(1, 2 * n_good), 0: len(fitted) / max(1, 2 * (len(fitted) - n_good))}
    theta, m, v = (np.zeros(N_WEIGHTS + 4) for _ in range(3))
    rng, n = np.random.default_rng(SEED), 0
    for _ in range(s.epochs):
        order = rng.permutation(len(fitted))
        for i in range(0, len(order), s.batch):
            part = [fitted[j] for j in order[i:i + s.batch]]
            y = np.array([y for y, _, _ in part], float)
            dw, dt = gradient(np.concatenate([b for _, b, _ in part]), np.array([len(b) for _, b, _ in part]), y,
                              np.array([share[x] for x in y.astype(int)]) / len(part), theta[:-4], theta[-4:].reshape(2, 2))
            g = np.concatenate([dw, dt.ravel()]) + s.l2 * theta
            n += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta -= s.rate * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.99 ** n)) + 1e-8)
    others = examples[::s.calibrated_on]
    values = _pooled_of(others, theta)
    labels = np.array([y for y, _, _ in others])
    if labels.min() == labels.max():
        values, labels = _pooled_of(examples, theta), np.array([y for y, _, _ in examples])
    return np.append(theta, best_cut(values, labels))


def _pooled_of(examples: list[tuple[int, np.ndarray, np.ndarray]], theta: np.ndarray) -> np.ndarray:
    n_lines = np.array([len(b) for _, b, _ in examples])
    good = marginals(np.concatenate([b for _, b, _ in examples]), n_lines, theta[:N_WEIGHTS],
                     theta[N_WEIGHTS:N_WEIGHTS + 4].reshape(2, 2))
    return pooled(good, np.concatenate([z for _, _, z in examples]), n_lines)


def _as_bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins, sizes, n_lines = line_bins(_as_bytes(batch.column("text")))
        at, rows = np.cumsum(n_lines) - n_lines, []
        for place, a, n in zip(batch.column("place").to_pylist(), at, n_lines):
            a += abs(place) % max(1, n - MAX_LINES + 1)  # of a long text some lines in a row
            z = slice(a, a + min(n, MAX_LINES))
            rows.append((bins[z].tobytes(), sizes[z].astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), *(pa.array(x, pa.binary()) for x in zip(*rows))]
            if rows else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())],
            names=["place", "label", "bins", "sizes"])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", max_training: int = MAX_TRAINING) -> np.ndarray:
    """The model's numbers (one if there is nothing to tell apart).  `labels` has
    doc_id and quality."""
    doc_id = F.col("doc_id")
    known = (labels.where(F.col("quality").isNotNull() & doc_id.isNotNull()).groupBy("doc_id")
             .agg(F.max("quality").cast("int").alias("label"))
             .select("doc_id", "label", F.xxhash64(F.lit(SEED), "doc_id").alias("place")))
    sample = F.broadcast(known.orderBy("place", "doc_id").limit(max_training))  # bounded by max_training rows
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).join(
        sample, "doc_id").select("doc_id", "place", "label", "text")
    # the lowest text of rows that repeat an id: the smallest hash, then one of its equal rows
    one = rows.mapInArrow(_hashed_rows, "doc_id " + docs.schema[id_col].dataType.simpleString()
                          + ", place long, label int, bins binary, sizes binary").groupBy("doc_id").agg(
        F.min(F.struct("place", "label", "bins", "sizes")).alias("x")).select("x.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for b in batches:
            for y, bins, sizes in zip(*(b.column(c).to_pylist() for c in ("label", "bins", "sizes"))):
                examples.append((y, np.frombuffer(bins, np.uint8).reshape(-1, len(BINS)).astype(np.int64),
                                 np.frombuffer(sizes, np.int64)))
        good = [y for y, _, _ in examples]
        if not examples or min(good) == max(good):
            model = np.array([float(good[0]) if good else 0.0])
        else:
            model = train(examples, settings)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(model)), pa.int32()), pa.array(model)], names=["k", "w"])

    got = (one.repartition(1).sortWithinPartitions("place", "bins").mapInArrow(run, "k int, w double")).collect()
    return np.array([r.w for r in sorted(got, key=lambda r: r.k)])


def _hashed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = next(_feature_batches(iter([batch])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.columns], names=["doc_id", *made.schema.names])
    return (kept(b) for b in batches if b.num_rows)


def line_labels(texts: list[bytes], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability that the line is good, line bytes, lines of each text)."""
    bins, sizes, n_lines = line_bins(texts)
    if len(model) == 1:
        return np.full(len(bins), model[0]), sizes, n_lines
    return marginals(bins.astype(np.int64), n_lines, model[:N_WEIGHTS], model[N_WEIGHTS:-1].reshape(2, 2)), sizes, n_lines


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score, and bad_lines (places of the lines more likely bad than good)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        shift = np.log(CUT_SCORE / (1 - CUT_SCORE))
        for batch in batches:
            if not batch.num_rows:
                continue
            good, sizes, n_lines = line_labels(_as_bytes(batch.column("text")), model)
            if len(model) == 1:
                out = np.full(batch.num_rows, model[0])
            else:
                out = _sigmoid(pooled(good, sizes, n_lines) - model[-1] + shift)
            doc, starts = np.repeat(np.arange(len(n_lines)), n_lines), np.cumsum(n_lines) - n_lines
            bad = np.flatnonzero(good < 0.5)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[bad], minlength=len(n_lines)))])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array((bad - starts[doc[bad]]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out), lists], names=["id", "score", "bad_lines"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, score double, bad_lines array<int>").withColumnRenamed("id", id_col)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the held-out fold of the query contract: the model learns
    from the other labelled rows only."""
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = score(docs, fit(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"),
                         F.size("bad_lines").cast("long").alias("n_bad_lines"))
