"""The line CRF against enumeration of all labellings, and its classifier on
held-out documents, with odd rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import linecrf


def random_model(seed, n_lines):
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=linecrf.N_WEIGHTS)
    t = rng.normal(size=(2, 2))
    bins = rng.integers(0, linecrf.N_BINS, (sum(n_lines), len(linecrf.BINS)))
    return bins, np.array(n_lines), weights, t


def line_scores(bins, weights):
    """Log-odds of each line of one text, feature by feature."""
    n, w = len(bins), linecrf.WIDTH
    out = []
    for k in range(n):
        x = weights[3 * w]
        for f in range(len(linecrf.BINS)):
            x += weights[f * linecrf.N_BINS + bins[k][f]]
            if k:
                x += weights[w + f * linecrf.N_BINS + bins[k - 1][f]]
            if k < n - 1:
                x += weights[2 * w + f * linecrf.N_BINS + bins[k + 1][f]]
        out.append(x + (weights[3 * w + 1] if k == 0 else 0) + (weights[3 * w + 2] if k == n - 1 else 0))
    return out


def by_enumeration(bins, weights, t):
    """Marginals of one text, and the log-probability of all lines good or bad."""
    e = line_scores(bins, weights)
    total, good, paths = 0.0, np.zeros(len(e)), {}
    for labels in itertools.product((0, 1), repeat=len(e)):
        p = np.exp(sum(x for x, y in zip(e, labels) if y) + sum(t[a, b] for a, b in zip(labels, labels[1:])))
        total += p
        good += p * np.array(labels)
        paths[labels] = p
    return good / total, [np.log(paths[(y,) * len(e)] / total) for y in (0, 1)]


def test_marginals_equal_enumeration():
    bins, n_lines, weights, t = random_model(1, [1, 4, 7, 2, 1, 6])
    got = linecrf.marginals(bins, n_lines, weights, t)
    at = 0
    for n in n_lines:
        assert got[at:at + n] == pytest.approx(by_enumeration(bins[at:at + n], weights, t)[0])
        at += n


def test_gradient_equals_differences():
    bins, n_lines, weights, t = random_model(2, [3, 1, 5])
    labels, share = np.array([1.0, 0.0, 0.0]), np.array([0.5, 2.0, 1.0])

    def loss(w, t):
        at, out = 0, 0.0
        for n, y, s in zip(n_lines, labels, share):
            out -= s * by_enumeration(bins[at:at + n], w, t)[1][int(y)]
            at += n
        return out

    dw, dt = linecrf.gradient(bins, n_lines, labels, share, weights, t)
    for k in [*np.flatnonzero(dw)[::40], 3 * linecrf.WIDTH, 3 * linecrf.WIDTH + 1, 3 * linecrf.WIDTH + 2]:
        step = np.zeros_like(weights)
        step[k] = 1e-5
        assert dw[k] == pytest.approx((loss(weights + step, t) - loss(weights - step, t)) / 2e-5, abs=1e-6)
    for i in range(2):
        for j in range(2):
            step = np.zeros((2, 2))
            step[i, j] = 1e-5
            assert dt[i, j] == pytest.approx((loss(weights, t + step) - loss(weights, t - step)) / 2e-5, abs=1e-6)


def test_bins_do_not_depend_on_pieces_or_neighbours(monkeypatch):
    rng = random.Random(3)
    lines = ["", " ", "A b c.", "the the the", "x## y$$ z!!", "É é 漢字 😀 12 34", "| a | b |", "same", "same", "w " * 40]
    texts = [b""] + ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 12))).encode() for _ in range(30)]
    want = linecrf.line_bins(texts)
    monkeypatch.setattr(linecrf, "PIECE", 7)
    got = linecrf.line_bins(texts)
    assert all((a == b).all() for a, b in zip(want, got))
    at = 0
    for text, n in zip(texts, want[2]):
        alone = linecrf.line_bins([text])
        assert (alone[0] == want[0][at:at + n]).all() and n == text.count(b"\n") + 1
        at += n
    stats, _, sizes = linecrf._line_statistics(np.frombuffer("Ab ab ab É##\n\n12 | x!".encode(), np.uint8))
    assert stats[0, 0] == 4 and stats[0, 7] == 0.25 and stats[0, 6] == 2 / 7 and stats[2, 9] == 1 / 3
    assert sizes.tolist() == [13, 0, 7] and stats[1, 0] == 0


def prose(rng, n):
    return "\n".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(4, 15))) + "."
                     for _ in range(n))


def test_classifier_on_held_out_documents(spark):
    rng = random.Random(5)
    rows, marks = [], []
    for k in range(1200):
        text = prose(rng, rng.randint(1, 12))
        bad = k % 4 == 0
        if bad and k % 8:
            text = "\n".join(" ".join(w + "##" for w in x.split()) if rng.random() < 0.8 else x for x in text.split("\n"))
        elif bad:
            text = "\n".join([text.split("\n")[0].upper() + "!!"] * 8)
        rows.append((k, text, "x"))
        if k % 3:
            marks.append((k, 0 if bad else 1, None))
    rows += [(5000, None, "x"), (5001, "", "x"), (5002, "w " * 50_000, "x"), (1, "another text\nof the same id", "x"), (None, "no id", "x")]
    marks += [(1, None, None), (None, 1, None), (2, 0, None), (2, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = linecrf.digest(docs, labels).collect()
    assert len(got) == len(rows)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 1200 and r.held_out and r.doc_id != 1]
    right = sum(r.predicted == (r.doc_id % 4 != 0) for r in known)
    assert len(known) > 150 and right / len(known) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    # the lines of a text of both kinds are told apart
    model = linecrf.fit(docs, labels)
    mixed = prose(rng, 6) + "\n" + "\n".join(" ".join(w + "##" for w in prose(rng, 1).split()) for _ in range(6))
    good, _, _ = linecrf.line_labels([mixed.encode()], model)
    assert (good[:5] > 0.5).all() and (good[7:] < 0.5).all()


def test_classifier_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    one = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r.score for r in linecrf.digest(docs, one).collect()] == [1.0, 1.0]
    assert [r.score for r in linecrf.digest(docs, one.limit(0)).collect()] == [0.0, 0.0]
    assert linecrf.digest(docs.limit(0), one).count() == 0


def test_one_row_of_a_repeated_id_is_learned_from(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, "bad ##"), (3, "x"), (4, "y##")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    often = docs.withColumn("n", F.explode(F.array_repeat(F.lit(0), 5))).drop("n")
    assert (linecrf.fit(docs, labels) == linecrf.fit(often, labels)).all()
