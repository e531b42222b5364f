"""PPM against a direct implementation over dictionaries."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ppm
from tessera.llm.common import crc_mod

TEXTS = ["the cat sat on the mat", "The dog sat\non the log, the end", "a cat and a dog", "", None, "été là-bas", "x" * 300,
         "the cat sat on the mat", "   ", "zebra quagga the cat"]


def brute(train: list[bytes], text: bytes, order: int) -> float:
    """Code length by walking the contexts, symbol exclusion with sets."""
    seen: dict[bytes, Counter] = defaultdict(Counter)
    for t in train:
        padded = b"\xfe" * order + t + b"\xff"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                seen[padded[i - k:i]][padded[i]] += 1
    padded, out = b"\xfe" * order + text + b"\xff", 0.0
    for i in range(order, len(padded)):
        s, excluded = padded[i], set()
        for k in range(order, -1, -1):
            table = seen.get(padded[i - k:i])
            if table is None:
                continue
            left = {x: n for x, n in table.items() if x not in excluded}
            total, kinds = sum(left.values()), len(left)
            if s in left:
                out += math.log10(left[s] / (total + kinds))
                break
            if total + kinds:
                out += math.log10(kinds / (total + kinds))
            excluded |= set(table)
        else:
            out += math.log10(1 / (ppm.SYMBOLS - len(excluded)))
    return out


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_scores_equal_the_direct_model(spark):
    docs = rows(spark, TEXTS).withColumn("n_tokens", F.lit("clash"))
    training = F.col("doc_id") % 3 != 1
    got = {r.doc_id: r for r in ppm.score(docs, training).collect()}
    low = [(t or "").encode().lower() for t in TEXTS]
    train = [t for i, t in enumerate(low) if i % 3 != 1]
    words = [re.findall(rb"[^\x20\x09-\x0d]+", t) + [b""] for t in low]
    counts = Counter(w for i, ws in enumerate(words) if i % 3 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(TEXTS)
    for i, t in enumerate(low):
        r = got[i]
        assert r.score == pytest.approx(brute(train, t, ppm.ORDER), abs=1e-6)
        assert r.held_out == (i % 3 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words[i]), sum(counts[w] > 0 for w in words[i]), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words[i]), abs=1e-6)


def test_pruned_trie_is_a_distribution():
    """With nodes left out, the 256 symbols of any context add up to 1."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcde "), 400, p=[.4, .2, .2, .1, .05, .05])) for _ in range(20)]
    code, _ = ppm.codes(texts)
    grams, contexts = [], []
    for k in range(ppm.ORDER + 1):
        g = code & np.uint64((1 << 8 * (k + 1)) - 1)
        for store, x in ((grams, g), (contexts, g >> np.uint64(8))):
            names, n = np.unique(x, return_counts=True)
            store.append((names[n >= 25], n[n >= 25]))
    tables = ppm.Trie(grams, contexts).tables()
    for before in (b"abcde", b"aaaaa", b"zzzzz", b"zzaab", b"\xfe\xfe\xfeab"):
        base = int.from_bytes(before, "big") << 8
        p = 10 ** ppm.log_probabilities(np.array([base + s for s in range(256)], np.uint64), tables)
        assert p.sum() == pytest.approx(1.0, abs=1e-9)


def test_nothing_to_learn_from_and_empty_table(spark):
    got = ppm.score(rows(spark, ["ab", None]), F.lit(False)).orderBy("doc_id").collect()
    assert [r.score for r in got] == pytest.approx([-3 * math.log10(256), -math.log10(256)])
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0), (0, 0)]
    assert ppm.score(rows(spark, []), F.lit(True)).count() == 0


def test_digest_folds(spark):
    docs = rows(spark, TEXTS)
    got = ppm.digest(docs).select("doc_id", "held_out").collect()
    want = {r.doc_id: r.m == 2 for r in docs.select("doc_id", crc_mod(F.col("doc_id"), 7).alias("m")).collect()}
    assert {r.doc_id: r.held_out for r in got} == want


@pytest.mark.parametrize("frequent", [0, 8, 60])
def test_rare_nodes_stay_in_a_large_corpus(spark, monkeypatch, frequent):
    """Seven rare words in 2.4 MB of common text: their nodes, of a count below
    1 / 2**20 of all bytes, code the same words elsewhere; and the border of the
    broadcast changes no score."""
    monkeypatch.setattr(ppm, "FREQUENT", frequent)
    common = "the cat sat on the mat " * 3000
    texts = [common] * 35 + ["quagga zebra okapi"] + ["quagga okapi zebra", "jinx okapi"]
    docs = rows(spark, texts)
    got = {r.doc_id: r.score for r in ppm.score(docs, F.col("doc_id") < 36).where("doc_id >= 34").collect()}
    counts = [(t.encode(), n) for t, n in ((common, 35), (texts[35], 1))]
    grams, contexts = [], []
    code = np.concatenate([np.tile(ppm.codes([t])[0], n) for t, n in counts])
    for k in range(ppm.ORDER + 1):
        g = code & np.uint64((1 << 8 * (k + 1)) - 1)
        for store, x in ((grams, g), (contexts, g >> np.uint64(8))):
            store.append(np.unique(x, return_counts=True))
    tables = ppm.Trie(grams, contexts).tables()
    assert (grams[ppm.ORDER][1] * (1 << 20) < len(code)).any()
    for i in range(34, 38):
        want = ppm.log_probabilities(ppm.codes([texts[i].encode()])[0], tables).sum()
        assert got[i] == pytest.approx(want, rel=1e-9)
