"""Quality rules, line dedup, sharding, SentencePiece, toxicity, top-k and mixing
against brute force, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import linededup, mixing, quality, sentencepieces, sharding, topk, toxicity

SPACES = r"[^\x20\x09-\x0d]+"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def long_words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(n))


# quality rules

ODD = [None, "", " \n\t ", "a", "x y\nx y\n\nx y", "a b c d e f g h " * 4, "# * $ % & | < >", "é ß 漢字 😀", "w " * 3000,
       "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 10", " lead and trail \r\n lead and trail \r\n"]


def base_counts(text):
    w = re.findall(SPACES, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(SPACES, x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_features(spark):
    texts = ODD + [long_words(30, 1) + " " + long_words(30, 1)]
    df = frame(spark, list(enumerate(texts))).select("doc_id", quality.features(F.col("text")).alias("f"))
    for r in df.collect():
        got = tuple(r.f[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == base_counts(texts[r.doc_id]), texts[r.doc_id]


def test_quality_rules_are_learned(spark):
    rng = random.Random(0)
    rows, marks = [], []
    for k in range(600):
        text = long_words(rng.randint(30, 80), k)
        if k % 5 == 0:
            text = " ".join(w + "##" for w in text.split())
        rows.append((k, text))
        if k % 2 == 0:
            marks.append((k, 0 if k % 5 == 0 else 1, None))
    docs = frame(spark, rows).withColumn("f_words", F.lit("clash")).withColumn("_quality", F.lit(1))
    labels = spark.createDataFrame(marks + [(None, 0, 0), (3, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    judged, f = quality.judge(docs, labels)
    for r in judged.collect():
        assert r[f].kept == (r.doc_id % 5 != 0)
        assert r[f].rule == (1 if r.doc_id % 5 == 0 else None)
    assert quality.quality_filter(docs, labels).columns == docs.columns
    none, f = quality.judge(docs, labels.limit(0), drop_text=True)
    assert none.where(f"not {f}.kept").count() == 0 and "text" not in none.columns
    assert quality.quality_filter(docs.limit(0), labels).count() == 0


def brute_rules(cells, settings):
    """Sequential covering over rows (part, {feature: bin}, pos, neg), each
    condition tried by filtering the rows."""
    def holds(bins, condition):
        feature, above, at = condition
        return bins[feature] > at if above else bins[feature] <= at

    def counts(rows, conditions):
        hit = [r for r in rows if all(holds(r[1], c) for c in conditions)]
        return sum(r[2] for r in hit), sum(r[3] for r in hit)

    rules, left = [], list(cells)
    while len(rules) < settings.max_rules:
        grow = [r for r in left if r[0] < settings.grow_parts]
        prune = [r for r in left if r[0] >= settings.grow_parts]
        rule = []
        while len(rule) < settings.max_conditions:
            p0, n0 = counts(grow, rule)
            if not p0 or (rule and not n0):
                break
            found = []
            for feature, grid in quality.GRID.items():
                for at in range(len(grid)):
                    for above in (True, False):
                        p, n = counts(grow, [*rule, (feature, above, at)])
                        if p >= settings.min_covered and (p, n) != (p0, n0):
                            gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                            found.append((gain, (feature, above, at)))
            top = max((g for g, _ in found), default=0)
            if top <= 1e-9:
                break
            ties = [c for g, c in found if g >= top - 1e-9]
            same = [c for c in ties if c[:2] == ties[0][:2]]
            rule.append(same[-1] if ties[0][1] else ties[0])
        if not rule:
            break
        scored = []
        for k in range(1, len(rule) + 1):
            p, n = counts(prune, rule[:k])
            scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        _, k, p, n = max(scored)
        if not p or p / (p + n) < settings.min_precision:
            break
        rules.append(rule[:-k])
        left = [r for r in left if not all(holds(r[1], c) for c in rules[-1])]
    return rules


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_plain_sequential_covering(spark, seed):
    rng = random.Random(seed)
    first, second, third = rng.sample(list(quality.GRID), 3)
    cells = []
    for _ in range(400):
        bins = {name: rng.randint(0, len(grid)) for name, grid in quality.GRID.items()}
        bad = (bins[first] * 2 > len(quality.GRID[first]) and bins[second] * 2 > len(quality.GRID[second])) or bins[third] == 0
        cells.append((rng.randrange(3), bins, *((rng.randint(1, 9), 0) if bad else (0, rng.randint(1, 9)))))
    cells.append((0, bins, 0, 1))
    schema = "part int, " + ", ".join(f"{name} int" for name in quality.GRID) + ", pos long, neg long"
    table = spark.createDataFrame([(part, *bins.values(), p, n) for part, bins, p, n in cells], schema)
    settings = quality.Settings()
    got = [[(c.feature, c.above, quality.GRID[c.feature].index(c.threshold)) for c in r.conditions]
           for r in quality.learn_rules(table, settings)]
    want = brute_rules(cells, settings)
    assert got == want and len(want) >= 2 and max(map(len, want)) >= 2


# line dedup

def brute_lines(rows):
    keyed = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0], 0))
    seen, cut = {}, {}
    for doc in keyed:
        lines = doc[1].split("\n")
        worded = [k for k, x in enumerate(lines) if re.search(SPACES, x)]
        gone = set()
        for p in range(len(worded) - 2):
            window = tuple(lines[k] for k in worded[p:p + 3])
            if window in seen:
                gone.update(worded[p:p + 3])
            seen.setdefault(window, doc)
        cut[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return cut


def test_line_dedup(spark):
    rng = random.Random(3)
    lines = [f"line {k}" for k in range(12)] + ["", "  "]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a\na\na\na\na"), (103, rows[5][1]), (103, rows[5][1])]
    docs = frame(spark, rows).withColumn("_places", F.lit(1)).withColumn("w", F.lit(2))
    want = brute_lines(rows)
    out = linededup.line_dedup(docs, removed_col="n_removed")
    got = out.collect()
    assert len(got) == len(rows) and out.columns == [*docs.columns, "n_removed"]
    texts = dict(rows)
    for r in got:
        t = texts[r.doc_id]
        assert r.text == (None if t is None else want[(r.doc_id, t)])
    assert linededup.line_dedup(docs.limit(0)).count() == 0


# sharding

def test_shards(spark, tmp_path):
    rows = [(k, "same" if k % 3 == 0 else "t" * (k % 50)) for k in range(3000)] + [(None, None), (5, "same"), (5, "same")]
    docs = frame(spark, rows).withColumn("shard", F.lit("clash")).repartition(5)
    out = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=500)
    info = out.columns[-1]
    got = out.select("doc_id", "text", F.col("shard").alias("mine"), f"{info}.*").collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.mine) == (len(data) + 1, zlib.crc32(data), "clash")
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == 16
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    order = [r.doc_id for r in sorted((r for r in got if r.shard == 0), key=lambda r: r.slot) if r.doc_id is not None]
    assert order != sorted(order)
    moved = sum(r.grown_shard == 16 for r in got)
    assert 0 < moved < len(rows) / 8
    assert sharding.write_shards(docs.limit(0), str(tmp_path / "e")).count() == 0


# SentencePiece

TEXTS = ["Hello  world", "  x ", "a\tb\nc", "", None, "ﬁ① 漢字   😀", "a▁b", "▁", "   ", "\n\n\n", "aaaaaaaaaaaaaaaaaaaaaaaa!!!!!!!!",
         "The quick brown fox. " * 40, "\x00\x01", "x" * 2000, "def f(x):\n        return x  # done"]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcthe nio.,ÄÖé漢\n▁") for _ in range(200)) for _ in range(60)]
    vocabulary = sentencepieces.load()
    docs = frame(spark, list(enumerate(texts))).withColumn("pieces", F.lit(1)).withColumn("_pieces", F.lit(2))
    out = sentencepieces.encode(docs, vocabulary)
    name = out.columns[-1]
    assert out.columns[:-1] == docs.columns
    for r in out.collect():
        want = sp.encode(texts[r.doc_id] or "")
        assert list(r[name].ids) == want and r[name].n_tokens == len(want)
        assert r[name].round_trip == ("▁" not in (texts[r.doc_id] or ""))
    back = sentencepieces.decode_column(out.select("doc_id", f"{name}.ids"), vocabulary)
    for r in back.collect():
        assert r[-1] == (texts[r.doc_id] or "").replace("▁", " ") == sp.decode(list(r.ids)) or "▁" in (texts[r.doc_id] or "")
    assert sentencepieces.encode(docs.limit(0), vocabulary).count() == 0


def test_a_worker_remembers_little(monkeypatch):
    """What an encoder keeps between texts is bounded, and forgetting changes no ids."""
    monkeypatch.setattr(sentencepieces, "CACHED_CHARS", 3000, raising=False)
    monkeypatch.setattr(sentencepieces, "CACHED_PAIRS", 500, raising=False)
    vocabulary = sentencepieces.load()
    e = sentencepieces.Encoder(vocabulary)
    for k in range(20):
        texts = [long_words(60, 1), None, long_words(100, 50 + k), "漢字 " + chr(0x4E00 + k), "x" * 5000 if k == 3 else ""]
        got = e.encode(texts)
        fresh = sentencepieces.Encoder(vocabulary)
        assert [r.tolist() for r in got] == [fresh.encode([t])[0].tolist() for t in texts]
        assert sum(map(len, e.known)) <= 3000
    assert sum(len(x[3]) for x in [*e.entries, *e.single.values()]) <= 500 and len(e.single) <= 500


def test_long_texts_are_taken_a_few_at_a_time(monkeypatch):
    """Slices go by bytes: many long texts never share one trie."""
    monkeypatch.setattr(sentencepieces, "BYTES_AT_ONCE", 10_000, raising=False)
    texts = ["a" * 4000, None, "é" * 4000, "", "b" * 50_000, *["c" * 900] * 40, None]
    for column in (pa.array(texts), pa.array([None if t is None else list(t.encode()) for t in texts], pa.list_(pa.int32()))):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), column], names=["doc_id", "text"])
        parts = list(sentencepieces._parts(batch, "text"))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 5
        for p in parts:
            sizes = [len(t or "") for t in texts[p[0][0].as_py():p[0][-1].as_py() + 1]]
            assert sum(sizes) - max(sizes) <= 10_000 and p.num_rows
        assert not list(sentencepieces._parts(batch.slice(0, 0), "text"))


def test_unigram_takes_the_best_sum():
    scores = {"▁a": -1.0, "b": -2.0, "▁ab": -3.5, "▁": -4.0, "a": -2.5, "ba": -1.0, "▁aba": -2.5}
    v = sentencepieces.Vocabulary("unigram", {p: k for k, p in enumerate(scores)}, scores, (), 99, ())
    rng = random.Random(4)

    def best(word):
        if not word:
            return 0.0, ()
        found = [(scores[word[:k]] + best(word[k:])[0], (word[:k], *best(word[k:])[1])) for k in range(1, len(word) + 1) if word[:k] in scores]
        return max(found)
    words = sorted({"▁" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(200)})
    e = sentencepieces.Encoder(v)
    e.learn(words)
    for w in words:
        ids = np.frombuffer(e.known[w], np.int32).tolist()
        pieces = [list(scores)[i] for i in ids]
        assert "".join(pieces) == w and sum(scores[p] for p in pieces) == pytest.approx(best(w)[0])


# toxicity

def test_toxicity_on_rows_held_out(spark):
    rows, marks = [], []
    for k in range(900):
        toxic = k % 6 == 0
        w = long_words(60, k).split()
        if toxic:
            w[k % 50] = ("vile", "nasty", "Wretched,")[k % 3]
            w[(k + 9) % 50] = ("nasty", "wretched", "vile.")[k % 3]
        rows.append((k, " ".join(w)))
        marks.append((k, int(toxic)))
    docs = frame(spark, rows + [(9000, None), (9001, "")]).withColumn("label", F.lit(1)).withColumn("place", F.lit(1))
    labels = spark.createDataFrame(marks + [(None, 1), (1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.digest(docs, labels).collect()}
    assert len(got) == 902
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.5)
    held = [r for k, r in got.items() if r.held_out and k < 900]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) / len(held) > 0.97
    assert got[9000].score == got[9001].score < 0.5
    blind = toxicity.digest(docs, labels.limit(0)).collect()
    assert {r.score for r in blind} == {0.0}
    assert toxicity.digest(docs.limit(0), labels).count() == 0


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, -1.0, -5.0]), np.array([1, 1, 0, 0])) == 0.5
    assert toxicity.best_cut(np.array([1.0, 2.0]), np.array([0, 0])) == 0.0


# top-k

def brute_topk(rows, k=5, every=50):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        kept[i] = min(kept.get(i, q), q)
    out = []
    for i, q in kept.items():
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept.items() if j != i and len(c) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [False, True])
def test_topk(spark, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(topk, "QUERIES_PER_CELL", 3)
        monkeypatch.setattr(topk, "CANDIDATES_PER_CELL", 40)
        monkeypatch.setattr(topk, "SCORES_AT_ONCE", 64)
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 0.3], 6)]) for k in range(-20, 330)]
    rows += [(400, None), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (None, [1.0] * 6),
             (600, [1.0, 2.0]), (601, [1.0, 2.0]), (650, []), (700, [0.5] * 3), (100, [9.0] * 6), (7, rows[27][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("dim", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df).collect())
    assert got == brute_topk(rows)
    assert topk.top_k(df.limit(0)).count() == 0


def test_topk_large_components():
    q = np.array([[1 << 40, -3]], np.int64)
    c = np.array([[1 << 21, 5], [-7, 1 << 50], [1 << 21, 5]], np.int64)
    s = topk.accumulate(q, c)
    assert s.tolist() == [[sum(int(a) * int(b) for a, b in zip(q[0], x)) for x in c]]
    assert topk.best_of(s, np.array([-1]), 2).tolist() == [[0, 2]]


# mixing

def test_rake_meets_the_margins():
    rng = np.random.default_rng(5)
    tokens = rng.integers(1, 1000, (4, 3, 5)).astype(float)
    targets = [rng.random(n) + 0.1 for n in tokens.shape]
    w = mixing.rake(tokens, targets)
    for axis, t in enumerate(targets):
        margin = w.sum(axis=tuple(a for a in range(3) if a != axis))
        assert margin == pytest.approx(t / t.sum(), abs=1e-6)
    # raking keeps the odds ratios of the cells
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / x[0, 1, 0] / x[1, 0, 0]
    assert odds(w) == pytest.approx(odds(tokens), rel=1e-6)
    p = mixing.probabilities(tokens, w, 0.4)
    assert (p <= 1).all() and (p * tokens).sum() == pytest.approx(0.4 * tokens.sum())


def test_mixing(spark):
    rows = [(k, long_words(20 + k % 40, k), "src0" if k % 3 else ("src1" if k % 2 else "zzz"), ("en", "de", None)[k % 7 % 3]) for k in range(1500)]
    rows += [(9000, None, None, None), (9001, "", "src0", "en"), (1, "twice", "src0", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("n_tokens", F.lit("clash"))
    targets = mixing.Targets(source={"src0": 1, "src1": 1, mixing.OTHER: 1}, lang={"en": 2, "de": 1, mixing.OTHER: 1}, keep=0.5)
    out, name = mixing.mix(docs, targets)
    got = out.collect()
    assert len(got) == len(rows)
    tokens, expected = Counter(), Counter()
    for r in got:
        found = re.findall(SPACES, r.text or "")
        by = Counter(zlib.crc32(w.lower().encode()) % 8 for w in found if len(w) >= 5)
        assert r[name].n_tokens == len(found) and r[name].topic == str(max(range(8), key=lambda c: (by[c], -c)))
        where = r.source if r.source in ("src0", "src1") else mixing.OTHER
        tokens[where] += len(found)
        expected[where] += len(found) * r[name].probability
    whole = sum(tokens.values())
    assert sum(expected.values()) == pytest.approx(0.5 * whole, rel=1e-6)
    assert expected["src1"] / tokens["src1"] > expected["src0"] / tokens["src0"]
    taken = mixing.sample(docs, targets)
    assert taken.columns == docs.columns and taken.count() == sum(r[name].sampled for r in got)
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0


def test_ftrl_equals_the_plain_update_rule():
    """FTRL-proximal coordinate by coordinate, with plain floats."""
    rng = np.random.default_rng(3)
    s = toxicity.Settings(alpha=0.7, beta=1.0, l1=0.4, l2=0.1)
    size = 1 << toxicity.HASH_BITS
    model, z, n = toxicity.Ftrl(s), defaultdict(float), defaultdict(float)

    def weight(i):
        l1, l2 = (0.0, 0.0) if i == size else (s.l1, s.l2)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + l2)

    for _ in range(300):
        at = np.append(np.unique(rng.integers(0, 40, 6)), size)
        label = int(at[0] % 3 == 0)
        model.learn(at, label)
        old = {i: weight(i) for i in at.tolist()}
        g = 1 / (1 + math.exp(-sum(old.values()))) - label
        for i, w in old.items():
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    at = np.array([*range(40), size])
    assert model.weights(at) == pytest.approx([weight(i) for i in at.tolist()])
    assert (model.weights(at) == 0).any() and (model.weights(at) != 0).any()


def test_toxicity_learns_from_one_row_of_a_repeated_id(spark):
    rows = [(k, long_words(12, k) + (" badword" if k % 2 else "")) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    once = toxicity.fit(frame(spark, rows), labels)
    often = toxicity.fit(frame(spark, rows + [rows[3]] * 40 + [rows[7]] * 9), labels)
    assert (once[0] == often[0]).all() and (once[1] == often[1]).all() and len(once[0])


def test_shard_is_that_of_the_highest_hash(spark):
    import xxhash

    def hashed(seed, shard, doc_id):
        h = 42
        for data in (seed.to_bytes(4, "little"), shard.to_bytes(4, "little"), doc_id.to_bytes(8, "little", signed=True)):
            h = xxhash.xxh64_intdigest(data, seed=h)
        return h - (1 << 64) if h >= 1 << 63 else h

    ids = [0, 1, -5, 1 << 40, *range(1000, 1300)]
    docs = frame(spark, [(k, "t") for k in ids])
    for n in (1, 16, 17):
        got = {r.doc_id: r.s for r in docs.select("doc_id", sharding.rendezvous(F.col("doc_id"), n).alias("s")).collect()}
        assert got == {k: max(range(n), key=lambda s: hashed(sharding.SEED, s, k)) for k in ids}


def test_drawn_documents_meet_the_targets(spark):
    """Each row's draw is that of its id, and the tokens drawn lie near the shares."""
    rows = [(k, long_words(30, k % 97), f"src{k % 2}" if k % 10 else "src2", "en" if k % 3 else "de") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = mixing.Targets(source={"src0": 1, "src1": 1, "src2": 0.5}, lang={"en": 1, "de": 1}, topic={str(k): 1 for k in range(8)}, keep=0.2)
    out, name = mixing.mix(docs, targets)
    draw = F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id"), F.lit(1 << 53)) / float(1 << 53)
    tokens = {"source": Counter(), "lang": Counter(), "topic": Counter()}
    for r in out.select("source", "lang", f"{name}.*", draw.alias("draw")).collect():
        assert 0 <= r.probability <= 1 and r.sampled == (r.draw < r.probability)
        for key in tokens:
            tokens[key][r[key]] += r.n_tokens * r.sampled
    total = sum(tokens["lang"].values())
    assert total == pytest.approx(0.2 * 30 * 6000, rel=0.1)
    for key, shares in (("source", {"src0": 0.4, "src1": 0.4, "src2": 0.2}), ("lang", {"en": 0.5, "de": 0.5}), ("topic", {str(k): 0.125 for k in range(8)})):
        for category, share in shares.items():
            assert tokens[key][category] / total == pytest.approx(share, abs=0.04)


def test_slots_of_shards_of_many_buckets(spark):
    docs = frame(spark, [(k, long_words(3, k)) for k in range(400)])
    got = sharding.write_shards(docs, sharding.scratch_path(spark, "shards"), n_shards=3, bucket_bytes=200)
    info = got.select(f"{got.columns[-1]}.*").collect()
    assert max(r.bucket for r in info) > 8
    for s in range(3):
        assert sorted(r.slot for r in info if r.shard == s) == list(range(sum(r.shard == s for r in info)))


def test_very_long_texts(spark):
    """Long lines, long texts and many lines take no other way."""
    text = "\n".join(long_words(12, k % 50) for k in range(4000))
    docs = frame(spark, [(1, text), (2, "x" * 200_000), (3, "a " * 60_000)])
    vocabulary = sentencepieces.load()
    out = sentencepieces.encode(docs, vocabulary)
    assert all(r[-1]["round_trip"] for r in out.collect())
    cut = {r.doc_id: r for r in linededup.line_dedup(docs, removed_col="gone").collect()}
    assert cut[1].gone == 4000 - 50 and cut[2].gone == cut[3].gone == 0
    f = quality.features(F.col("text"))
    n = {r.doc_id: r.f["n_words"] for r in docs.select("doc_id", f.alias("f")).collect()}
    assert n == {1: 48_000, 2: 1, 3: 60_000}
    assert mixing.sample(docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})).count() >= 0
