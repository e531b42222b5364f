"""N-gram Jaccard join and substring dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ngramjoin, shingles, substrings
from tessera.llm.components import components


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def near_copy(rng, text, words, share):
    return " ".join(rng.choice(words) if rng.random() < share else w for w in text.split(" "))


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    part = {i: i for i in sets}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                hi, lo = max(top(a), top(b)), min(top(a), top(b))
                part[hi] = lo
    return {i: top(i) for i in sets}


def corpus(seed):
    rng = random.Random(seed)
    words = vocabulary(rng)
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 14, 18, 25, 40, 60, 90, 150, 260):
        base = " ".join(rng.choice(words) for _ in range(size))
        rows += [base, base.upper(), base.replace(" ", "\n  ")]
        for share in (0.004, 0.01, 0.02, 0.03, 0.05):
            rows.append(near_copy(rng, base, words, share))
        rows += [base + " " + words[0], " ".join(base.split(" ")[1:]), base + " " + base]
    rows += ["", None, " \n ", "É é", "é É"]
    return list(enumerate(rows))


@pytest.mark.parametrize("run", [ngramjoin.RUN, 3])
def test_join_equals_brute_force(spark, monkeypatch, run):
    """Also with runs so short that most links come from pivots and cells."""
    monkeypatch.setattr(ngramjoin, "RUN", run)
    rows = corpus(5)
    want = brute_components(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = {r.doc_id: r.component_id for r in ngramjoin.link_components(docs).collect()}
    assert got == want


def test_join_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "RUN", 2)
    monkeypatch.setattr(ngramjoin, "CELL_BYTES", 2000)
    monkeypatch.setattr(ngramjoin, "HELD", 4)
    rng = random.Random(1)
    words = vocabulary(rng)
    base = " ".join(rng.choice(words) for _ in range(80))
    rows = list(enumerate(near_copy(rng, base, words, rng.choice([0.01, 0.04, 0.08])) for _ in range(90)))
    got = {r.doc_id: r.component_id for r in ngramjoin.link_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_every_set_has_an_allocation_that_cannot_miss():
    rng = np.random.default_rng(0)
    for size in (1, 3, 5, 9, 33, 100, 1000, 20000):
        s = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        own = ngramjoin.band_of(len(s))
        for band in (own, own - 1):
            need = ngramjoin.most_differences(len(s), band) + 1 if band >= 0 else 0
            if need:
                mask = ngramjoin.steps_that_suit(s, band)
                for k, step in enumerate(ngramjoin.LADDER):
                    if mask >> k & 1:
                        _, count = ngramjoin._counts(s, ngramjoin.segments(band, step))
                        exact, more = ngramjoin.allocation(count, need, ngramjoin._BORDERS[band] <= ngramjoin.SMALL, 10)
                        assert exact.sum() + more.sum() == need and (count[exact] > 0).all() and (count[more] > 1).all()


def test_bands_above_the_first_step_suit_all_of_their_sets():
    """Many small sets, some of which the first step does not suit: each set of a
    band has an allocation at a step that the whole band indexes."""
    rng = np.random.default_rng(1)
    for size in (9, 10):
        sets = [np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(20_000)]
        band = ngramjoin.band_of(size)
        need = ngramjoin.most_differences(size, band) + 1
        masks = Counter(ngramjoin.steps_that_suit(s, band) for s in sets)
        steps = ngramjoin.chosen_steps(masks)
        assert any(not m & 1 for m in masks) and any(m & 1 and not m >> 1 & 1 for m in masks)
        assert all(any(m >> k & 1 for k in steps) for m in masks)
        for s in sets[:2000]:
            index, probes = set(), 0
            for sig, role in ngramjoin.signatures(s, {band: steps}, {band: len(sets)}):
                index |= set(sig.tolist())
                probes += (role == ngramjoin.BOTH).sum()
            assert probes >= need
    with pytest.raises(ValueError):
        ngramjoin.allocation(np.array([9, 0, 0]), 3, True, 10)


def test_links_of_sets_that_need_a_higher_step(spark):
    """Texts of 13 words whose last word differs (Jaccard 0.8): nothing to spare."""
    rng = random.Random(12)
    words = vocabulary(rng, 3000)
    rows = []
    for k in range(1500):
        base = [rng.choice(words) for _ in range(13)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:-1] + ["z" + base[-1]]))]
    got = {r.doc_id: r.component_id for r in ngramjoin.link_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_join_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "q w e r t y"), (2, "q w e r t y"), (None, "a b c d e f"),
                                  (3, None), (4, "")], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id) for r in ngramjoin.link_components(docs).collect())
    assert got == [(-1, 2, None), (1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4)]
    assert ngramjoin.link_components(docs.limit(0)).count() == 0
    kept = ngramjoin.keep_one(docs.withColumn("_gone", F.lit(1)).withColumn("id", F.lit(7)))
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 1, 1, 3, 4]
    assert kept.columns == ["doc_id", "text", "_gone", "id"]


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 300)]
    edges = [(a, b) if rng.random() < .5 else (b, a) for a, b in path + star + [(5, 5)]]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(200, 300)]}


def passages():
    rng = random.Random(9)
    words = vocabulary(rng, 900)

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    shared = [text(52), text(60), text(75)]
    rows = []
    for k in range(24):
        body = text(150).split(" ")
        if k % 2 == 0:
            at = rng.randint(20, 120)
            body[at:at] = shared[k // 2 % 3].split(" ")
        rows.append((k, " ".join(body)))
    return rows, shared


def test_repeated_passages_are_found_and_the_rest_is_left(spark):
    rows, shared = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.digest(docs).collect()}
    texts = dict(rows)
    for k, r in got.items():
        assert r.has_repeat == (k % 2 == 0)
        assert (r.n_removed_words > 0) == (k % 2 == 0 and k >= 6)
        if r.n_removed_words:
            # the first copy, and maybe later ones with the same word beside the passage
            assert r.copy_of[0] == k // 2 % 3 * 2 and all((k - x) % 6 == 0 and x < k for x in r.copy_of)
            words = texts[k].split(" ")
            for span in r.removed_spans:
                # a paragraph that is alike enough may reach two words beyond
                assert " ".join(words[span.start + 2:span.end - 2]) in shared[k // 2 % 3]
    cut = {r.doc_id: r.text for r in substrings.remove_repeats(docs).collect()}
    for k, r in got.items():
        assert len(cut[k].split()) == len(texts[k].split()) - r.n_removed_words


def test_minima_are_those_of_every_paragraph():
    """Against a loop over all runs of PARAGRAPH words and all bands."""
    rng = np.random.default_rng(4)
    width = substrings.PARAGRAPH - substrings.WORDS + 1
    texts = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (0, 3, 19, 20, 43, 44, 45, 300, 90)]
    salts = substrings.mixed(np.arange(2 * substrings.bands(), dtype=np.uint64), 101) | np.uint64(1)
    want, at = set(), 0
    for x in texts:
        for flip, times in zip(salts[::2], salts[1::2]):
            order = ((x ^ flip) * times) | np.uint64(1)
            starts = range(len(x) - width + 1) if len(x) >= width else [0] if len(x) >= substrings.MIN_WORDS - 4 else []
            want |= {at + j + int(order[j:j + width].argmin()) for j in starts}
        at += len(x)
    got = substrings.minima(np.concatenate(texts), np.array([len(x) for x in texts]))
    assert got.tolist() == sorted(want)
    found = 0
    for _ in range(1500):  # paragraphs of Jaccard 0.8: the recall that the bands were chosen for
        a = rng.integers(0, 1 << 63, width, dtype=np.uint64)
        b = a.copy()
        b[rng.choice(width, 4, replace=False)] = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
        mine = [set(x[substrings.minima(x, np.array([width]))].tolist()) for x in (a, b)]
        found += bool(mine[0] & mine[1])
    assert found / 1500 >= substrings.RECALL - 0.01


def test_passages_join_runs_while_they_are_alike():
    assert substrings.passages(0, 60, []) == [(0, 60)]
    assert substrings.passages(0, 55, [27]) == [(0, 55)]  # 46 of 56 shingles
    assert substrings.passages(0, 40, [20]) == []  # two runs of 20 words, not alike enough
    assert substrings.passages(10, 100, [10, 11, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 98]) == [(12, 40), (50, 98)]
    assert substrings.passages(0, 20, []) == []


def brute_passages(low, high, differ):
    """All stretches between ends of runs, each compared as a whole; the longest ones."""
    equal = [p not in differ for p in range(low, high)]
    cuts = [low - 1, *differ, high]
    runs = [(a + 1, b) for a, b in zip(cuts, cuts[1:]) if b - a > substrings.WORDS]
    found = []
    for i, (a, _) in enumerate(runs):
        for _, b in runs[i:]:
            total = b - a - substrings.WORDS + 1
            common = sum(all(equal[p - low:p - low + substrings.WORDS]) for p in range(a, a + total))
            if 5 * common >= 4 * (2 * total - common) and b - a >= substrings.MIN_WORDS:
                found.append((a, b))
    return [x for x in found if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in found)]


def test_passages_are_the_longest_stretches_that_are_alike(spark):
    """changes near one end of a passage do not cut that end off."""
    assert substrings.passages(0, 150, [10, 20, 30]) == [(0, 150)]
    assert substrings.passages(0, 150, [119, 129, 139]) == [(0, 150)]
    rng = random.Random(17)
    for _ in range(300):
        low = rng.randint(0, 9)
        high = low + rng.randint(0, 160)
        differ = sorted(rng.sample(range(low, high), min(high - low, rng.randint(0, 9))))
        assert substrings.passages(low, high, differ) == brute_passages(low, high, differ), (low, high, differ)
    passage = [f"p{i}" for i in range(150)]
    edited = [f"x{i}" if i in (10, 20, 30) else w for i, w in enumerate(passage)]
    rows = [(k, " ".join([f"{k}a{i}" for i in range(30)] + x + [f"{k}b{i}" for i in range(30)])) for k, x in enumerate((passage, edited))]
    got = {r.doc_id: r for r in substrings.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.end) for s in got[1].removed_spans] == [(30, 180)] and got[1].copy_of == [0]


@pytest.mark.parametrize("n,changes", [(55, 1), (100, 2), (150, 3)])
def test_edited_passages_in_other_words_are_found(spark, n, changes):
    """Passages with changed words, evenly spaced, between random words (Jaccard 0.8
    or more): at least nine of ten are linked, and what goes is the passage."""
    rng = np.random.default_rng(n)

    def words(k):
        return [f"w{x}" for x in rng.integers(0, 1 << 40, k)]

    rows, span = [], {}
    for k in range(100):
        passage = words(n)
        for copy in range(2):
            own = list(passage)
            if copy:
                for c in range(changes):
                    own[(c + 1) * n // (changes + 1)] = words(1)[0]
            lead = words(int(rng.integers(20, 70)))
            rows.append((2 * k + copy, " ".join(lead + own + words(int(rng.integers(20, 70))))))
            span[2 * k + copy] = (len(lead), len(lead) + n)
    got = {r.doc_id: r for r in substrings.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [k for k, r in got.items() if r.copy_of == [k - 1]]
    assert len(linked) >= 90 and all(k % 2 for k in linked)
    whole = [k for k in linked if [(s.start, s.end) for s in got[k].removed_spans] == [span[k]]]
    assert len(whole) >= 0.9 * len(linked)
    assert not any(r.n_removed_words for k, r in got.items() if k % 2 == 0)


def brute_repeats(texts):
    """Places of every text that lie in 24 words or more equal to those of an
    earlier place (earlier text, or the same one)."""
    seen, out = {}, {}
    for k, text in texts:
        w = text.split()
        out[k] = set()
        for a in range(len(w) - 23):
            key = tuple(w[a:a + 24])
            if key in seen:
                out[k] |= set(range(a, a + 24))
            else:
                seen[key] = (k, a)
    return out


@pytest.mark.parametrize("parts", [False, True])
def test_exact_repeats_of_paragraphs_against_brute_force(spark, parts):
    """Nothing goes that does not repeat 24 words; whole copies go to the last word,
    copies of copies and several in one text too.  Where an earlier document holds
    only a part of a passage, less than a paragraph may stay at its edge."""
    rng = random.Random(21)
    pool = [[f"p{j}x{i}" for i in range(rng.randint(48, 130))] for j in range(6)]
    rows = []
    for k in range(60):
        body = []
        for _ in range(rng.randint(1, 4)):
            body += [f"u{rng.getrandbits(40)}" for _ in range(rng.randint(5, 40))]
            if rng.random() < 0.7:
                p = rng.choice(pool)
                body += p[rng.randint(0, len(p) - 48):] if parts and rng.random() < 0.5 else p
        rows.append((k, " ".join(body)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[5][1] + " " + rows[5][1])]
    want = brute_repeats(rows)
    for r in substrings.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got = {p for s in r.removed_spans for p in range(s.start, s.end)}
        if not parts and r.doc_id != 102:  # two copies of a text, in one that is no copy as a whole
            assert want[r.doc_id] == got, r.doc_id
        assert got <= want[r.doc_id] | ({*range(len(dict(rows)[r.doc_id].split()))} if r.doc_id in (100, 101) else set())
        left = sorted(want[r.doc_id] - got)
        run = 0
        for k, p in enumerate(left):
            run = run + 1 if k and left[k - 1] == p - 1 else 1
            assert run < substrings.PARAGRAPH


def test_substrings_of_odd_tables(spark):
    long = " ".join(f"w{k}" for k in range(70))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, long), (4, long), (None, long), (5, "x " * 300)],
                                 "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.has_repeat, r.n_removed_words > 0) for r in substrings.digest(docs).collect())
    assert got == [(-1, False, False), (1, False, False), (2, False, False), (3, False, False), (4, False, False),
                   (4, False, False), (5, True, True)]
    assert substrings.digest(docs.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_their_block(monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", 16)
    h = shingles.WordHasher()
    rng = random.Random(6)
    texts = ["".join(rng.choice("abC é\n\t\x0b ") for _ in range(rng.randint(0, 120))) for _ in range(200)] + [None, "", "z" * 40, "a " + "y" * 17]
    known = {}
    for t, got in zip(texts, h.texts(texts)):
        words = (t or "").encode().lower().split()
        assert len(words) == len(got)
        for w, x in zip(words, got.tolist()):
            assert known.setdefault(w, x) == x
    assert len(set(known.values())) == len(known) and h.texts([]) == []
    assert shingles.shingle_set(h.texts([None])[0]).size == 0


def test_repeated_passages_are_removed_whole(spark):
    """Copies of 51 to 120 words between other words go to the last word, edges
    and the places between paragraphs too; the first copy stays."""
    rng = np.random.default_rng(8)

    def words(n):
        return [f"w{x}" for x in rng.integers(0, 1 << 40, n)]

    rows, want = [], {}
    for k, n in enumerate((51, 60, 75, 100, 120) * 4):
        passage = words(n)
        for copy in range(3):
            lead = words(int(rng.integers(0, 80)))
            rows.append((3 * k + copy, " ".join(lead + passage + words(int(rng.integers(0, 80))))))
            want[3 * k + copy] = [(len(lead), len(lead) + n)] if copy else []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.removed_spans] for r in substrings.digest(docs).collect()}
    for k, spans in got.items():
        assert len(spans) == len(want[k])
        for (start, end), (first, last) in zip(spans, want[k]):
            # whole; a paragraph that is alike enough may reach two words beyond
            assert first - 2 <= start <= first and last <= end <= last + 2


def test_copies_are_found_by_their_paragraphs(spark):
    """The paragraphs of a whole copy are joined and compared like any others; its
    link as a whole comes on top."""
    text = " ".join(f"word{i}" for i in range(130))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text), (4, "alone " * 3)], "doc_id long, text string")
    found = Counter((r.id, r.first_id, r.start, r.end) for r in substrings.repeats(docs).collect())
    assert found == {(2, 1, 0, 130): 2, (3, 1, 0, 130): 2}
    rows = {r.doc_id: (r.has_repeat, r.n_removed_words, r.copy_of) for r in substrings.digest(docs).collect()}
    assert rows == {1: (True, 0, []), 2: (True, 130, [1]), 3: (True, 130, [1]), 4: (False, 0, [])}
