"""Operator 6: language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ORDER bytes.  A symbol that a
context has not seen is coded by an escape to the next shorter context, where the
symbols of the longer one are excluded; the last resort is a uniform choice among
the symbols never seen.  A context with total T and d known symbols gives a known
symbol of count c the probability c / (T + d), and the escape the rest.  Excluded
symbols of a context are always those of its one byte longer extension, so totals
after exclusion are one number per context and a text's code length is a sum of
table lookups.  All probabilities of a context add up to 1.

Counting: every task counts the (ORDER + 1)-grams of its texts, Spark sums them and
derives the shorter ones.  Every node stays: the model is a table that grows with
the training texts.  `gram_costs` gives each gram that any text holds its code
length, order by order: a gram meets the one shorter by its first byte in a join
and its siblings (at most 256) in a window, so no key is hot.  Texts look up grams
of at least 1 / 2**FREQUENT of all bytes in a broadcast (at most 2**FREQUENT of
them) and the others, each of a smaller share, in a join; both hold the same code
lengths, so where the border lies does not change a score.

The unigram base is exact for all words: those of at least 1 / 2**RARE of all
tokens, again a bounded set, are looked up while scoring, the rest is joined.

Defined results: A to Z are lower-cased; null and empty texts are the end symbol
alone; with no training text every symbol costs the uniform choice and every word
is unknown; rows that repeat an id are each scored (and learned from); only id and
text are read, so other columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.session import materialize

ORDER = 5
#: Words of at least 1 / 2**RARE of all tokens, and grams of 1 / 2**FREQUENT of all
#: bytes, are broadcast; the others are joined.
RARE = 20
FREQUENT = 22
SYMBOLS = 256
#: Bytes that UTF-8 never holds: before a text, and its end.
BEFORE, END = 0xFE, 0xFF
#: Bytes of text that a task looks at together.
SLICE_BYTES = 3 << 20
#: Entries of a task's counts before it sends them on.
HELD = 2_000_000

def _lowered(text: str | None) -> bytes:
    """Lower-cased A to Z; bytes.split() then cuts it at the contract's spaces."""
    return (text or "").encode("utf-8", "replace").lower()


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of slices of bounded bytes."""
    held, size, at = [], 0, 0
    for k, value in enumerate(column):
        held.append(_lowered(value.as_py()))
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield at, held
            held, size, at = [], 0, k + 1
    if held:
        yield at, held


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER + 1)-gram of every symbol as an integer, its last byte the
    symbol, and the number of symbols of each text."""
    pad = bytes([BEFORE]) * ORDER
    raw = np.frombuffer(b"".join([x for t in texts for x in (pad, t, bytes([END]))]), np.uint8)
    n = len(raw) - ORDER
    out = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        out = (out << np.uint64(8)) | raw[k:n + k]
    return out[raw[ORDER:] != BEFORE], np.array([len(t) + 1 for t in texts], np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of training texts, and grams of all texts; n: times in training texts,
    times: in all."""
    words: Counter[bytes] = Counter()
    grams, sums, alls, held = [], [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names, place = np.unique(np.concatenate(grams), return_inverse=True)
        return names, *(np.bincount(place, np.concatenate(x), len(names)).astype(np.int64) for x in (sums, alls))

    def sent() -> Iterator[pa.RecordBatch]:
        w, none = list(words), np.zeros(0, np.int64)
        g, c, a = merged() if grams else (none.astype(np.uint64), none, none)
        of_words = np.array(list(words.values()), np.int64)
        word = pa.concat_arrays([pa.array(w, pa.binary()), pa.nulls(len(g), pa.binary())])
        gram = pa.concat_arrays([pa.nulls(len(w), pa.int64()), pa.array(g.astype(np.int64), pa.int64())])
        yield pa.RecordBatch.from_arrays([word, gram, pa.array(np.r_[of_words, c], pa.int64()), pa.array(np.r_[of_words, a], pa.int64())],
                                         names=["word", "gram", "n", "times"])

    for batch in batches:
        for at, texts in _slices(batch.column("text")):
            training = batch.column("training").slice(at, len(texts)).to_pylist()
            for learned in (True, False):
                some = [t for t, flag in zip(texts, training) if flag == learned]
                if not some:
                    continue
                if learned:
                    for t in some:
                        words.update(t.split())
                    words[b""] += len(some)
                g, c = np.unique(codes(some)[0], return_counts=True)
                grams.append(g)
                sums.append(c if learned else np.zeros(len(c), np.int64))
                alls.append(c)
                held += len(g)
            if held > HELD:
                g, c, a = merged()
                grams, sums, alls, held = [g], [c], [a], len(g)
            if held > HELD // 2 or len(words) > HELD // 4:
                yield from sent()
                words.clear()
                grams, sums, alls, held = [], [], [], 0
    if words or grams:
        yield from sent()


class Trie:
    """Log10 probabilities from kept nodes, in memory: the form of the model that
    `gram_costs` is compared with.  `grams[k]` and `contexts[k]` are (sorted codes,
    counts) for contexts of k bytes."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.levels = []
        for k, (names, n) in enumerate(grams):
            at_all, totals = contexts[k]
            own = np.unique(names >> np.uint64(8))
            total = totals[np.searchsorted(at_all, own)].astype(float)
            of = np.searchsorted(own, names >> np.uint64(8))
            known = np.bincount(of, n, len(own))
            kinds = np.bincount(of, minlength=len(own))
            with np.errstate(divide="ignore"):
                level = {"grams": names, "log_n": np.log10(n), "contexts": own,
                         "log_total": np.log10(total + kinds),
                         "escape": np.log10((total - known + kinds) / (total + kinds))}
                if k:
                    below = self.levels[k - 1]
                    short = own & np.uint64((1 << 8 * (k - 1)) - 1)
                    parent = np.searchsorted(below["contexts"], short)
                    twin = np.searchsorted(below["grams"], names & np.uint64((1 << 8 * k) - 1))
                    taken = np.bincount(of, below["n"][twin], len(own))
                    left = below["total"][parent] - taken
                    left_known = below["known"][parent] - taken
                    left_kinds = below["kinds"][parent] - kinds
                    base = left + left_kinds
                    level["log_left"] = np.log10(np.maximum(base, 1e-300))
                    level["escape_left"] = np.where(
                        base > 0, np.log10(np.maximum(left - left_known + left_kinds, 1e-300) / np.maximum(base, 1e-300)), 0.0)
            level |= {"n": n.astype(float), "total": total, "known": known, "kinds": kinds}
            self.levels.append(level)
        seen = int(self.levels[0]["kinds"][0]) if self.levels and len(self.levels[0]["kinds"]) else 0
        self.unseen = -np.log10(max(1, SYMBOLS - seen))

    def tables(self) -> tuple[list[dict[str, np.ndarray]], float]:
        keep = ("grams", "log_n", "contexts", "log_total", "escape", "log_left", "escape_left")
        return [{k: v for k, v in x.items() if k in keep} for x in self.levels], self.unseen


def _found(sorted_names: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_names):
        return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return at, sorted_names[at] == names


def log_probabilities(grams: np.ndarray, tables: tuple[list[dict[str, np.ndarray]], float]) -> np.ndarray:
    """Log10 probability of each gram's last byte after the bytes before it."""
    levels, unseen = tables
    out = np.zeros(len(grams))
    left = np.arange(len(grams))  # not coded yet
    child = np.full(len(grams), -1)  # context one byte longer, if there is one
    for k in range(len(levels) - 1, -1, -1):
        level, g = levels[k], grams[left]
        at, is_context = _found(level["contexts"], (g >> np.uint64(8)) & np.uint64((1 << 8 * k) - 1))
        gram, known = _found(level["grams"], g & np.uint64((1 << 8 * (k + 1)) - 1))
        deeper = child[left] >= 0
        first = is_context & ~deeper
        add = np.zeros(len(left))
        add[first] = np.where(known[first], level["log_n"][gram[first]] - level["log_total"][at[first]], level["escape"][at[first]])
        if deeper.any():
            above, c = levels[k + 1], child[left[deeper]]
            add[deeper] = np.where(known[deeper], level["log_n"][gram[deeper]] - above["log_left"][c], above["escape_left"][c])
        out[left] += add
        child[left] = np.where(is_context, at, -1)
        left = left[~(known & is_context)]
    out[left] += unseen
    return out


def gram_costs(grams: DataFrame) -> DataFrame:
    """(code, times, cost) for rows (gram, n, times) of distinct (ORDER + 1)-grams:
    the log10 probability of the last byte after the others, from the counts n.

    Of a gram in its context, `whole` is the cost where the context is the first
    one looked at, and `after` the cost behind the escape from it."""
    forms = F.array(*[F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("code"))
                      for k in range(ORDER + 1)])
    nodes = materialize(grams.select("n", "times", F.explode(forms).alias("x")).groupBy("x").agg(
        F.sum("n").alias("n"), F.sum("times").alias("times")).select("x.*", "n", "times"), "ppm-nodes")
    siblings = Window.partitionBy(F.shiftright("code", 8))
    known = F.col("n") > 0
    coded = F.log10("n") - F.log10(F.col("total") + F.col("kinds"))
    escape = F.log10("kinds") - F.log10(F.col("total") + F.col("kinds"))
    below = None
    for k in range(ORDER + 1):
        level = nodes.where(F.col("k") == k).select("code", "n", "times")
        counted = {"total": F.sum("n").over(siblings), "kinds": F.sum(known.cast("long")).over(siblings)}
        if below is None:
            level = level.withColumns(counted).withColumn("after", -F.log10(F.greatest(F.lit(1), SYMBOLS - F.col("kinds"))))
            shorter = F.col("after")
        else:
            level = level.withColumn("short", F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(below, "short")
            taken = F.sum(F.when(known, F.col("short_n")).otherwise(0)).over(siblings)
            level = level.withColumns(counted | {"taken": taken})
            left_kinds = F.col("short_kinds") - F.col("kinds")
            base = F.col("short_total") - F.col("taken") + left_kinds
            level = level.withColumn("after", F.when(F.col("short_n") > 0, F.log10("short_n") - F.log10(base)).otherwise(
                F.when(left_kinds > 0, F.log10(left_kinds) - F.log10(base)).otherwise(0.0) + F.col("short_after")))
            shorter = F.col("short_whole")
        level = level.withColumn("whole", F.when(F.col("kinds") == 0, shorter).when(known, coded).otherwise(
            escape + F.col("after")))
        below = level.select(F.col("code").alias("short"), *[F.col(c).alias(f"short_{c}") for c in ("n", "total", "kinds", "after", "whole")])
    return level.select("code", "times", F.col("whole").alias("cost"))


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of `docs`: id, n_tokens, n_known, train_tokens, base_score and
    score; the models learn from the rows where `training` holds."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    counts = materialize(texts.mapInArrow(_count, "word binary, gram long, n long, times long")
                         .groupBy("word", "gram").agg(F.sum("n").alias("n"), F.sum("times").alias("times")), "ppm-counts")
    words = counts.where("word is not null").select("word", "n")
    grams = counts.where("gram is not null").select("gram", "n", "times")
    costs = materialize(gram_costs(grams), "ppm-costs")
    n_bytes = costs.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = F.col("times").cast("decimal(38,0)") * (1 << FREQUENT) >= n_bytes
    frequent = costs.where(often).select("code", "cost").sort("code").toArrow()  # at most 2**FREQUENT grams
    n_tokens, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = words.where(F.col("n").cast("decimal(38,0)") * (1 << RARE) >= n_tokens).toArrow()  # at most 2**RARE words
    spark = docs.sparkSession
    whole = float(n_tokens + n_words + 1)
    sent = spark.sparkContext.broadcast((
        frequent.column("code").to_numpy().astype(np.uint64), frequent.column("cost").to_numpy(),
        dict(zip(common.column("word").to_pylist(), np.log10((common.column("n").to_numpy() + 1) / whole).tolist()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_sent, costs_sent, known = sent.value
        for batch in batches:
            for at, held in _slices(batch.column("text")):
                grams, lengths = codes(held)
                names, place = np.unique(grams, return_inverse=True)
                near, is_sent = _found(codes_sent, names)
                cost = np.zeros(len(names))
                cost[is_sent] = costs_sent[near[is_sent]]
                ends = np.cumsum(lengths)
                scores = np.add.reduceat(cost[place], np.r_[0, ends[:-1]])
                open_at = np.flatnonzero(~is_sent[place])
                text_of = np.searchsorted(ends, open_at, side="right")
                pairs, often = np.unique(text_of * len(names) + place[open_at], return_counts=True)
                borders = pa.array(np.searchsorted(pairs, np.arange(len(held) + 1) * len(names)), pa.int32())
                loose = [pa.ListArray.from_arrays(borders, pa.array(x, pa.int64()))
                         for x in (names[pairs % len(names)].astype(np.int64), often)]
                n, sure, base, rare, times = [], [], [], [], []
                for t in held:
                    found = Counter(t.split())
                    found[b""] = 1
                    total, hits, others = 0.0, 0, []
                    for w, c in found.items():
                        p = known.get(w)
                        if p is None:
                            others.append(w)
                        else:
                            total += c * p
                            hits += c
                    n.append(sum(found.values()))
                    sure.append(hits)
                    base.append(total)
                    rare.append(others)
                    times.append([found[w] for w in others])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(held)), batch.column("held_out").slice(at, len(held)),
                     pa.array(n, pa.int64()), pa.array(sure, pa.int64()), pa.array(base, pa.float64()), pa.array(scores),
                     pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())), *loose],
                    names=["id", "held_out", "n_tokens", "sure", "base", "score", "rare", "times", "grams", "gram_times"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (~training).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    scored = materialize(rows.mapInArrow(
        run, f"id {id_type}, held_out boolean, n_tokens long, sure long, base double, score double, "
             "rare array<binary>, times array<long>, grams array<long>, gram_times array<long>").withColumn("row", F.monotonically_increasing_id()), "ppm-scored")
    loose = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", "x.rare", "x.times")
    more_words = (loose.join(words.withColumnRenamed("word", "rare"), "rare", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / whole)).alias("more_base"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known")))
    open_grams = scored.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("x")).select(
        "row", F.col("x.grams").alias("code"), F.col("x.gram_times").alias("often"))
    more_grams = open_grams.join(costs.where(~often).select("code", "cost"), "code").groupBy("row").agg(
        F.sum(F.col("often") * F.col("cost")).alias("more_score"))
    return scored.join(more_words, "row", "left").join(more_grams, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("sure") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def digest(docs: DataFrame) -> DataFrame:
    return score(docs, crc_mod(F.col("doc_id"), 7) != 2)
