"""Operator 2 [native]: quality rules as a learned decision list.

Every feature of a text is a native, row-local Spark expression.  The rules are
learned by sequential covering: the labelled documents are reduced to counts per
cell of binned features, every step of growing or pruning a rule is one small
aggregate over these cells, and the driver only ever sees a histogram of
(features x thresholds) rows.  The result is an ordered list of threshold
conjunctions that is emitted as one ``CASE WHEN`` expression.

Defined results: a null text counts as an empty one (0 words, base fails);
null labels are ignored, of several labels of a document the lowest counts;
without labels the list is empty and everything that passes the base is kept;
repeated rows are each judged; other columns are passed through untouched,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, let, spare_name, without_spaces, words
from tessera.session import materialize

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_SHARES = [0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95]
#: Feature -> thresholds a condition may use.
GRID: dict[str, list[float]] = {
    "f_words": [5, 10, 20, 30, 50, 80, 120, 200, 400, 800, 1600, 3200, 6400],
    "f_word_length": [2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 10, 12, 16],
    "f_symbols_per_word": [0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1, 1.5, 2, 3],
    "f_duplicate_lines": _SHARES,
    "f_repeated_words": _SHARES,
    "f_distinct_words": _SHARES,
    "f_upper": _SHARES,
    "f_digits": _SHARES,
    "f_marks_per_word": [0.0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1, 1.5, 2, 3],
    "f_words_per_line": [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256],
}


@dataclass(frozen=True)
class Settings:
    """Parameters of the learner."""

    max_rules: int = 12
    max_conditions: int = 4
    min_precision: float = 0.95  # of a rule, on the pruning part
    min_covered: int = 5  # rejected documents that a rule must cover, growing part
    grow_parts: int = 2  # of 3 parts of the labelled documents; the rest prunes


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def holds_for_bin(self) -> Column:
        """The same test on the binned feature: bin b holds the values above b
        thresholds."""
        at = GRID[self.feature].index(self.threshold)
        return F.col(self.feature) > at if self.above else F.col(self.feature) <= at


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)

    def on_bins(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.holds_for_bin()
        return out

    def on_features(self, features: Column) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(features[c.feature])
        return out


def _repeated_words(tokens: Column) -> Column:
    """Number of words within windows of WINDOW words that occur twice or more
    in the text.  Most texts end at the set test; only the others are sorted."""
    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = F.filter(s, lambda x, k: F.coalesce(
                (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), F.lit(False)))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        repeated = let(let(pairs, positions), total)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(repeated)

    starts = F.sequence(F.lit(1), F.size(tokens) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))
    return F.when(F.size(tokens) > WINDOW, let(hashes, covered)).otherwise(F.lit(0).cast("long"))


def features(text: Column) -> Column:
    """Struct of the contract's counts and the learner's features of a text."""
    def of(t: Column) -> Column:
        def with_words(w: Column) -> Column:
            def with_lines(lines: Column) -> Column:
                return F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.length(without_spaces(t)).cast("long").alias("word_chars"),
                    F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                    _repeated_words(w).alias("n_repeat_words"),
                    F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
                    F.regexp_count(t, F.lit(r"[0-9]")).cast("long").alias("n_digits"),
                    F.regexp_count(t, F.lit(r"[!?.,;:]")).cast("long").alias("n_marks"))
            return let(F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)), with_lines)
        return let(words(t), with_words)

    def ratios(s: Column) -> Column:
        def per(a: str, b: str) -> Column:
            return (s[a] / F.greatest(s[b], F.lit(1))).cast("double")
        return F.struct(
            *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            s["n_words"].cast("double").alias("f_words"),
            per("word_chars", "n_words").alias("f_word_length"),
            per("n_symbols", "n_words").alias("f_symbols_per_word"),
            per("n_dup_lines", "n_lines").alias("f_duplicate_lines"),
            per("n_repeat_words", "n_words").alias("f_repeated_words"),
            per("n_distinct_words", "n_words").alias("f_distinct_words"),
            per("n_upper", "word_chars").alias("f_upper"),
            per("n_digits", "word_chars").alias("f_digits"),
            per("n_marks", "n_words").alias("f_marks_per_word"),
            per("n_words", "n_lines").alias("f_words_per_line"))

    return let(let(F.coalesce(text, F.lit("")), of), ratios)


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def _cells(featured: DataFrame, f: str, labels: DataFrame, id_col: str) -> DataFrame:
    """Counts of rejected (pos) and good (neg) labelled documents that pass the
    base, per cell of binned features and part of the labelled documents."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality")))
    bins = []
    for name, grid in GRID.items():
        above = F.lit(0)
        for t in grid:
            above = above + F.when(F.col(f)[name] > t, 1).otherwise(0)
        bins.append(above.alias(name))
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(3))
    rows = (featured.where(~base_failed(F.col(f)))
            .select(F.col(id_col).alias("_doc"), part.alias("part"), *bins)
            .join(marks, F.col("_doc") == F.col("_id")))
    return rows.groupBy("part", *GRID).agg(
        F.sum(F.when(F.col("_quality") == 0, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("_quality") == 0, 0).otherwise(1)).alias("neg"))


def _histogram(cells: DataFrame, where: Column) -> dict[str, dict[int, tuple[int, int]]]:
    """(pos, neg) by feature and bin: at most features x thresholds rows."""
    stacked = ", ".join(f"'{name}', {name}" for name in GRID)
    rows = (cells.where(where).selectExpr(f"stack({len(GRID)}, {stacked}) as (feature, bin)", "pos", "neg")
            .groupBy("feature", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect())
    out: dict[str, dict[int, tuple[int, int]]] = {name: {} for name in GRID}
    for r in rows:
        out[r["feature"]][r["bin"]] = (r["pos"], r["neg"])
    return out


def _best_condition(hist: dict[str, dict[int, tuple[int, int]]], min_covered: int) -> tuple[float, Condition, int, int] | None:
    """The condition of the highest FOIL gain.  Ties go to the first feature,
    and of its thresholds to the one that leaves the rule the least room: texts
    unlike the rejected ones stay."""
    any_feature = next(iter(hist.values()))
    p0, n0 = (sum(v[k] for v in any_feature.values()) for k in (0, 1))
    if not p0:
        return None
    best = None
    for name, grid in GRID.items():
        below_p = below_n = 0
        for at, threshold in enumerate(grid):
            p, n = hist[name].get(at, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, (cp, cn) in ((True, (p0 - below_p, n0 - below_n)), (False, (below_p, below_n))):
                if cp < min_covered or (cp, cn) == (p0, n0):
                    continue
                gain = cp * (log2(cp / (cp + cn)) - log2(p0 / (p0 + n0)))
                tied = best is not None and abs(gain - best[0]) <= 1e-9
                narrower = tied and above and best[1].above and best[1].feature == name
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9 or narrower):
                    best = (gain, Condition(name, above, threshold), cp, cn)
    return best


def learn_rules(cells: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Sequential covering: grow a rule on one part, prune its last conditions
    on the other, keep it if it is precise there, take away what it covers."""
    growing = F.col("part") < settings.grow_parts
    left = F.lit(True)
    rules: list[Rule] = []
    while len(rules) < settings.max_rules:
        rule, negatives = Rule(), 1
        while len(rule.conditions) < settings.max_conditions and negatives:
            found = _best_condition(_histogram(cells, left & growing & rule.on_bins()), settings.min_covered)
            if found is None:
                break
            rule.conditions.append(found[1])
            negatives = found[3]
        if not rule.conditions:
            break
        prefixes = [Rule(rule.conditions[:k + 1]) for k in range(len(rule.conditions))]
        sums = [F.sum(F.when(r.on_bins(), F.col(c)).otherwise(0)).alias(f"{c}{k}")
                for k, r in enumerate(prefixes) for c in ("pos", "neg")]
        got = cells.where(left & ~growing).agg(*sums).first()
        scored = []
        for k, r in enumerate(prefixes):
            p, n = got[f"pos{k}"] or 0, got[f"neg{k}"] or 0
            scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n, r))
        _, _, p, n, pruned = max(scored, key=lambda x: x[:2])
        if not p or p / (p + n) < settings.min_precision:
            break
        rules.append(pruned)
        left = left & ~pruned.on_bins()
    return rules


def verdict(features_col: Column, rules: list[Rule]) -> Column:
    """Ordered conditional expression: the number of the first rule that
    rejects the text, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k, r in reversed(list(enumerate(rules, 1))):
        out = F.when(r.on_features(features_col), F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          drop_text: bool = False, settings: Settings = Settings()) -> tuple[DataFrame, str]:
    """`docs` with a struct column of features, base_failed, rule and kept;
    returns it with that column's name.  The features are computed once and
    written to the shared folder, as learning and judging both read them."""
    f = spare_name(docs, "quality")
    columns = [F.col(f"`{c}`") for c in docs.columns if not (drop_text and c == text_col)]
    featured = materialize(docs.select(*columns, features(F.col(f"`{text_col}`")).alias(f)), "quality")
    cells = materialize(_cells(featured, f, labels, id_col), "quality-cells")
    rule = verdict(F.col(f), learn_rules(cells, settings))
    judged = F.struct(F.col(f"{f}.*"), base_failed(F.col(f)).alias("base_failed"), rule.alias("rule"),
                      (~base_failed(F.col(f)) & rule.isNull()).alias("kept"))
    return featured.withColumn(f, judged), f


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` that the base and the learned rules keep, all columns
    as they were."""
    judged, f = judge(docs, labels, id_col, text_col, settings=settings)
    return judged.where(F.col(f)["kept"]).drop(f)
