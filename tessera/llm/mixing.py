"""Operator 8: mixing sources to target weights by iterative proportional fitting.

The tokens of each cell (source, language, topic) are counted over all documents,
the cells' weights are raked until their margins meet the target shares of
sources, languages and topics, and a document is taken with its cell's
probability, by a seeded hash of its id.

The categories are those that the targets name, and one for all others, so the
table of cells is bounded by the targets, not by the data: it fits the driver,
and its probabilities become a literal lookup without a join.

A topic is a property of the vocabulary: a word of MIN_TOPIC_WORD or more letters
belongs to the class of its hash, and the class with most tokens of the whole
text (ties: the first) is the text's topic.  A column that holds topics can be
named instead.

Defined results: null and empty texts have no tokens and topic 0; a null source
or language is one of the others; targets of categories without tokens are shared
out among the rest; documents of cells without tokens are taken like the mean;
probabilities are at most 1, and the share that this cuts goes to the other
cells; rows that repeat an id are taken or left together.  All columns are kept,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import spare_name
from tessera.session import materialize

OTHER = "other"
N_TOPICS = 8
MIN_TOPIC_WORD = 5
SEED = 11


@dataclass(frozen=True)
class Targets:
    """Shares by category, not necessarily of sum 1; `keep` is the share of all
    tokens that is taken."""

    source: dict[str, float] = field(default_factory=lambda: {f"src{k}": 1.0 for k in range(20)} | {OTHER: 1.0})
    lang: dict[str, float] = field(default_factory=lambda: {"en": 55.0, "de": 15.0, "fr": 15.0, "es": 15.0, OTHER: 5.0})
    topic: dict[str, float] = field(default_factory=lambda: {str(k): 1.0 for k in range(N_TOPICS)})
    keep: float = 0.7

    @property
    def margins(self) -> dict[str, dict[str, float]]:
        return {"source": self.source, "lang": self.lang, "topic": self.topic}


class _Classes(dict):
    """Topic class of a word, -1 for short ones, with bounded memory."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = zlib.crc32(word.lower().encode("utf-8", "replace")) % N_TOPICS if len(word) >= MIN_TOPIC_WORD else -1
        return out


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def with_topics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """`docs` with a struct column of n_tokens and topic; returns its name."""
    name = spare_name(docs, "mix")
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("topic", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _Classes()
        for batch in batches:
            n, topics = [], []
            for text in batch.column(batch.schema.get_field_index(text_col)):
                found = _WORD.findall(text.as_py() or "")
                by_class = np.bincount(np.fromiter(map(classes.__getitem__, found), np.int64, len(found)) + 1,
                                       minlength=N_TOPICS + 1)
                n.append(len(found))
                topics.append(str(int(by_class[1:].argmax())))
            mix = pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(topics, pa.string())], names=["n_tokens", "topic"])
            yield pa.RecordBatch.from_arrays([*batch.columns, mix], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)])), name


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Weights of the cells whose margins are the targets' shares of 1.  Cells
    without tokens stay 0; targets of empty categories are shared out."""
    axes = range(tokens.ndim)
    weights = tokens / max(tokens.sum(), 1e-300)
    shares = []
    for axis, t in zip(axes, targets):
        margin = tokens.sum(axis=tuple(a for a in axes if a != axis))
        t = np.where(margin > 0, t, 0.0)
        shares.append(t / t.sum() if t.sum() > 0 else np.where(margin > 0, 1.0, 0.0))
    for _ in range(rounds):
        moved = 0.0
        for axis, share in zip(axes, shares):
            margin = weights.sum(axis=tuple(a for a in axes if a != axis))
            factor = np.divide(share, margin, out=np.zeros_like(share), where=margin > 0)
            weights = weights * factor.reshape([-1 if a == axis else 1 for a in axes])
            moved = max(moved, float(np.abs(margin - share).max(initial=0.0)))
        if moved < tolerance:
            break
    return weights


def probabilities(tokens: np.ndarray, weights: np.ndarray, keep: float) -> np.ndarray:
    """Probability of a cell's documents: its weight over its tokens, scaled so
    that `keep` of all tokens are expected, and at most 1."""
    want = keep * tokens.sum()
    ratio = np.divide(weights, tokens, out=np.zeros_like(weights), where=tokens > 0)
    full = np.zeros(tokens.shape, bool)
    for _ in range(tokens.size + 1):
        free = (tokens * ratio)[~full].sum()
        scale = (want - tokens[full].sum()) / free if free > 0 else 0.0
        more = ~full & (ratio * scale > 1)
        if not more.any():
            break
        full |= more
    out = np.where(full, 1.0, np.clip(ratio * scale, 0.0, 1.0))
    return np.where(tokens > 0, out, keep)


def _category(column: Column, names: list[str]) -> Column:
    return F.when(column.isin(names), column).otherwise(F.lit(OTHER))


def mix(docs: DataFrame, targets: Targets = Targets(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None,
        drop_text: bool = False) -> tuple[DataFrame, str]:
    """`docs` with a struct column of n_tokens, topic, probability and sampled,
    and that column's name."""
    counted, name = with_topics(docs, text_col)
    counted = materialize(counted.drop(text_col) if drop_text else counted, "mix")
    margins = targets.margins
    topic = F.col(f"`{topic_col}`").cast("string") if topic_col else F.col(name)["topic"]
    raw = {"source": F.col(f"`{source_col}`"), "lang": F.col(f"`{lang_col}`"), "topic": topic}
    keys = {k: _category(raw[k], list(margins[k])) for k in margins}
    names = {k: [*margins[k], *([] if OTHER in margins[k] else [OTHER])] for k in margins}
    cells = counted.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.sum(F.col(name)["n_tokens"]).alias("n")).collect()

    tokens = np.zeros([len(v) for v in names.values()])
    for r in cells:  # at most a row per combination of the targets' categories
        tokens[tuple(names[k].index(r[k]) for k in names)] = r["n"] or 0
    weights = rake(tokens, [np.array([margins[k].get(x, 0.0) for x in names[k]]) for k in names])
    p = probabilities(tokens, weights, targets.keep)
    place = F.lit(0)
    for k in names:
        at = F.element_at(F.create_map(*[x for i, v in enumerate(names[k]) for x in (F.lit(v), F.lit(i))]), keys[k])
        place = place * len(names[k]) + at
    p_doc = F.element_at(F.array(*[F.lit(float(x)) for x in p.ravel()]), place + 1)
    draw = (F.pmod(F.xxhash64(F.lit(SEED), F.col(f"`{id_col}`")), F.lit(1 << 53)) / float(1 << 53))
    return counted.withColumn(name, F.struct(
        F.col(name)["n_tokens"].alias("n_tokens"), topic.alias("topic"), p_doc.alias("probability"),
        (draw < p_doc).alias("sampled"))), name


def digest(docs: DataFrame) -> DataFrame:
    out, name = mix(docs.select("doc_id", "source", "lang", "text"), drop_text=True)
    return out.select("doc_id", "source", "lang", f"{name}.*")


def sample(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The documents that the mixture takes, all columns as they were."""
    out, name = mix(docs, targets)
    return out.where(F.col(name)["sampled"]).drop(name)
