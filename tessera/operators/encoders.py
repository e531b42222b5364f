"""Pluggable encoders.

An encoder is a Python function ``list[str] -> np.ndarray (n, dim)`` (sentence
encoder) or ``list[list[str]] -> list[np.ndarray (layers, len, dim)]`` (token
encoder).  It is registered as the function itself or, for a model that takes long
to load, as a factory without arguments that returns it: the factory is what
travels to the workers, and each Python worker calls it once and keeps the model
for all tasks that it runs.  The default encoders are deterministic hashing
encoders (``stand-ins`` whose numbers SQL can compute too); a deployment registers
its own model under a name, which a stored index records.
"""

from __future__ import annotations

import hashlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import WORD_RE, blank_guard
from tessera.operators.dense import double_lists, layer_softmax, vector_sum

DIM = 64
# Tokens whose hash a worker keeps.
KEPT_TOKENS = 200_000
# What an encoder is given at a time, at most: texts and their characters, or
# sentences and their tokens (or one longer text or sentence).
ROWS_AT_ONCE = 256
CHARS_AT_ONCE = 1 << 20
TOKENS_AT_ONCE = 1 << 14

#: name -> (key of the loaded model in a worker, factory)
_SENTENCE: dict[str, tuple[str, Callable]] = {}
_TOKEN: dict[str, tuple[str, Callable]] = {}


def register_encoder(name: str, fn: Callable | None = None, kind: str = "sentence", factory: Callable | None = None) -> None:
    """Registers a function, or a ``factory`` that loads and returns it."""
    if (fn is None) == (factory is None):
        raise ValueError("give the encoder's function or a factory")
    made = factory if fn is None else lambda: fn
    (_SENTENCE if kind == "sentence" else _TOKEN)[name] = (uuid.uuid4().hex, made)


def _registered(name: str, kind: str) -> tuple[str, Callable]:
    known = _SENTENCE if kind == "sentence" else _TOKEN
    if name not in known:
        raise KeyError(f"unknown {kind} encoder {name!r}; registered: {sorted(known)}")
    return known[name]


def check_registered(name: str, kind: str) -> None:
    """Raises if there is no encoder of that name."""
    _registered(name, kind)


def _loaded(key: str, factory: Callable) -> Callable:
    """The model of a worker, loaded on its first use.  Functions reach a worker
    by value and anew for each task, so what outlasts a task is kept in a module
    of the worker itself."""
    held = sys.modules.setdefault("tessera_encoders_loaded", types.ModuleType("tessera_encoders_loaded")).__dict__
    if key not in held:
        held[key] = factory()
    return held[key]


# ---------------------------------------------------------------- stand-ins
def _hashing() -> Callable[[list[list[str]], int], tuple[np.ndarray, np.ndarray]]:
    """(bucket, sign) of every token: the first eight hex digits of its MD5 modulo
    DIM, and whether the ninth is even."""
    kept: dict[str, int] = {}  # twice the bucket, and one more for a negative sign

    def of(token: str) -> int:
        out = kept.get(token)
        if out is None:
            if len(kept) > KEPT_TOKENS:
                kept.clear()
            h = hashlib.md5(token.encode("utf-8")).hexdigest()
            out = kept[token] = 2 * (int(h[:8], 16) % DIM) + int(h[8], 16) % 2
        return out

    def hashed(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.fromiter((of(t) for x in lists for t in x), np.int64, sum(map(len, lists)))
        return codes >> 1, (1 - 2 * (codes & 1)).astype(np.float32)

    return hashed


def hashing_sentence_encoder() -> Callable[[list[str]], np.ndarray]:
    """Signed hashing of lower-cased word tokens."""
    import regex

    word, hashed = regex.compile(WORD_RE), _hashing()

    def encode(texts: list[str]) -> np.ndarray:
        lists = [word.findall(t.lower()) for t in texts]
        bucket, sign = hashed(lists)
        out = np.zeros((len(texts), DIM), np.float32)
        np.add.at(out, (np.repeat(np.arange(len(lists)), [len(x) for x in lists]), bucket), sign)
        return out

    return encode


def hashing_token_encoder(layers: int = 3) -> Callable[[list[list[str]]], list[np.ndarray]]:
    """Layer l of token i is the hashed vector of the token plus its neighbours,
    scaled by l + 1."""
    hashed = _hashing()
    scales = np.arange(1, layers + 1, dtype=np.float32)[:, None, None]

    def encode(sentences: list[list[str]]) -> list[np.ndarray]:
        bucket, sign = hashed(sentences)
        base = np.zeros((len(bucket), DIM), np.float32)
        base[np.arange(len(bucket)), bucket] = sign
        out, at = [], 0
        for tokens in sentences:
            own = base[at:at + len(tokens)]
            at += len(tokens)
            ctx = own.copy()
            ctx[1:] += own[:-1]
            ctx[:-1] += own[1:]
            out.append(ctx * scales)
        return out

    return encode


register_encoder("hashing", kind="sentence", factory=hashing_sentence_encoder)
register_encoder("hashing", kind="token", factory=hashing_token_encoder)


# ---------------------------------------------------------------- jobs
def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ROWS_AT_ONCE rows, and of ``most`` in size or one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        to = min(max(at + 1, to), at + ROWS_AT_ONCE)
        yield at, to
        at = to


def _vector_lists(x: np.ndarray) -> pa.ListArray:
    x = np.ascontiguousarray(x, np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int64) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))


def _vector_bytes(x: np.ndarray) -> pa.Array:
    """Vectors as their float32 numbers, little-endian: one value per vector."""
    x = np.ascontiguousarray(x, "<f4")
    ends = np.arange(len(x) + 1, dtype=np.int64) * x.shape[1] * 4
    if ends[-1] >= 1 << 31:
        raise ValueError("vectors of more than 2 GB at once")
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(x.reshape(-1))])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all numbers in double, how many each vector has, which vectors are null or
    hold a null) of a column of lists or of packed vectors."""
    none = column.is_null().to_numpy(zero_copy_only=False).copy()
    if pa.types.is_binary(column.type):
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) // 4
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        if none.any() or not len(sizes) or column.buffers()[2] is None:
            data = b"".join(column.drop_null().to_pylist())
            return np.frombuffer(data, "<f4").astype(np.float64), sizes, none
        return np.frombuffer(column.buffers()[2], "<f4", int(sizes.sum()), int(offsets[0])).astype(np.float64), sizes, none
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    none[np.repeat(np.arange(len(sizes)), sizes)[flat.is_null().to_numpy(zero_copy_only=False)]] = True
    return pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64), sizes, none


def sentence_vectors(docs: DataFrame, encoder: str = "hashing", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """encode the original text (not lemmas); an empty text is encoded
    as '.' and its vector then set to zero (C9)."""
    key, factory = _registered(encoder, "sentence")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _slices(pc.binary_length(batch.column("guarded")).to_numpy(zero_copy_only=False), CHARS_AT_ONCE):
                part = batch.slice(at, to - at)
                vecs = np.array(_loaded(key, factory)(part.column("guarded").to_pylist()), np.float32)
                vecs[part.column("blank").to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays([part.column("id"), _vector_lists(vecs)], names=["id", "vec"])

    text = F.col(text_col)
    guarded = docs.select(F.col(id_col).alias("id"), blank_guard(text_col).alias("guarded"),
                          (F.coalesce(text, F.lit("")) == "").alias("blank"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return guarded.mapInArrow(run, f"id {id_type}, vec array<float>").withColumnRenamed("id", id_col)


def _encoded(batches: Iterator[pa.RecordBatch], key: str, factory: Callable) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(sentence ids, layers of each) of the sentences that have a token, slice by slice."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False)
        for at, to in _slices(sizes, TOKENS_AT_ONCE):
            part = batch.slice(at, to - at)
            sentences = [[t for t in x or [] if t is not None] for x in part.column("tokens").to_pylist()]
            outs = _loaded(key, factory)(sentences)
            some = [k for k, x in enumerate(outs) if x.shape[1]]
            if some:
                yield part.column("sent_id").to_numpy()[some], [outs[k] for k in some]


def token_layer_vectors(sents: DataFrame, encoder: str = "hashing", packed: bool = False) -> DataFrame:
    """(sent_id, layer, pos, vec) for every token of every sentence,
    computed slice by slice.  With ``packed`` a vector is one binary value, its
    float32 numbers, as a dump holds it: written and read as one value, not number
    by number."""
    key, factory = _registered(encoder, "token")
    column = _vector_bytes if packed else _vector_lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, outs in _encoded(batches, key, factory):
            sizes = [(sid, x.shape[0], x.shape[1]) for sid, x in zip(ids, outs)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.full(layers * n, sid) for sid, layers, n in sizes]), pa.int64()),
                pa.array(np.concatenate([np.repeat(np.arange(layers), n) for _, layers, n in sizes]), pa.int32()),
                pa.array(np.concatenate([np.tile(np.arange(n), layers) for _, layers, n in sizes]), pa.int32()),
                column(np.concatenate([x.reshape(-1, x.shape[2]) for x in outs]))],
                names=["sent_id", "layer", "pos", "vec"])

    return sents.select(F.col("sent_id").cast("long"), "tokens").mapInArrow(
        run, f"sent_id long, layer int, pos int, vec {'binary' if packed else 'array<float>'}")


def add_norms(df: DataFrame, vec: str, name: str = "norm") -> DataFrame:
    """``df`` with the vectors ``vec`` (lists or packed) replaced by their Euclidean
    norms, in double, a batch at a time (M2); null for a vector that is null or holds
    a null."""
    kept = [c for c in df.columns if c != vec]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes, none = _numbers(batch.column(vec))
            if len(sizes) and sizes[0] and (sizes == sizes[0]).all():
                vectors = values.reshape(len(sizes), -1)
                squares = np.einsum("ij,ij->i", vectors, vectors)
            else:
                squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), values * values, len(sizes))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(np.sqrt(squares), mask=none)], names=schema.names)

    return df.mapInArrow(run, schema)


def pooled_layer_vectors(sents: DataFrame, weights: DataFrame, encoder: str = "hashing", gamma: float = 1.0) -> DataFrame:
    """(sent_id, vec), as ``dense.mixed_pool`` of ``token_layer_vectors``: the
    layers are mixed and a sentence's tokens summed in the task that encodes them,
    so a row per sentence leaves it, not one per token and layer."""
    key, factory = _registered(encoder, "token")
    mix = {r["layer"]: r["sw"] for r in layer_softmax(weights).collect()}  # a row per layer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, outs in _encoded(batches, key, factory):
            parts = np.stack([sum((mix[k] * layer.sum(axis=0, dtype=np.float64) for k, layer in enumerate(x) if k in mix),
                                  np.zeros(x.shape[2])) for x in outs])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), double_lists(parts), pa.array([x.shape[1] for x in outs], pa.int64())],
                names=["sent_id", "part", "n"])

    rows = sents.select(F.col("sent_id").cast("long"), "tokens").mapInArrow(run, "sent_id long, part array<double>, n long")
    total = vector_sum(rows, ["sent_id"], F.col("part"), {"n": F.sum("n")})
    return total.select("sent_id", F.transform("vec", lambda x: x * F.lit(gamma) / F.col("n").cast("double")).alias("vec"))
