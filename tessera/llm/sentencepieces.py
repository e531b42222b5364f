"""Operator 1: SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words (the mark U+2581 stands for a space and leads the
word).  The distinct words of a batch are sorted, which lays out their trie in
depth-first order, and walked with a stack of forward states: a word only
computes the states below the prefix that it shares with the word before it.

The forward state of a prefix is its best score and last piece.

* ``unigram`` models: the best sum of piece scores.
* ``bpe`` models (the vocabulary here is one): the library merges neighbours by
  rank instead of adding scores.  A sequence of pieces is what it would return
  exactly if each adjacent pair is what it returns for the pair's own text, so
  the lattice has score 0 for such pairs and none for the others, and one path
  is left per prefix.  The ids equal those of the sentencepiece library.

Characters that the vocabulary lacks become byte pieces.  Decoding is a table
lookup over bytes.  Both are row-local: no shuffle, a bounded cache of words and
of adjacent pairs per Python worker, texts taken by a bounded number of bytes, and
the broadcast vocabulary has the size of its file.

Defined results: null and empty texts have no tokens; a text that holds the mark
itself decodes to a space there, as in the library (round_trip is false); other
columns are kept, whatever their names; repeated rows are each encoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from dataclasses import fields as dataclass_fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import spare_name, worker_cache

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of words and pairs of pieces that a Python worker remembers.
CACHED_CHARS = 1_000_000
CACHED_PAIRS = 250_000
#: Bytes of the texts whose words are put into one trie; a row counts for so many besides.
BYTES_AT_ONCE = 1 << 20
ROW_BYTES = 1 << 10


@dataclass(frozen=True)
class Vocabulary:
    kind: str  # "bpe" or "unigram"
    pieces: dict[str, int]  # ordinary pieces
    scores: dict[str, float]
    byte_ids: tuple[int, ...]  # 256, or none without byte fallback
    unknown_id: int
    decoded: tuple[bytes, ...]  # by id


def load(path: str = MODEL, kind: str = "bpe") -> Vocabulary:
    """Reads a model file on the driver.  Models that rewrite characters or
    hold marks inside pieces are refused."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "Ａ  b"
    if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("only models with the identity normaliser and a leading mark are supported")
    pieces, scores, by_byte, decoded = {}, {}, {}, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        text = p.replace(MARK, " ").encode()
        if sp.is_byte(i):
            by_byte[int(p[3:-1], 16)], text = i, bytes([int(p[3:-1], 16)])
        elif sp.is_control(i):
            text = b""
        elif sp.is_unknown(i):
            text = " ⁇ ".encode()
        elif not sp.is_unused(i):
            pieces[p], scores[p] = i, sp.get_score(i)
        decoded.append(text)
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece with a mark inside crosses words")
    return Vocabulary(kind, pieces, scores, tuple(by_byte[b] for b in range(256)) if by_byte else (),
                      sp.unk_id(), tuple(decoded))


class Encoder:
    """Pieces of words, for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        # pieces spelled backwards; None leads to the entry of a whole piece: the
        # piece, its ids as bytes, its score, and which pieces may stand before it
        self.backwards: dict = {}
        self.entries: list[tuple] = []
        for piece in vocabulary.pieces:
            node = self.backwards
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = self.entry(piece, [vocabulary.pieces[piece]])
            self.entries.append(node[None])
        self.single: dict[str, tuple] = {}  # entries of characters that the vocabulary lacks
        self.known: dict[str, bytes] = {}
        self.known_chars = self.known_pairs = 0
        long_chars = {c for p in vocabulary.pieces if len(p) > 1 for c in p}
        # a line feed that no longer piece holds is a word of its own: fewer distinct words
        shared = "\n" in long_chars
        self.cut = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+" if shared else rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.lowest = min(vocabulary.scores.values(), default=0.0) - 10.0

    def entry(self, piece: str, ids: list[int]) -> tuple[str, bytes, float | None, dict[str, bool]]:
        return piece, np.array(ids, np.int32).tobytes(), self.v.scores.get(piece), {}

    def merged(self, text: str) -> list[str]:
        """The library's merge order on a short text: best score first, then
        leftmost."""
        parts, scores = list(text), self.v.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def count_pair(self) -> None:
        if self.known_pairs >= CACHED_PAIRS:
            for e in self.entries:
                e[3].clear()
            self.single.clear()
            self.known_pairs = 0
        self.known_pairs += 1

    def fits(self, left: str, right: tuple) -> bool:
        self.count_pair()
        out = right[3][left] = self.merged(left + right[0]) == ([left, right[0]] if left else [right[0]])
        return out

    def character(self, c: str) -> tuple:
        out = self.single.get(c)
        if out is None:
            self.count_pair()
            out = self.single[c] = self.entry(c, [self.v.byte_ids[b] for b in c.encode()] if self.v.byte_ids else [self.v.unknown_id])
        return out

    def learn(self, fresh: list[str]) -> None:
        """Pieces of sorted distinct words, depth-first over their trie.
        states[j] is (score, last piece's entry) of the current word's prefix of j."""
        bpe, root, lowest = self.v.kind == "bpe", self.backwards, self.lowest
        states: list[tuple[float, tuple]] = [(0.0, ("", b""))]
        before = ""
        for word in fresh:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                # the pieces that end here, the shortest first; a single character always can
                node, at, ending = root, end, []
                while at and (node := node.get(word[at - 1])) is not None:
                    at -= 1
                    if None in node:
                        ending.append(node[None])
                if not ending or len(ending[0][0]) > 1:
                    ending.insert(0, self.character(word[end - 1]))
                best = None
                while ending:
                    piece = ending.pop()
                    score, last = states[end - len(piece[0])]
                    if bpe:
                        fits = piece[3].get(last[0])
                        if fits or fits is None and self.fits(last[0], piece):
                            best = (0.0, piece)
                            break
                    else:
                        score += lowest if piece[2] is None else piece[2]
                        if best is None or score > best[0]:
                            best = (score, piece)
                states.append(best)
            at, found = len(word), []
            while at:
                piece = states[at][1]
                found.append(piece[1])
                at -= len(piece[0])
            found.reverse()
            self.known[word] = b"".join(found)
            self.known_chars += len(word)
            before = word

    def forget(self, but: set[str]) -> None:
        """Leaves the words of `but` when too many are known."""
        if self.known_chars > CACHED_CHARS:
            self.known = {w: self.known[w] for w in but}
            self.known_chars = sum(map(len, self.known))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = set().union(*cut)
        again = words & self.known.keys()
        self.learn(sorted(words - again))
        known = self.known
        out = [np.frombuffer(b"".join([known[w] for w in ws]), np.int32) for ws in cut]
        self.forget(again)
        return out


def decode(ids: np.ndarray | list[int], decoded: tuple[bytes, ...]) -> str:
    """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
    text = b"".join([decoded[i] for i in np.asarray(ids, np.int64).tolist()]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _parts(batch: pa.RecordBatch, source: str) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` of some BYTES_AT_ONCE of its column `source`, each of at
    least a row."""
    column = batch.column(batch.schema.get_field_index(source))
    sizes = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES)
    borders = [0, *(np.flatnonzero(np.diff(ends // BYTES_AT_ONCE)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a)


def _with_column(docs: DataFrame, name: str, fn, source: str, out_type: T.DataType) -> DataFrame:
    """`docs` with a column that `fn` makes of the Arrow arrays of `source`."""
    out = spare_name(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, out_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, source):
                yield pa.RecordBatch.from_arrays([*part.columns, fn(part.column(part.schema.get_field_index(source)))],
                                                 names=[*part.schema.names, out])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", check: bool = True) -> DataFrame:
    """`docs` with a last struct column: ids, n_tokens and, if `check`,
    round_trip (the ids decode to the text)."""
    # a plain tuple: workers have no copy of this package
    sent = docs.sparkSession.sparkContext.broadcast(tuple(getattr(vocabulary, f.name) for f in dataclass_fields(vocabulary)))
    key = ("sentencepieces", hash((vocabulary.kind, vocabulary.decoded)))
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    if check:
        fields.append(T.StructField("round_trip", T.BooleanType()))

    def fn(column: pa.Array) -> pa.Array:
        encoder = worker_cache(key, lambda: Encoder(Vocabulary(*sent.value)))
        texts = column.to_pylist()
        rows = encoder.encode(texts)
        lengths = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat, pa.int32()))
        parts = [ids, pa.array(lengths)]
        if check:
            parts.append(pa.array([decode(r, encoder.v.decoded) == (t or "") for r, t in zip(rows, texts)], pa.bool_()))
        return pa.StructArray.from_arrays(parts, names=[f.name for f in fields])

    return _with_column(docs, "pieces", fn, text_col, T.StructType(fields))


def decode_column(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """`docs` with a last string column: the text of `ids_col`; null for null."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.decoded)

    def fn(column: pa.Array) -> pa.Array:
        return pa.array([None if r is None else decode(r, sent.value) for r in column.to_pylist()], pa.string())

    return _with_column(docs, "decoded", fn, ids_col, T.StringType())


def digest(docs: DataFrame, path: str = MODEL) -> DataFrame:
    out = encode(docs.select("doc_id", "text"), load(path))
    return out.select("doc_id", F.col(out.columns[-1])["n_tokens"].alias("n_tokens"),
                      F.col(out.columns[-1])["round_trip"].alias("round_trip"),
                      F.col(out.columns[-1])["ids"].alias("ids"))
