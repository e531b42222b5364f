"""Text, token and id-array column functions.

All functions take and return ``Column``s built from Spark builtins so they
stay inside whole-stage code generation where Spark allows it.  Regexes use an
explicit Unicode class: plain ``\\w`` in Java is ASCII-only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour).
# Word character class used by every tokenizer.
WORD_CLASS = r"[\p{L}\p{N}_]"
WORD_RE = WORD_CLASS + "+"
# Vectoriser tokens: at least two word characters.
VEC_TOKEN_RE = WORD_CLASS + "{2,}"
# Language-model special tokens.
BOS, EOS, UNK = "<S>", "</S>", "<UNK>"
VOCAB_SENTINEL = "!!!MAXTERMID"
# Character ids: 0-255 are UTF-8 bytes; then begin/end of sentence,
# begin/end of word, padding.  Words are cut to max_word_length - 2 bytes.
BOS_CHAR, EOS_CHAR, BOW_CHAR, EOW_CHAR, PAD_CHAR = 256, 257, 258, 259, 260
MAX_WORD_LENGTH = 50


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text) -> Column:
    """Lower-cased Unicode word runs."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_RE), 0)


def ws_tokens(text) -> Column:
    """Whitespace tokens, no empty strings."""
    return F.array_remove(F.split(_c(text), r"\s+"), "")


def vectorizer_tokens(tokens) -> Column:
    """C4: re-tokenise joined lemmas the way a default vectoriser does:
    lower-case, runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(F.array_join(_c(tokens), " ")), F.lit(VEC_TOKEN_RE), 0)


def strip(text) -> Column:
    """White space of any kind cut off both ends."""
    return F.regexp_replace(_c(text), r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")


def has_word_char(token) -> Column:
    """Token contains at least one word character."""
    return _c(token).rlike(WORD_CLASS)


def keep_word_tokens(tokens) -> Column:
    """P1 applied to an array column."""
    return F.filter(_c(tokens), lambda t: t.rlike(WORD_CLASS))


def tokens_join(tokens) -> Column:
    """C5."""
    return F.array_join(_c(tokens), " ")


def counted(tokens) -> Column:
    """The distinct tokens of an array with their counts, as structs (term, cnt):
    the array is sorted and its runs are measured, all within the row."""
    def runs(x: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (F.get(x, i) != F.get(x, i - 1)))
        return F.when(F.size(x) > 0, F.transform(F.array(at), lambda p: F.transform(
            p, lambda i, k: F.struct(F.get(x, i).alias("term"), (F.coalesce(F.get(p, k + 1), F.size(x)) - i).cast("long").alias("cnt"))))[0])

    # the one-element arrays keep the sorted tokens and the starts from being computed per element
    out = F.transform(F.array(F.sort_array(F.array_compact(_c(tokens)))), runs)[0]
    return F.coalesce(out, F.array().cast("array<struct<term:string,cnt:bigint>>"))


def reverse_tokens(text) -> Column:
    """Reverse the whitespace tokens of a sentence."""
    return F.array_join(F.reverse(ws_tokens(text)), " ")


def blank_guard(text) -> Column:
    """An empty (or null) text is encoded as '.' (its vector is masked to
    zero later)."""
    return F.when(F.coalesce(_c(text), F.lit("")) == F.lit(""), F.lit(".")).otherwise(_c(text))


def char_ids(word, max_word_length: int = MAX_WORD_LENGTH) -> Column:
    """Fixed-length character-id array for one word.

    UTF-8 bytes cut at ``max_word_length - 2``, framed by begin/end-of-word
    marks and padded.  The sentence tokens map to the sentence marks.
    """
    w = _c(word)
    keep = max_word_length - 2
    byte_strs = F.regexp_extract_all(F.hex(F.encode(w, "UTF-8")), F.lit(".."), 0)
    data = F.slice(F.transform(byte_strs, lambda h: F.conv(h, 16, 10).cast("int")), 1, keep)

    def framed(body: Column) -> Column:
        return F.concat(
            F.array(F.lit(BOW_CHAR)), body, F.array(F.lit(EOW_CHAR)),
            F.array_repeat(F.lit(PAD_CHAR), F.lit(max_word_length - 2) - F.size(body)),
        )

    return (F.when(w == F.lit(BOS), framed(F.array(F.lit(BOS_CHAR))))
            .when(w == F.lit(EOS), framed(F.array(F.lit(EOS_CHAR))))
            .otherwise(framed(data)))


def pad_ids(ids, max_len) -> Column:
    """Shift real ids by +1 and pad with 0 up to ``max_len``."""
    return F.concat(F.transform(_c(ids), lambda x: x + 1),
                    F.array_repeat(F.lit(0), _c(max_len) - F.size(_c(ids))))


def crop(arr, n) -> Column:
    """Crop a padded array back to its real length."""
    return F.slice(_c(arr), 1, _c(n))


def mask(ids) -> Column:
    """C14: true where the (shifted) id is a real token."""
    return F.transform(_c(ids), lambda x: x > 0)


def seq_length(ids) -> Column:
    """C14: number of real (non-padding) positions."""
    return F.size(F.filter(_c(ids), lambda x: x > 0))


def strip_marks(arr, length) -> Column:
    """Drop the BOS position and the EOS position (index ``length``),
    keeping the padding tail, so the width shrinks by two."""
    a, n = _c(arr), _c(length)
    return F.concat(F.slice(a, 2, n - 2), F.slice(a, n + 1, F.size(a) - n))


def name_metadata(name, pattern: str, group: int) -> Column:
    """One regex group of a file name / URL."""
    return F.regexp_extract(_c(name), pattern, group)


def score_format(score) -> Column:
    """C17: display formatting with two decimals (display only)."""
    return F.format_string("%.2f", _c(score))


def strip_bom(text) -> Column:
    return F.regexp_replace(_c(text), r"^\uFEFF", "")
