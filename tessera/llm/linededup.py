"""Operator 4 [native]: line dedup by overlapping windows of three lines.

Every three consecutive lines of a text are hashed (128 bits), a window that
occurs more than once in the corpus keeps its first occurrence (lowest document
id, then position), and every line that a later occurrence covers is removed.
So a line only goes if an equal line stands earlier, and by induction one copy
of every line stays.

Windows are hashed once and written to the shared folder.  Only hashes and
positions are shuffled; hot windows are counted map-side and joined by a plain
equi-join that adaptive execution can split.

Defined results: lines are what stands between line feeds, and lines without a
word count neither as part of a window nor are they removed; texts of less than
three lines with words stay as they are; a null text stays null; rows with the
same id and text are one document, so they get the same result, and rows with
the same id and different texts are different documents.  Null ids sort first.
Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, let, spare_name
from tessera.session import materialize

WINDOW = 3


def _worded(lines: Column) -> Column:
    """Indexes of the lines that have a word."""
    marked = F.transform(lines, lambda x, i: F.when(x.rlike(WORD), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _windows(text: Column) -> Column:
    """(place, h1, h2) of every window; place counts lines with words."""
    def of(lines: Column) -> Column:
        def hashed(x: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(x) - WINDOW)
            return F.when(F.size(x) >= WINDOW, F.transform(starts, lambda i: F.struct(
                i.alias("place"), F.xxhash64(F.slice(x, i + 1, WINDOW)).alias("h1"),
                F.xxhash64(F.lit(1), F.slice(x, i + 1, WINDOW)).alias("h2"))))
        return let(F.filter(lines, lambda x: x.rlike(WORD)), hashed)
    return let(F.split(text, "\n"), of)


def _without(text: Column, places: Column) -> Column:
    """The text without the lines that the windows at `places` cover."""
    def of(lines: Column) -> Column:
        def kept(worded: Column) -> Column:
            covered = F.flatten(F.transform(places, lambda k: F.slice(worded, k + 1, WINDOW)))
            stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
            return F.struct(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"),
                            (F.size(lines) - F.size(stay)).cast("long").alias("n_removed"))
        return let(_worded(lines), kept)
    return let(F.split(text, "\n"), of)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               removed_col: str | None = None) -> DataFrame:
    """`docs` with later occurrences of repeated windows cut out of the text;
    `removed_col` names a new column for the number of lines that went."""
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    digest = F.xxhash64(text, F.length(text))
    # written once: both the counts and the later occurrences are read from it
    spans = materialize(docs.select(doc_id.alias("d"), digest.alias("t"), F.explode(_windows(text)).alias("w")).select(
        "d", "t", "w.*"), "windows")
    at = F.struct("d", "t", "place")
    repeated = (spans.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
                .where(F.col("first") < F.col("last")).drop("last"))
    later = spans.join(repeated, ["h1", "h2"]).where(F.col("first") < at)
    cuts = later.groupBy(F.col("d").alias("_d"), F.col("t").alias("_t")).agg(
        F.collect_set("place").alias("_places"))
    row = spare_name(docs, "row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    own_text = F.col(row)[text_col]
    joined = rows.join(cuts, F.col(row)[id_col].eqNullSafe(F.col("_d"))
                       & (F.xxhash64(own_text, F.length(own_text)) == F.col("_t")), "left")
    cut = F.when(F.col("_places").isNotNull(), _without(own_text, F.col("_places")))
    out = [F.coalesce(F.col("_cut")["text"], own_text).alias(c) if c == text_col else F.col(row)[c].alias(c)
           for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(F.col("_cut")["n_removed"], F.lit(0)).cast("long").alias(removed_col))
    return joined.select(row, cut.alias("_cut")).select(*out)


ORACLE = r"""
with lines as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as no
  from documents),
worded as (
  select doc_id, text, no, line, row_number() over (partition by doc_id, text order by no) as place
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
windows as (
  select a.doc_id, a.text, a.place, a.line as l1, b.line as l2, c.line as l3
  from worded a
  join worded b on a.doc_id = b.doc_id and a.text = b.text and b.place = a.place + 1
  join worded c on a.doc_id = c.doc_id and a.text = c.text and c.place = a.place + 2),
ranked as (
  select *, row_number() over (partition by l1, l2, l3 order by doc_id, place) as occurrence from windows),
covered as (
  select distinct r.doc_id, r.text, r.place + k as place
  from ranked r, (select unnest([0, 1, 2]) as k) where r.occurrence > 1),
kept as (
  select l.doc_id, l.text, string_agg(l.line, chr(10) order by l.no) as new_text, count(*) as n
  from lines l
  left join worded w on w.doc_id = l.doc_id and w.text = l.text and w.no = l.no
  left join covered c on c.doc_id = w.doc_id and c.text = w.text and c.place = w.place
  where c.place is null group by l.doc_id, l.text)
select d.doc_id, coalesce(k.new_text, case when d.text is not null then '' end) as text,
       cast(len(string_split(d.text, chr(10))) - coalesce(k.n, 0) as bigint) as n_removed
from documents d left join kept k on k.doc_id = d.doc_id and k.text = d.text
"""
