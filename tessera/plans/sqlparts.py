"""DuckDB SQL fragments shared by the oracle twins (same rules as the Spark
builders; documented in SURVEY 5 'Oracle rules')."""

WORD = r"[\p{L}\p{N}_]+"

TOK = rf"tok AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM documents)"

# Derived lemma table (`stats.lemma_table_from_vocab`) and documents as lemmas.
LEMMAS = rf"""rawtok AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM documents),
forms AS (SELECT DISTINCT unnest(toks) AS form FROM rawtok),
lemmas AS (SELECT form, CASE WHEN form LIKE '%ing' AND length(form) > 5 THEN substring(form, 1, length(form) - 3)
                             WHEN form LIKE '%s' AND length(form) > 3 THEN substring(form, 1, length(form) - 1)
                             ELSE form END AS lemma FROM forms)"""

LEMMA_TOK = f"""{LEMMAS},
tok AS (SELECT r.doc_id, coalesce(x.toks, []) AS toks FROM rawtok r LEFT JOIN (
   SELECT doc_id, list(lemma) AS toks FROM (SELECT doc_id, unnest(toks) AS form FROM rawtok) JOIN lemmas USING (form) GROUP BY doc_id) x USING (doc_id))"""

# Stand-in encoders: bucket and sign of a token from its MD5.
DIM = 64


def bucket(token: str) -> str:
    return f"('0x' || substr(md5({token}), 1, 8))::BIGINT % {DIM}"


def sign(token: str) -> str:
    return f"(1 - 2 * (('0x' || substr(md5({token}), 9, 1))::BIGINT % 2))::DOUBLE"


def dense_sql(name: str, ids: str, sparse: str, key: str) -> str:
    """``name(key, dim, val)``: every dimension of every row of ``ids`` from a
    sparse SELECT (key, dim, val)."""
    return f"""{name} AS (SELECT i.{key}, d.dim, coalesce(s.val, 0.0) AS val FROM {ids} i CROSS JOIN (SELECT unnest(range({DIM})) AS dim) d
   LEFT JOIN ({sparse}) s ON s.{key} = i.{key} AND s.dim = d.dim)"""


def sentence_vectors_sql(name: str, source: str, key: str) -> str:
    """``name(key, dim, val)`` of the texts of ``source`` (key, text)."""
    return dense_sql(name, source, f"""SELECT {key}, {bucket('t')} AS dim, sum({sign('t')}) AS val
   FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '{WORD}')) AS t FROM {source}) GROUP BY ALL""", key)


def token_context_sql(name: str, source: str, key: str) -> str:
    """``name(key, pos, dim, val)``: the token and its neighbours, hashed; the
    tokens of ``source`` are (key, toks)."""
    return f"""{name}_t AS (SELECT {key}, unnest(range(len(toks))) AS pos, unnest(toks) AS t FROM {source}),
{name} AS (SELECT a.{key}, a.pos, {bucket('b.t')} AS dim, sum({sign('b.t')}) AS val
   FROM {name}_t a JOIN {name}_t b ON b.{key} = a.{key} AND b.pos BETWEEN a.pos - 1 AND a.pos + 1 GROUP BY ALL)"""


CNT = """cnt AS (SELECT doc_id, term, count(*) AS cnt FROM (SELECT doc_id, unnest(toks) AS term FROM tok) GROUP BY doc_id, term),
lens AS (SELECT doc_id, len(toks)::BIGINT AS dl FROM tok),
nn AS (SELECT count(*)::DOUBLE AS n, avg(dl::DOUBLE) AS avgdl FROM lens),
st AS (SELECT term, count(*)::BIGINT AS df, sum(cnt)::BIGINT AS cf FROM cnt GROUP BY term)"""

KEYS = """keys AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS text_key FROM documents),
reps AS (SELECT text_key, (row_number() OVER (ORDER BY text_key) - 1)::BIGINT AS text_idx FROM (SELECT DISTINCT text_key FROM keys))"""


def bm25_ctes(mode: str = "document", k: float = 2.0, b: float = 0.75, tok: str = TOK) -> str:
    n = "df" if mode == "document" else "cf"
    return f"""{tok},
{CNT},
idf AS (SELECT term, {n} AS n_qi, CASE WHEN (nn.n - {n} + 0.5) / ({n} + 0.5) > 0 THEN ln((nn.n - {n} + 0.5) / ({n} + 0.5)) END AS idf FROM st, nn),
post AS (SELECT c.doc_id, c.term, c.cnt, l.dl,
   c.cnt * (idf.idf * (c.cnt::DOUBLE / l.dl) * {k + 1.0} / ((c.cnt::DOUBLE / l.dl) + {k} * ({1.0 - b} + {b} * l.dl / nn.avgdl))) AS weight
   FROM cnt c JOIN lens l USING (doc_id) JOIN idf USING (term), nn)"""


TFIDF_CTES = rf"""{TOK},
vtok AS (SELECT doc_id, regexp_extract_all(lower(array_to_string(toks, ' ')), '[\p{{L}}\p{{N}}_]{{2,}}') AS toks FROM tok),
vcnt AS (SELECT doc_id, term, count(*) AS cnt FROM (SELECT doc_id, unnest(toks) AS term FROM vtok) GROUP BY doc_id, term),
vn AS (SELECT count(*)::DOUBLE AS n FROM vtok),
vst AS (SELECT term, count(*) AS df FROM vcnt GROUP BY term),
vidf AS (SELECT term, ln((1.0 + vn.n) / (1.0 + df)) + 1.0 AS idf FROM vst, vn),
raw AS (SELECT c.doc_id, c.term, c.cnt * vidf.idf AS w FROM vcnt c JOIN vidf USING (term)),
post AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def search_sql(queries: str, k: int = 10, fill_zero: bool = True, lemmas: bool = False) -> str:
    """``queries`` is a SELECT giving (query_id, text); needs CTE ``post``
    (doc_id, term, weight) and KEYS defined before (and LEMMAS with ``lemmas``)."""
    join = "LEFT JOIN" if fill_zero else "JOIN"
    term, found = ("coalesce(lemma, form)", "LEFT JOIN lemmas USING (form)") if lemmas else ("form", "")
    return rf"""qsrc AS ({queries}),
q AS (SELECT DISTINCT query_id, {term} AS term FROM (SELECT query_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS form FROM qsrc) {found}),
qids AS (SELECT DISTINCT query_id FROM qsrc),
scored AS (SELECT q.query_id, p.doc_id, coalesce(sum(p.weight), 0.0) AS score FROM q JOIN post p USING (term)
   JOIN keys kk ON kk.doc_id = p.doc_id AND kk.doc_id = kk.text_key GROUP BY q.query_id, p.doc_id),
allc AS (SELECT qids.query_id, r.text_key AS doc_id, r.text_idx, s.score FROM qids CROSS JOIN reps r
   {join} scored s ON s.query_id = qids.query_id AND s.doc_id = r.text_key),
ranked AS (SELECT query_id, doc_id, text_idx, coalesce(score, 0.0) AS score,
   row_number() OVER (PARTITION BY query_id ORDER BY round(coalesce(score, 0.0), 9) DESC, text_idx) AS rank FROM allc)"""
