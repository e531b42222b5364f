"""Registered queries: dense vectors (SURVEY 2.4, 2.7 E12-E13, 2.8 F7-F12,
F15, 2.6 D3/D4/D8, C9, C18).  Word vectors, token vectors and layers are
derived from ``embeddings`` by the SURVEY 7.3 rules in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import vectors as vx
from tessera.operators import dense, lexical, stats
from tessera.plans.registry import register, rounded
from tessera.plans.sqlparts import CNT, KEYS, TOK, WORD
from tessera.sources.tables import benchmark_queries, documents, table, turn_id

# Fixed parameters of the layer mix (model weights, not data).
LAYER_WEIGHTS = [0.0, 0.5, 1.0]


def _dim(spark, sf) -> int:
    return table(spark, sf, "embeddings").select(F.max(F.size("embedding"))).first()[0] or 0


def fasttext(spark, sf):
    """(word_vectors, doc_vectors) from one shared collection."""
    return dense.fasttext_model(lexical.Collection(documents(spark, sf)), table(spark, sf, "embeddings"))


def word_vectors(spark, sf):
    return fasttext(spark, sf)[0]


def doc_vectors(spark, sf):
    return fasttext(spark, sf)[1]


def query_vectors(spark, sf, wv=None):
    q = benchmark_queries(spark, sf)
    wv = wv if wv is not None else word_vectors(spark, sf)
    return dense.text_vectors(q, wv, _dim(spark, sf), "query_id").withColumnRenamed("doc_id", "query_id")


def token_vectors(spark, sf):
    return dense.token_vectors_from_embeddings(table(spark, sf, "embeddings"))


def weights_table(spark):
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(LAYER_WEIGHTS)], "layer int, w double")


WV = rf"""{TOK},
vocab AS (SELECT term, (row_number() OVER (ORDER BY term) - 1) AS r FROM (SELECT DISTINCT unnest(toks) AS term FROM tok)),
wv AS (SELECT v.term AS word, e.embedding AS vec FROM vocab v JOIN embeddings e ON e.vec_id = v.r % (SELECT count(*) FROM embeddings)),
wvl AS (SELECT word, unnest(range(len(vec))) AS dim, unnest(vec)::DOUBLE AS val FROM wv),
dims AS (SELECT DISTINCT dim FROM wvl)"""

DV = f"""{CNT},
dvs AS (SELECT c.doc_id, w.dim, sum(c.cnt * w.val) AS s FROM cnt c JOIN wvl w ON w.word = c.term GROUP BY ALL),
dv AS (SELECT l.doc_id, d.dim, CASE WHEN l.dl > 0 THEN coalesce(s.s, 0) / l.dl ELSE 0 END AS val
   FROM lens l CROSS JOIN dims d LEFT JOIN dvs s ON s.doc_id = l.doc_id AND s.dim = d.dim)"""

QV = rf"""qtok AS (SELECT item_id AS query_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM benchmark),
qcnt AS (SELECT query_id, term, count(*) AS cnt FROM (SELECT query_id, unnest(toks) AS term FROM qtok) GROUP BY ALL),
qlens AS (SELECT query_id, len(toks) AS dl FROM qtok),
qvs AS (SELECT c.query_id, w.dim, sum(c.cnt * w.val) AS s FROM qcnt c JOIN wvl w ON w.word = c.term GROUP BY ALL),
qv AS (SELECT l.query_id, d.dim, CASE WHEN l.dl > 0 THEN coalesce(s.s, 0) / l.dl ELSE 0 END AS val
   FROM qlens l CROSS JOIN dims d LEFT JOIN qvs s ON s.query_id = l.query_id AND s.dim = d.dim),
qn AS (SELECT query_id, sqrt(sum(val * val)) AS n FROM qv GROUP BY query_id)"""


def _cosine_sql(items: str, id_col: str, k: int = 10) -> str:
    """``items`` is a CTE name with (id_col, dim, val)."""
    return f"""itn AS (SELECT {id_col}, sqrt(sum(val * val)) AS n FROM {items} GROUP BY {id_col}),
dots AS (SELECT q.query_id, i.{id_col}, sum(q.val * i.val) AS dot FROM qv q JOIN {items} i USING (dim) GROUP BY ALL),
dist AS (SELECT d.query_id, d.{id_col}, 1 - d.dot / (qn.n * itn.n) AS score FROM dots d JOIN qn USING (query_id)
   JOIN itn USING ({id_col}) WHERE qn.n * itn.n <> 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), {id_col}) AS rank FROM dist)
SELECT query_id, rank::BIGINT AS rank, {id_col}, round(score, 6) AS score FROM ranked WHERE rank <= {k}"""


def _search_out(res, id_col="doc_id"):
    return rounded(res.select("query_id", F.col("rank").cast("long").alias("rank"), id_col, "score"))


@register("fasttext_index", f"WITH {WV}, {DV} SELECT doc_id, dim::INT AS dim, round(val, 6) AS val FROM dv")
def q_fasttext_index(spark, sf):
    return rounded(dense.long_form(doc_vectors(spark, sf), ["doc_id"]))


@register("fasttext_search", f"""WITH {WV}, {DV}, {KEYS},
rv AS (SELECT dv.* FROM dv JOIN keys k ON k.doc_id = dv.doc_id AND k.doc_id = k.text_key), {QV},
{_cosine_sql('rv', 'doc_id')}""")
def q_fasttext_search(spark, sf):
    """F8 over distinct texts (S1): representatives only."""
    coll = lexical.Collection(documents(spark, sf))
    wv, dv = dense.fasttext_model(coll, table(spark, sf, "embeddings"))
    items = dv.join(coll.keys.filter("doc_id = text_key").select("doc_id"), "doc_id")
    return _search_out(dense.cosine_topk(items, query_vectors(spark, sf, wv), 10))


EMB = """el AS (SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS val FROM embeddings)"""


@register("cosine_topk", f"""WITH {WV}, {QV}, {EMB},
{_cosine_sql('el', 'vec_id')}""")
def q_cosine_topk(spark, sf):
    """Benchmark query vectors against every embeddings row."""
    items = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return _search_out(dense.cosine_topk(items, query_vectors(spark, sf), 10, "vec_id"), "vec_id")


TV = """tvl AS (SELECT (vec_id // 10)::BIGINT AS sent_id, (vec_id % 10)::INT AS pos, l.layer::INT AS layer,
     unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE * (l.layer + 1) AS val
   FROM embeddings, range(3) l(layer))"""

SW = "sw AS (SELECT layer, exp(w) / sum(exp(w)) OVER () AS sw FROM (VALUES " + ", ".join(
    f"({i}, {w})" for i, w in enumerate(LAYER_WEIGHTS)) + ") t(layer, w))"

MIX = f"""{TV}, {SW},
mix AS (SELECT sent_id, pos, dim, sum(sw.sw * val) AS val FROM tvl JOIN sw USING (layer) GROUP BY ALL)"""


@register("layer_mix", f"WITH {MIX} SELECT sent_id, pos, dim::INT AS dim, round(val, 6) AS val FROM mix")
def q_layer_mix(spark, sf):
    mixed = dense.layer_mix(token_vectors(spark, sf), weights_table(spark))
    return rounded(dense.long_form(mixed, ["sent_id", "pos"]))


@register("layer_top", f"WITH {TV} SELECT sent_id, pos, dim::INT AS dim, round(val, 6) AS val FROM tvl WHERE layer = 2")
def q_layer_top(spark, sf):
    top = dense.layer_mix(token_vectors(spark, sf), weights_table(spark), top_only=True)
    return rounded(dense.long_form(top, ["sent_id", "pos"]))


@register("layer_softmax", f"""WITH {TV}, w AS (SELECT layer, avg(val) AS w FROM tvl GROUP BY layer)
SELECT layer, round(w, 6) AS w, round(exp(w) / sum(exp(w)) OVER (), 6) AS sw FROM w""")
def q_layer_softmax(spark, sf):
    """M5 with data-derived weights: w_l = mean of all values of layer l."""
    tv = token_vectors(spark, sf)
    w = tv.select("layer", F.explode("vec").alias("v")).groupBy("layer").agg(F.avg("v").alias("w"))
    return rounded(dense.layer_softmax(w))


@register("layer_norm", f"""WITH {TV},
b AS (SELECT *, sent_id // 5 AS batch FROM tvl),
m AS (SELECT batch, layer, avg(val) AS m, var_pop(val) AS var FROM b GROUP BY ALL)
SELECT sent_id, layer, pos, dim::INT AS dim, round((val - m) / sqrt(var + 1e-12), 6) AS val FROM b JOIN m USING (batch, layer)""")
def q_layer_norm(spark, sf):
    """M7: batches of 50 token vectors (5 sentences of 10)."""
    ln = dense.layer_norm(token_vectors(spark, sf), (F.col("sent_id") / 5).cast("long"))
    return rounded(dense.long_form(ln, ["sent_id", "layer", "pos"]))


@register("mean_pool", f"""WITH {TV}
SELECT sent_id, dim::INT AS dim, round(avg(val), 6) AS val FROM tvl WHERE layer = 2 GROUP BY sent_id, dim""")
def q_mean_pool(spark, sf):
    top = dense.layer_mix(token_vectors(spark, sf), weights_table(spark), top_only=True)
    return rounded(dense.long_form(dense.mean_pool(top), ["sent_id"]))


CTX = f"""{MIX}, ctx AS (SELECT sent_id, dim, avg(val) AS val FROM mix GROUP BY sent_id, dim)"""


def contextual_vectors(spark, sf):
    return dense.mixed_pool(token_vectors(spark, sf), weights_table(spark))


@register("contextual_index", f"WITH {CTX} SELECT sent_id, dim::INT AS dim, round(val, 6) AS val FROM ctx")
def q_contextual_index(spark, sf):
    """layer mix then mean pooling per sentence."""
    return rounded(dense.long_form(contextual_vectors(spark, sf), ["sent_id"]))


@register("contextual_search", f"""WITH {WV}, {QV}, {CTX},
{_cosine_sql('ctx', 'sent_id')}""")
def q_contextual_search(spark, sf):
    """benchmark query vectors against contextual sentence vectors."""
    return _search_out(dense.cosine_topk(contextual_vectors(spark, sf), query_vectors(spark, sf), 10, "sent_id"),
                       "sent_id")


CENT = f"""{EMB},
cen AS (SELECT e.label, l.dim, avg(l.val) AS c FROM el l JOIN embeddings e USING (vec_id) GROUP BY ALL),
pair AS (SELECT l.vec_id, sum(l.val * c.c) AS dot, sqrt(sum(l.val * l.val)) AS n, sqrt(sum(c.c * c.c)) AS cn
   FROM el l JOIN embeddings e USING (vec_id) JOIN cen c ON c.label = e.label AND c.dim = l.dim GROUP BY l.vec_id)"""


def _centroid_pairs(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("vec"))
    cen = dense.vector_sum(emb, ["label"], F.col("vec"), {"n": F.count(F.lit(1))})
    cen = cen.select("label", F.transform("vec", lambda x: x / F.col("n").cast("double")).alias("cvec"))
    return emb.join(cen, "label")


@register("vec_dot", f"WITH {CENT} SELECT vec_id, round(dot, 6) AS dot FROM pair")
def q_vec_dot(spark, sf):
    """M1: each embedding with the centroid of its label."""
    return rounded(_centroid_pairs(spark, sf).select("vec_id", vx.dot("vec", "cvec").alias("dot")))


@register("vec_norm", f"WITH {CENT} SELECT vec_id, round(n, 6) AS norm FROM pair")
def q_vec_norm(spark, sf):
    return rounded(_centroid_pairs(spark, sf).select("vec_id", vx.norm("vec").alias("norm")))


@register("cosine_distance", f"""WITH {CENT}
SELECT vec_id, round(CASE WHEN n * cn <> 0 THEN 1 - dot / (n * cn) END, 6) AS dist FROM pair""")
def q_cosine_distance(spark, sf):
    """M3 (S13: NULL for a zero norm)."""
    return rounded(_centroid_pairs(spark, sf).select("vec_id", vx.cosine_distance("vec", "cvec").alias("dist")))


@register("concat_layers", """SELECT vec_id, unnest(range(2 * len(embedding)))::INT AS dim,
 round(unnest(list_concat(embedding::DOUBLE[], list_transform(embedding, lambda x: x::DOUBLE * 2))), 6) AS val FROM embeddings""")
def q_concat_layers(spark, sf):
    """Concatenate a forward layer (the embedding) and a backward layer
    (the embedding scaled by 2) into one vector."""
    emb = table(spark, sf, "embeddings")
    cat = emb.select("vec_id", vx.concat_layers(dense.scaled("embedding", F.lit(1.0)),
                                                dense.scaled("embedding", F.lit(2.0))).alias("vec"))
    return rounded(dense.long_form(cat, ["vec_id"]))


@register("blank_guard", """SELECT conv_id, turn, CASE WHEN text = '' THEN '.' ELSE text END AS encoded,
 (text = '') AS zero_vector FROM conversations""")
def q_blank_guard(spark, sf):
    """Empty text encoded as '.', flagged for a zero vector."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.blank_guard("text").alias("encoded"), (F.col("text") == "").alias("zero_vector"))


@register("token_similarity", rf"""WITH {WV},
ct AS (SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS sent_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS word
   FROM (SELECT conv_id, turn, regexp_extract_all(lower(text), '{WORD}') AS t FROM conversations)),
tv AS (SELECT ct.*, wv.vec FROM ct JOIN wv USING (word)),
q AS (SELECT sent_id AS qs, vec AS qv FROM tv ORDER BY sent_id, pos LIMIT 1),
sims AS (SELECT sent_id, pos, word, list_dot_product(vec::DOUBLE[], qv::DOUBLE[]) AS sim FROM tv, q WHERE sent_id <> qs),
last AS (SELECT sent_id, word, arg_max(sim, pos) AS sim, max(pos) AS pos FROM sims GROUP BY sent_id, word)
SELECT sent_id, word, round(sim, 6) AS sim, pos, row_number() OVER (PARTITION BY sent_id ORDER BY round(sim, 9) DESC, word) AS rank FROM last""")
def q_token_similarity(spark, sf):
    conv = table(spark, sf, "conversations")
    toks = conv.select(turn_id(conv).alias("sent_id"),
                       F.posexplode(tx.word_tokens("text")).alias("pos", "word"))
    res = dense.token_similarity(toks, word_vectors(spark, sf))
    return rounded(res.select("sent_id", "word", "sim", "pos", F.col("rank").cast("long").alias("rank")))
