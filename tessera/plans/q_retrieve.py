"""Registered retrieval and evaluation queries (embeddings, labels, conversations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble as A
from ..operators import evaluate as EV
from ..operators import graph as G
from ..operators import retrieve as RT
from ..operators.rollup import unit_flags
from ..session import load
from . import pipeline as P
from .q_graph import GRAPH_CTES
from .registry import register
from .sql_code import CODE_CTES, FLAGGED

CENT_SQL = """
cent AS (SELECT label AS qid, list(v ORDER BY dim) AS qv
         FROM (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS v
               FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
               GROUP BY label, dim)
         GROUP BY label),
dist AS (SELECT c.qid, e.vec_id AS id, e.label,
                list_sum(list_transform(range(1, len(e.embedding) + 1),
                         lambda i: (CAST(e.embedding[i] AS DOUBLE) - c.qv[i]) ^ 2)) AS d
         FROM cent c CROSS JOIN embeddings e)
"""


def _centroids(spark, sf):
    e = load(spark, sf, "embeddings")
    return RT.pooled_vectors(RT.mean_pool(e, "label"), "label").withColumnRenamed("label", "qid")


def _knn(spark, sf, k, where=None):
    e = load(spark, sf, "embeddings")
    if where is not None:
        e = e.where(where)
    return RT.knn_l2(e, _centroids(spark, sf), k, id_col="vec_id")


@register("mean_pool", """
SELECT label, CAST(dim - 1 AS BIGINT) AS dim, round(avg(CAST(x AS DOUBLE)), 6) AS value
FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
GROUP BY label, dim
""")
def q_mean_pool(spark, sf):
    m = RT.mean_pool(load(spark, sf, "embeddings"), "label")
    return m.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


@register("knn_l2", "WITH " + CENT_SQL + """
SELECT qid, id, rk AS rank, round(d, 6) AS distance FROM (
  SELECT qid, id, d, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rk FROM dist) WHERE rk <= 3
""")
def q_knn_l2(spark, sf):
    h = _knn(spark, sf, 3)
    return h.select("qid", "id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))


@register("knn_id_lookup", "WITH " + CENT_SQL + """
SELECT qid, rank, 'vec:' || CAST(id AS VARCHAR) AS file_id FROM (
  SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rank FROM dist) WHERE rank <= 3
""")
def q_knn_id_lookup(spark, sf):
    """Hit positions carried as ids through the search (no lookup join)."""
    h = _knn(spark, sf, 3)
    return h.select("qid", F.col("rank").cast("bigint").alias("rank"),
                    F.concat(F.lit("vec:"), F.col("id").cast("string")).alias("file_id"))


@register("knn_filtered", "WITH " + CENT_SQL + """
SELECT qid, id, rk AS rank, round(d, 6) AS distance FROM (
  SELECT qid, id, d, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rk FROM dist WHERE label <= 4) WHERE rk <= 5
""")
def q_knn_filtered(spark, sf):
    e = load(spark, sf, "embeddings")
    h = RT.knn_filtered(e, _centroids(spark, sf), 5, F.col("label") <= 4, id_col="vec_id")
    return h.select("qid", "id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))


_PREC_SQL = CENT_SQL + """,
hits AS (SELECT qid, id, label, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rk FROM dist),
prec AS (SELECT avg(p) AS precision_at_10, count(*) AS n_queries FROM (
           SELECT qid, sum(CASE WHEN label = qid THEN 1 ELSE 0 END) / 10.0 AS p FROM hits WHERE rk <= 10 GROUP BY qid))
"""


def _precision(spark, sf):
    h = _knn(spark, sf, 10)
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return EV.precision_at_k(h.join(e, "id").withColumn("relevant", F.col("label") == F.col("qid")), "relevant", 10)


@register("precision_at_k", "WITH " + _PREC_SQL + """
SELECT round(precision_at_10, 6) AS precision_at_10, n_queries FROM prec
""")
def q_precision_at_k(spark, sf):
    p = _precision(spark, sf)
    return p.select(F.round("precision_at_10", 6).alias("precision_at_10"), "n_queries")


@register("eval_exact", "WITH " + CENT_SQL + """,
pred AS (SELECT id, arg_min(qid, struct_pack(d := d, q := qid)) AS prediction, any_value(label) AS answer FROM dist GROUP BY id),
pc AS (SELECT CAST(prediction AS VARCHAR) AS p, CAST(answer AS VARCHAR) AS g FROM pred),
cls AS (SELECT c, sum(tp) AS tp, sum(np) AS n_pred, sum(ng) AS support FROM (
          SELECT g AS c, CASE WHEN p = g THEN 1 ELSE 0 END AS tp, 0 AS np, 1 AS ng FROM pc
          UNION ALL SELECT p, 0, 1, 0 FROM pc) GROUP BY c),
m AS (SELECT support, tp, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS pr,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rc FROM cls)
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
       round(sum(rc * support) / sum(support), 6) AS recall,
       round(sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END * support) / sum(support), 6) AS f1,
       CAST(sum(support) AS BIGINT) AS n
FROM m
""")
def q_eval_exact(spark, sf):
    e = load(spark, sf, "embeddings")
    a = RT.assign_nearest(e, _centroids(spark, sf), id_col="vec_id")
    pairs = a.join(e.select(F.col("vec_id").alias("id"), "label"), "id").select(
        F.col("center").alias("prediction"), F.col("label").alias("answer"))
    r = EV.eval_exact(pairs)
    return r.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
                    F.col("n").cast("bigint").alias("n"))


@register("compose_prompt", "WITH " + CENT_SQL + """,
hits AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rk FROM dist)
SELECT qid, 'Question: Which vectors look like label ' || CAST(qid AS VARCHAR) || '?' || chr(10) || 'Context:' || chr(10)
            || string_agg('[' || CAST(rk AS VARCHAR) || '] vec ' || CAST(id AS VARCHAR), chr(10) ORDER BY rk) AS prompt
FROM hits WHERE rk <= 3 GROUP BY qid
""")
def q_compose_prompt(spark, sf):
    h = _knn(spark, sf, 3).withColumn("snippet", F.concat(F.lit("vec "), F.col("id").cast("string")))
    qs = _centroids(spark, sf).select("qid", F.concat(F.lit("Which vectors look like label "), F.col("qid").cast("string"),
                                                      F.lit("?")).alias("question"))
    return RT.compose_prompt(qs, h, "snippet", 3)


@register("embedding_upsert", """
SELECT vec_id, CASE WHEN label = 3 THEN 2 ELSE 1 END AS version, label,
       round(CASE WHEN label = 3 THEN CAST(embedding[len(embedding)] AS DOUBLE) ELSE CAST(embedding[1] AS DOUBLE) END, 6) AS first_value
FROM embeddings
""")
def q_embedding_upsert(spark, sf):
    e = load(spark, sf, "embeddings")
    old = e.select("vec_id", F.lit(1).alias("version"), "label", "embedding")
    new = e.where(F.col("label") == 3).select("vec_id", F.lit(2).alias("version"), "label",
                                               F.reverse("embedding").alias("embedding"))
    u = RT.embedding_upsert(old, new, "vec_id", "version")
    return u.select("vec_id", "version", "label", F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"))


_BLEU_SQL = """
WITH pairs AS (SELECT CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR) AS pair_id, a.text AS cand, u.text AS ref
               FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
               WHERE u.role = 'user' AND a.role = 'assistant'),
toks AS (SELECT pair_id, list_filter(string_split_regex(trim(cand), '\\s+'), lambda x: x <> '') AS c,
                list_filter(string_split_regex(trim(ref), '\\s+'), lambda x: x <> '') AS r FROM pairs),
ns AS (SELECT unnest(range(1, 5)) AS n),
cg AS (SELECT pair_id, n, gram, count(*) AS cnt FROM (
         SELECT t.pair_id, ns.n, unnest(list_transform(range(1, greatest(len(t.c) - ns.n + 1, 0) + 1),
                                         lambda i: array_to_string(t.c[i:i + ns.n - 1], ' '))) AS gram
         FROM toks t CROSS JOIN ns) GROUP BY pair_id, n, gram),
rg AS (SELECT pair_id, n, gram, count(*) AS cnt FROM (
         SELECT t.pair_id, ns.n, unnest(list_transform(range(1, greatest(len(t.r) - ns.n + 1, 0) + 1),
                                         lambda i: array_to_string(t.r[i:i + ns.n - 1], ' '))) AS gram
         FROM toks t CROSS JOIN ns) GROUP BY pair_id, n, gram),
clipped AS (SELECT c.n, sum(least(c.cnt, coalesce(r.cnt, 0))) AS m, sum(c.cnt) AS total
            FROM cg c LEFT JOIN rg r ON r.pair_id = c.pair_id AND r.n = c.n AND r.gram = c.gram GROUP BY c.n),
p AS (SELECT coalesce(max(CASE WHEN n = 1 THEN m / total END), 0) AS p1, coalesce(max(CASE WHEN n = 2 THEN m / total END), 0) AS p2,
             coalesce(max(CASE WHEN n = 3 THEN m / total END), 0) AS p3, coalesce(max(CASE WHEN n = 4 THEN m / total END), 0) AS p4
      FROM clipped),
lens AS (SELECT sum(len(c)) AS cl, sum(len(r)) AS rl FROM toks),
bp AS (SELECT CASE WHEN cl >= rl THEN 1.0 ELSE exp(1 - rl / greatest(cl, 1)) END AS bp FROM lens)
SELECT round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, round(p4, 6) AS p4, round(bp, 6) AS bp,
       round(CASE WHEN p1 <= 0 OR p2 <= 0 OR p3 <= 0 OR p4 <= 0 THEN 0.0
                  ELSE bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) END, 6) AS bleu
FROM p, bp
"""


@register("corpus_bleu", _BLEU_SQL)
def q_corpus_bleu(spark, sf):
    pairs = A.seq2seq_turn_pairs(load(spark, sf, "conversations")).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pair_id"),
        F.col("target").alias("candidate"), F.col("input").alias("reference"))
    b = EV.corpus_bleu(pairs)
    return b.select(*[F.round(c, 6).alias(c) for c in ("p1", "p2", "p3", "p4", "bp", "bleu")])


@register("review_gate", "WITH " + _PREC_SQL + """,
s AS (SELECT quality FROM (SELECT quality, row_number() OVER (PARTITION BY 1 ORDER BY sha1(CAST(doc_id AS VARCHAR) || '|review'), doc_id) AS rk
                           FROM labels) WHERE rk <= 50)
SELECT round((SELECT avg(CAST(quality AS DOUBLE)) FROM s), 6) AS yes_share, (SELECT count(*) FROM s) AS n_reviewed,
       round(precision_at_10, 6) AS precision,
       ((SELECT avg(CAST(quality AS DOUBLE)) FROM s) >= 0.75 AND precision_at_10 >= 0.7) AS passed
FROM prec
""")
def q_review_gate(spark, sf):
    lab = load(spark, sf, "labels").withColumn("stratum", F.lit(1))
    sample = A.review_sample(lab, "doc_id", "stratum", 50, seed="review")
    g = EV.review_gate(sample, "quality", _precision(spark, sf), "precision_at_10")
    return g.select(F.round("yes_share", 6).alias("yes_share"), "n_reviewed", F.round("precision", 6).alias("precision"),
                    "passed")


# --------------------------------------------------------------------------
# graph-boosted retrieval over functions: a function's vector is its
# metric profile (loc, cyclomatic, call sites, in/out degree)
# --------------------------------------------------------------------------
_BOOST_SQL = "WITH " + CODE_CTES + "," + GRAPH_CTES + "," + FLAGGED + """,
feat AS (SELECT f.id, [CAST(f.loc AS DOUBLE), CAST(f.cyclomatic AS DOUBLE),
                       CAST(len(regexp_extract_all(f.body, '\\b([A-Za-z_]\\w*)\\s*\\(', 1)) AS DOUBLE),
                       CAST(d.in_degree AS DOUBLE), CAST(d.out_degree AS DOUBLE)] AS v
         FROM flagged f JOIN deg d ON d.id = f.id),
top AS (SELECT id, out_degree FROM deg WHERE in_degree = 0 ORDER BY out_degree DESC, id LIMIT 10),
qv AS (SELECT t.id AS qid, f.v AS q FROM top t JOIN feat f ON f.id = t.id),
dd AS (SELECT qv.qid, f.id, list_sum(list_transform(range(1, 6), lambda i: (f.v[i] - qv.q[i]) ^ 2)) AS d
       FROM qv CROSS JOIN feat f),
hits AS (SELECT qid, id, d FROM dd),
ue AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
h1 AS (SELECT DISTINCT t.id AS qid, e.dst AS id FROM top t JOIN ue e ON e.src = t.id WHERE e.dst <> t.id),
h2 AS (SELECT DISTINCT h.qid, e.dst AS id FROM h1 h JOIN ue e ON e.src = h.id WHERE e.dst <> h.qid),
near AS (SELECT qid, id FROM h1 UNION SELECT qid, id FROM h2)
SELECT qid, id, boost_rank, near FROM (
  SELECT h.qid, h.id, (n.id IS NOT NULL) AS near,
         row_number() OVER (PARTITION BY h.qid ORDER BY (n.id IS NOT NULL) DESC, h.d, h.id) AS boost_rank
  FROM hits h LEFT JOIN near n ON n.qid = h.qid AND n.id = h.id)
WHERE boost_rank <= 5
"""


@register("retrieve_graph_boost", _BOOST_SQL)
def q_retrieve_graph_boost(spark, sf):
    u, up, down = P.name_graph(spark, sf)
    deg = P.degrees(spark, sf)
    fl = unit_flags(u)
    from ..functions import metrics as M
    feat = fl.join(deg, "id").select("id", F.array(F.col("loc").cast("double"), F.col("cyclomatic").cast("double"),
                                                    F.size(M.call_sites("body")).cast("double"),
                                                    F.col("in_degree").cast("double"),
                                                    F.col("out_degree").cast("double")).alias("embedding"))
    top = G.top_entry_points(deg, 10).select("id")
    queries = feat.join(top, "id").withColumnRenamed("id", "qid")
    near = G.function_neighbors(up, down, top, 2).select(F.col("seed").alias("qid"), "id")
    b = RT.retrieve_graph_boost(feat, queries, near, 5)
    return b.select("qid", "id", F.col("boost_rank").cast("bigint").alias("boost_rank"), "near")
