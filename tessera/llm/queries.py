"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _packed(docs: DataFrame) -> DataFrame:
    from .packing import pack, tokenize
    pieces = tokenize(docs, tokenizer_path())
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_source_mixing")
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, taken
    return taken(*mix(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents
    return shard_documents(documents(spark, sf_dir))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_lines
    out = drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_components
    return near_components(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP7_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


@query("op7_streaming_exact_dedup", OP7_SQL)
def op7_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import dedup
    return dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT t, min(page_id) AS first FROM p WHERE octet_length(encode(t)) >= 100 GROUP BY t)
SELECT page_id, octet_length(encode(p.t)) AS payload_bytes, sha256(p.t) AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN g USING (t)
"""


@query("op8_warc_revisits", OP8_SQL)
def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.session import load, scratch_path
    from .warc import files_for, plan_records, read_archives, resolve, write_archives
    pages = load(spark, sf_dir, "pages")
    path = scratch_path(spark, "llm-warc")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    write_archives(plan_records(pages, files_for(total)), path)
    return resolve(read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_page").alias("refers_to"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.session import load
    from .toxicity import learn, score
    docs = documents(spark, sf_dir)
    return score(docs, learn(docs, load(spark, sf_dir, "labels")))


@query("op6_quality_ngram")
def op6_quality_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "loss")


def _license_sql() -> str:
    from .licenses import MIN_DICE, TEMPLATES, template_words
    rows = ", ".join(f"('{name}', '{' '.join(template_words(text))}')" for name, text in sorted(TEMPLATES.items()))
    gap = "chr(10) || '[ \\t\\n\\x0b\\f\\r]*' || chr(10)"
    grams = lambda w: f"list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    return rf"""
WITH t AS (SELECT license, {grams("string_split(body, ' ')")} AS g FROM (VALUES {rows}) AS v(license, body)),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, string_split(text, chr(10)) AS u, string_split_regex(text, {gap}) AS p, text FROM d),
units AS (
  SELECT doc_id, 'line' AS unit, unnest(u) AS x, generate_subscripts(u, 1) - 1 AS place FROM l
  UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph' AS unit, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS place FROM l)
            WHERE contains(x, chr(10))
  UNION ALL SELECT doc_id, 'text', text, 0 FROM l WHERE len(p) > 1),
w AS (SELECT doc_id, unit, place, string_split(trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS ws FROM units),
g AS (SELECT doc_id, unit, place, {grams("ws")} AS g FROM w),
m AS (SELECT doc_id, unit, place, license, 2.0::DOUBLE * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice
      FROM g JOIN t ON 3 * len(g.g) >= 2 * len(t.g) - 3 AND 2 * len(g.g) <= 3 * len(t.g) + 3 WHERE len(g.g) > 0)
SELECT doc_id, license, dice, unit, CAST(place AS INTEGER) AS place FROM m WHERE dice >= {MIN_DICE}
"""


@query("op10_license_scan", _license_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan
    return scan(documents(spark, sf_dir))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
p AS (SELECT *, string_split(t, chr(10)) AS parts FROM d),
c AS (SELECT *, CAST(len(parts) - CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS n,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM p),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM c),
-- lengths of the first a and the first b units: a unit has its line end unless the text ends without one
l AS (SELECT doc_id, t, n, h3, h4,
             length(array_to_string(parts[1:a], chr(10))) + CASE WHEN a > 0 AND a < len(parts) THEN 1 ELSE 0 END AS x,
             length(array_to_string(parts[1:b], chr(10))) + CASE WHEN b > 0 AND b < len(parts) THEN 1 ELSE 0 END AS y FROM k),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                     WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
             substring(t, 1, x) AS pre, substring(t, x + 1, y - x) AS mid, substring(t, y + 1) AS suf FROM l)
SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN x END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN y - x END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import fill_in_middle, restore
    return fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(), 256).alias("restored_sha256"))


@query("op12_document_fingerprints")
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ctph import edits
    return edits(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


def _kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    dot = "list_inner_product({0}.e, {1}.e)".format
    near = lambda t: (f"a{t} AS (SELECT v.rid, arg_min(c.k, ({dot('v', 'v')} - 2 * {dot('v', 'c')} + {dot('c', 'c')}) * {k} + c.k) AS k, "  # noqa: E731
                      f"min({dot('v', 'v')} - 2 * {dot('v', 'c')} + {dot('c', 'c')}) AS d FROM v, c{t} c GROUP BY v.rid)")
    steps = []
    for t in range(rounds):
        steps.append(near(t))
        steps.append(f"""m{t} AS (SELECT k, i, floor(sum(x) / count(*)) AS x
       FROM (SELECT a.k, unnest(v.e) AS x, generate_subscripts(v.e, 1) AS i FROM a{t} a JOIN v USING (rid)) GROUP BY k, i),
c{t + 1} AS (SELECT k, list(x ORDER BY i) AS e FROM m{t} GROUP BY k
       UNION ALL SELECT k, e FROM c{t} WHERE k NOT IN (SELECT k FROM a{t}))""")
    steps.append(near(rounds))
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS k, e FROM v QUALIFY k < {k}),
{", ".join(steps)},
s AS (SELECT k, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY k),
h AS (SELECT k, sha256(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256 FROM c{rounds})
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, s.cluster_inertia,
       CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN s USING (k) JOIN h USING (k)
"""


@query("op13_centroid_clustering", _kmeans_sql())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.session import load
    from .zonemaps import kmeans, with_inertia
    return with_inertia(kmeans(load(spark, sf_dir, "embeddings"))).drop("compared")
