"""Registered queries over documents, events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import text as X
from ..operators import assemble as A
from ..operators import rollup as R
from ..operators import segment as S
from ..session import load
from . import pipeline as P
from .registry import register
from .sql_code import CODE_CTES, FUNCTION_RAW, dedent_sql, windows_sql

DOC_PATH = "source || '/' || CAST(doc_id AS VARCHAR) || '.' || lang"
STRIP_SQL = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def _docs(spark, sf):
    return load(spark, sf, "documents")


@register("file_metadata", f"""
SELECT CAST(doc_id AS VARCHAR) || '.' || lang AS file_name, {DOC_PATH} AS file_path, lang AS file_extension,
       {DOC_PATH} AS repo_relative_path, CAST(octet_length(encode(text)) AS BIGINT) AS file_size, sha256(text) AS sha256
FROM documents
""")
def q_file_metadata(spark, sf):
    d = P.doc_files(spark, sf)
    b = F.col("text").cast("binary")
    return d.select(M.file_name("file_path").alias("file_name"), "file_path",
                    M.extension("file_path").alias("file_extension"), F.col("file_path").alias("repo_relative_path"),
                    F.length(b).cast("bigint").alias("file_size"), M.content_sha256(b).alias("sha256"))


@register("sha1_short", """
SELECT doc_id, substring(sha1(substring(coalesce(text, ''), 1, 10000)), 1, 12) AS sha1 FROM documents
""")
def q_sha1_short(spark, sf):
    return _docs(spark, sf).select("doc_id", M.sha1_short("text").alias("sha1"))


_HUMAN_SQL = """CASE WHEN {b} < 1024 THEN printf('%.1f', {b}) || 'B'
     WHEN {b} < 1024.0^2 THEN printf('%.1f', {b} / 1024.0) || 'KB'
     WHEN {b} < 1024.0^3 THEN printf('%.1f', {b} / 1024.0^2) || 'MB'
     WHEN {b} < 1024.0^4 THEN printf('%.1f', {b} / 1024.0^3) || 'GB'
     WHEN {b} < 1024.0^5 THEN printf('%.1f', {b} / 1024.0^4) || 'TB'
     ELSE printf('%.1f', {b} / 1024.0^5) || 'PB' END"""


@register("index_stats", f"""
SELECT files, total_bytes, failures, {_HUMAN_SQL.format(b='CAST(total_bytes AS DOUBLE)')} AS total_human
FROM (SELECT count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS total_bytes,
             CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM documents)
""")
def q_index_stats(spark, sf):
    d = _docs(spark, sf).select(F.length(F.col("text").cast("binary")).alias("file_size"),
                                F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return R.index_stats(d)


@register("read_source_text", """
SELECT doc_id, text AS text, CAST(length(text) AS BIGINT) AS n_chars FROM documents
""")
def q_read_source_text(spark, sf):
    from ..sources.io import decode_text
    d = _docs(spark, sf).select("doc_id", F.col("text").cast("binary").alias("content"))
    t = decode_text(F.col("content"))
    return d.select("doc_id", t.alias("text"), F.length(t).cast("bigint").alias("n_chars"))


CHUNK_SIZE, CHUNK_STRIDE = 8, 6


@register("chunk_lines", f"""
WITH u AS (SELECT doc_id, string_split({STRIP_SQL.format('text')}, chr(10)) AS ls FROM documents
           WHERE length({STRIP_SQL.format('text')}) > 0),
s AS (SELECT doc_id, ls, len(ls) AS n, unnest(generate_series(1, greatest(len(ls) - {CHUNK_SIZE} + {CHUNK_STRIDE}, 1), {CHUNK_STRIDE})) AS st FROM u)
SELECT doc_id, CAST(st AS BIGINT) AS chunk_start_line, CAST(least(st + {CHUNK_SIZE} - 1, n) AS BIGINT) AS chunk_end_line,
       array_to_string(ls[st:least(st + {CHUNK_SIZE} - 1, n)], chr(10)) AS chunk_text,
       substring(sha1(substring(array_to_string(ls[st:least(st + {CHUNK_SIZE} - 1, n)], chr(10)), 1, 10000)), 1, 12) AS sha1
FROM s WHERE st = 1 OR st <= n - {CHUNK_SIZE} + {CHUNK_STRIDE}
""")
def q_chunk_lines(spark, sf):
    d = _docs(spark, sf).withColumn("start_line", F.lit(1))
    c = S.chunk_lines(d, CHUNK_SIZE, CHUNK_STRIDE, text="text")
    return c.select("doc_id", F.col("chunk_start_line").cast("bigint").alias("chunk_start_line"),
                    F.col("chunk_end_line").cast("bigint").alias("chunk_end_line"), "chunk_text",
                    M.sha1_short("chunk_text").alias("sha1"))


TOK_SIZE, TOK_STRIDE = 64, 48


@register("chunk_tokens", f"""
WITH u AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\\S+') AS tk, regexp_extract_all(coalesce(text, ''), '(\\s*)\\S+', 1) AS gp FROM documents),
s AS (SELECT doc_id, tk, gp, len(tk) AS n, unnest(generate_series(0, greatest(len(tk) - {TOK_SIZE} + {TOK_STRIDE} - 1, 0), {TOK_STRIDE})) AS st
      FROM u WHERE len(tk) > 0)
SELECT doc_id, CAST(st AS INT) AS token_start, CAST(least(st + {TOK_SIZE}, n) AS INT) AS token_end,
       regexp_replace(array_to_string(list_transform(range(st + 1, least(st + {TOK_SIZE}, n) + 1), lambda i: gp[i] || tk[i]), ''), '^\\s+', '') AS chunk_text
FROM s WHERE st = 0 OR st + {TOK_SIZE} - {TOK_STRIDE} < n
""")
def q_chunk_tokens(spark, sf):
    c = S.chunk_tokens(_docs(spark, sf), TOK_SIZE, TOK_STRIDE, text="text")
    return c.select("doc_id", "token_start", "token_end", "chunk_text")


@register("dedupe_exact", """
SELECT sha256(coalesce(text, '')) AS sha256, min(doc_id) AS doc_id FROM documents
WHERE length(coalesce(text, '')) >= 20 GROUP BY 1
""")
def q_dedupe_exact(spark, sf):
    return R.dedupe_exact(_docs(spark, sf), order="doc_id", text="text", min_chars=20, min_lines=1)


@register("shuffle_split", """
WITH h AS (SELECT doc_id, sha1(CAST(doc_id AS VARCHAR) || '|42') AS hh FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY hh, doc_id) AS rk, count(*) OVER () AS n FROM h)
SELECT doc_id, CASE WHEN rk <= greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM r
""")
def q_shuffle_split(spark, sf):
    d = _docs(spark, sf).select("doc_id")
    return A.shuffle_split(d, "doc_id", val_frac=0.1, seed="42").select("doc_id", "split")


@register("holdout_by_group", """
SELECT doc_id, source, CASE WHEN (CAST(('0x' || substring(sha1(source || '|7'), 1, 8)) AS BIGINT) % 100) < 20
                  THEN 'holdout' ELSE 'train' END AS split FROM documents
""")
def q_holdout(spark, sf):
    d = _docs(spark, sf).select("doc_id", "source")
    return A.holdout_by_group(d, "source", pct=20, seed="7")


@register("review_sample", """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha1(CAST(doc_id AS VARCHAR) || '|1'), doc_id) AS rk
                          FROM documents) WHERE rk <= 50
""")
def q_review_sample(spark, sf):
    return A.review_sample(_docs(spark, sf).select("doc_id", "lang"), "doc_id", "lang", 50, seed="1")


@register("assist_limit", """
SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100
""")
def q_assist_limit(spark, sf):
    d = _docs(spark, sf)
    return A.assist_limit(d, [F.col("n_chars").desc(), F.col("doc_id")], 100).select("doc_id")


# --------------------------------------------------------------------------
# model I/O over events: a deterministic mix of clean JSON, JSON with junk
# around it and malformed braces, derived from each event row
# --------------------------------------------------------------------------
_RAW_SQL = """CASE event_id % 4
  WHEN 0 THEN '{"summary": "' || event_type || '"}'
  WHEN 1 THEN '{"summary": "' || event_type || '", "confidence": 0.' || lpad(CAST(abs(CAST(floor(value) AS BIGINT)) % 1000 AS VARCHAR), 3, '0')
              || ', "intent_tags": ["' || event_type || '", "x"]}'
  WHEN 2 THEN 'Sure! ' || props || ' hope it helps'
  ELSE ' {plain ' || event_type || ' text} ' END"""


def _raw_model_text():
    et = F.col("event_type")
    return (F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"summary": "'), et, F.lit('"}')))
             .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"summary": "'), et, F.lit('", "confidence": 0.'),
                                                       F.lpad((F.abs(F.floor("value").cast("bigint")) % 1000).cast("string"), 3, "0"),
                                                       F.lit(', "intent_tags": ["'), et, F.lit('", "x"]}')))
             .when(F.col("event_id") % 4 == 2, F.concat(F.lit("Sure! "), F.col("props"), F.lit(" hope it helps")))
             .otherwise(F.concat(F.lit(" {plain "), et, F.lit(" text} "))))


@register("parse_model_json", f"""
WITH t AS (SELECT event_id, regexp_replace({_RAW_SQL}, '^\\s+|\\s+$', '', 'g') AS raw FROM events),
p AS (SELECT event_id, CASE WHEN json_valid(raw) AND raw LIKE '{{%}}' THEN raw
                            WHEN regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0) <> '' AND json_valid(regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0))
                              THEN regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0) END AS js FROM t)
SELECT event_id, js IS NOT NULL AS parsed, json_extract_string(js, '$.summary') AS summary,
       CAST(json_extract_string(js, '$.k') AS BIGINT) AS k FROM p
""")
def q_parse_model_json(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType(X.MODEL_SCHEMA.fields + [T.StructField("k", T.LongType())])
    e = load(spark, sf, "events")
    p = X.parse_model_json(_raw_model_text(), schema)
    return e.select("event_id", p.isNotNull().alias("parsed"), p["summary"].alias("summary"), p["k"].alias("k"))


@register("model_defaults", f"""
WITH t AS (SELECT event_id, {_RAW_SQL} AS raw0 FROM events),
t2 AS (SELECT event_id, raw0, regexp_replace(raw0, '^\\s+|\\s+$', '', 'g') AS raw FROM t),
p AS (SELECT event_id, raw0, CASE WHEN json_valid(raw) AND raw LIKE '{{%}}' THEN raw
                            WHEN regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0) <> '' AND json_valid(regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0))
                              THEN regexp_extract(raw, '\\{{[^{{}}]*\\}}', 0) END AS js FROM t2)
SELECT event_id,
       CASE WHEN js IS NULL THEN regexp_replace(raw0, '^\\s+|\\s+$', '', 'g') ELSE coalesce(json_extract_string(js, '$.summary'), '') END AS summary,
       CASE WHEN js IS NULL THEN '' ELSE coalesce(array_to_string(CAST(json_extract(js, '$.intent_tags') AS VARCHAR[]), ','), '') END AS intent_tags,
       CASE WHEN js IS NULL THEN '' ELSE coalesce(json_extract_string(js, '$.risk_notes'), '') END AS risk_notes,
       CASE WHEN js IS NULL THEN '' ELSE coalesce(json_extract_string(js, '$.change_recipe'), '') END AS change_recipe,
       CASE WHEN js IS NULL THEN 0.6 ELSE coalesce(CAST(json_extract_string(js, '$.confidence') AS DOUBLE), 0.6) END AS confidence
FROM p
""")
def q_model_defaults(spark, sf):
    e = load(spark, sf, "events")
    raw = _raw_model_text()
    d = X.model_defaults(X.parse_model_json(raw), raw)
    return e.select("event_id", d["summary"].alias("summary"), P.csv(d["intent_tags"]).alias("intent_tags"),
                    d["risk_notes"].alias("risk_notes"), d["change_recipe"].alias("change_recipe"),
                    d["confidence"].alias("confidence"))


@register("validate_enrichment", """
SELECT event_id, valid, reason FROM (
  SELECT event_id,
         CASE WHEN event_type = '' THEN 'empty summary'
              WHEN value / 500.0 < 0 OR value / 500.0 > 1 THEN 'confidence out of range' END AS reason,
         (CASE WHEN event_type = '' THEN 'empty summary'
              WHEN value / 500.0 < 0 OR value / 500.0 > 1 THEN 'confidence out of range' END) IS NULL AS valid
  FROM events)
""")
def q_validate_enrichment(spark, sf):
    e = load(spark, sf, "events")
    fields = F.struct(F.col("event_type").alias("summary"), (F.col("value") / 500.0).alias("confidence"))
    v = X.validate_enrichment(fields)
    return e.select("event_id", v["valid"].alias("valid"), v["reason"].alias("reason"))


@register("strip_completion", """
WITH p AS (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS reply FROM conversations u
           JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
           WHERE u.role = 'user' AND a.role = 'assistant'),
o AS (SELECT conv_id, turn, regexp_replace(prompt, '^\\s+|\\s+$', '', 'g') AS pr,
             prompt || chr(10) || reply || chr(10) || '### end' AS out FROM p),
s AS (SELECT conv_id, turn, CASE WHEN starts_with(out, pr) THEN regexp_replace(substring(out, length(pr) + 1), '^\\s+|\\s+$', '', 'g')
                                ELSE regexp_replace(out, '^\\s+|\\s+$', '', 'g') END AS o1 FROM o)
SELECT conv_id, turn, CASE WHEN contains(o1, '###') THEN regexp_replace(split_part(o1, '###', 1), '^\\s+|\\s+$', '', 'g')
                           ELSE o1 END AS completion FROM s
""")
def q_strip_completion(spark, sf):
    c = load(spark, sf, "conversations")
    pairs = A.seq2seq_turn_pairs(c)
    out = F.concat(F.col("input"), F.lit("\n"), F.col("target"), F.lit("\n### end"))
    return pairs.select("conv_id", "turn", X.strip_completion(out, F.col("input"), "###").alias("completion"))


@register("seq2seq_turn_pairs", """
SELECT u.conv_id, u.turn, u.text AS input, a.text AS target FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
def q_seq2seq_turn_pairs(spark, sf):
    return A.seq2seq_turn_pairs(load(spark, sf, "conversations"))


@register("seq2seq_from_versions", f"""
WITH old AS (SELECT {DOC_PATH} AS file_path, coalesce(text, '') AS t FROM documents WHERE lang <> 'de'),
new AS (SELECT {DOC_PATH} AS file_path, CASE WHEN source = 'src1' THEN coalesce(text, '') || '!' ELSE coalesce(text, '') END AS t
        FROM documents WHERE lang <> 'fr')
SELECT o.file_path, o.t AS before, n.t AS after FROM old o JOIN new n ON n.file_path = o.file_path WHERE o.t <> n.t
""")
def q_seq2seq_from_versions(spark, sf):
    """Before/after pairs of the files that changed between two snapshots."""
    d = P.doc_files(spark, sf).withColumn("text", F.coalesce("text", F.lit("")))
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("sha256")
    old = d.where(F.col("lang") != "de").select("file_path", "text", sha)
    edited = d.withColumn("text", F.when(F.col("source") == "src1", F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    new = edited.where(F.col("lang") != "fr").select("file_path", "text", sha)
    return A.seq2seq_from_versions(old, new, ["file_path"], sha="sha256").select("file_path", "before", "after")


@register("assist_payload", "WITH " + CODE_CTES + """
SELECT id, 'Summarize the purpose of this code:' || chr(10) || chr(10) || '### Code:' || chr(10) || body
           || chr(10) || chr(10) || '### Output:' AS input,
       'Summarize this code:' || chr(10) || body || chr(10) AS prompt
FROM units2
""")
def q_assist_payload(spark, sf):
    u = P.c_units(spark, sf)
    return u.select("id", X.assist_payload(F.col("body")).alias("input"), X.assist_prompt(F.col("body")).alias("prompt"))


@register("prompt_function", "WITH " + CODE_CTES + "," + windows_sql("wd", "units2", "id, signature", "body") + ","
          + dedent_sql("pr", "wd", "id, win", FUNCTION_RAW) + """
SELECT id, CAST(win AS INT) AS win, prompt FROM pr
""")
def q_prompt_function(spark, sf):
    """Function prompts (template + dedent), one for each token window of the body."""
    u = P.c_units(spark, sf)
    w = u.select("id", "signature", (M.suffix("file_path") == ".asm").alias("asm"), F.posexplode(X.token_windows(F.col("body"))).alias("win", "piece"))
    return w.select("id", "win", X.prompt_function(F.col("signature"), F.col("piece"), F.col("asm")).alias("prompt"))


_IDS = "list_transform(regexp_extract_all(coalesce({0}, ''), '\\S+'), lambda x: CAST(CAST(('0x' || substring(sha1(x), 1, 7)) AS BIGINT) % 32000 AS INT))"


def _pad_sql(ids, width, pad):
    return f"array_to_string(list_concat({ids}, list_transform(range(greatest(0, {width} - len({ids}))), lambda x: {pad})), ',')"


@register("tokenize_pad", f"""
WITH t AS (SELECT doc_id, {_IDS.format('text')} AS ids FROM documents),
w AS (SELECT doc_id, ids, unnest(range(greatest(1, CAST(ceil(len(ids) / 32.0) AS BIGINT)))) AS win FROM t),
c AS (SELECT doc_id, win, len(ids) AS n, ids[win * 32 + 1:(win + 1) * 32] AS cut FROM w)
SELECT doc_id, CAST(win AS INT) AS win, CAST(least(win * 32, n) AS INT) AS start, CAST(least(win * 32 + 32, n) AS INT) AS "end",
       {_pad_sql('cut', 32, 0)} AS input_ids, {_pad_sql('list_transform(cut, lambda y: 1)', 32, 0)} AS attention_mask,
       {_pad_sql('cut', 32, -100)} AS labels
FROM c
""")
def q_tokenize_pad(spark, sf):
    w = A.tokenize_windows(A.tokenize_ids(F.col("text")), 32)
    d = _docs(spark, sf).select("doc_id", F.explode(w).alias("w")).select("doc_id", "w.*")
    return d.select("doc_id", F.col("window").alias("win"), "start", "end", *[P.csv(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])


@register("tokenize_pad_target", f"""
WITH t AS (SELECT u.conv_id, u.turn, {_IDS.format('u.text')} AS i, {_IDS.format('a.text')} AS l FROM conversations u
           JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'),
w AS (SELECT *, unnest(range(greatest(1, CAST(ceil(greatest(len(i), len(l)) / 16.0) AS BIGINT)))) AS win FROM t),
c AS (SELECT conv_id, turn, win, i[win * 16 + 1:(win + 1) * 16] AS ci, l[win * 16 + 1:(win + 1) * 16] AS cl FROM w)
SELECT conv_id, turn, CAST(win AS INT) AS win, {_pad_sql('ci', 16, 0)} AS input_ids, {_pad_sql('cl', 16, -100)} AS labels FROM c
""")
def q_tokenize_pad_target(spark, sf):
    """Labels from the target text (encoder-decoder training)."""
    pairs = A.seq2seq_turn_pairs(load(spark, sf, "conversations"))
    w = A.tokenize_windows(A.tokenize_ids(F.col("input")), 16, A.tokenize_ids(F.col("target")))
    d = pairs.select("conv_id", "turn", F.explode(w).alias("w")).select("conv_id", "turn", "w.*")
    return d.select("conv_id", "turn", F.col("window").alias("win"), *[P.csv(c).alias(c) for c in ("input_ids", "labels")])
