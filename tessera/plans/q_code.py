"""Registered queries over the code corpus: segmentation, metrics, rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import rollup as R
from ..operators import segment as S
from . import pipeline as P
from .registry import register
from .sql_code import CODE_CTES, FILES_CTES, FLAGGED, notes_expr, q, tags_expr

W = "WITH " + CODE_CTES
WF = W + "," + FLAGGED
WFILES = W + "," + FILES_CTES

# --------------------------------------------------------------------------
# flagship: which files are the largest and riskiest?
# --------------------------------------------------------------------------


def file_rollup_df(spark, sf):
    roll = R.file_rollup(P.flagged(spark, sf))
    return roll.select("id", "file_path", "num_functions", "loc", "cyclomatic",
                       P.csv("intent_tags").alias("intent_tags"), "risk_notes")


register("file_rollup", WF + f"""
SELECT 'file:' || file_path AS id, file_path, count(*) AS num_functions,
       CAST(sum(loc) AS BIGINT) AS loc, CAST(sum(cyclomatic) AS BIGINT) AS cyclomatic,
       array_to_string({tags_expr('bool_or({})')}, ',') AS intent_tags,
       {notes_expr('bool_or({})')} AS risk_notes
FROM flagged GROUP BY file_path
""")(file_rollup_df)


@register("segment_c_units", W + """
SELECT id, file_path, name, signature, body, start_line, end_line FROM units2
""")
def q_segment_c(spark, sf):
    return P.c_units(spark, sf).select("id", "file_path", "name", "signature", "body",
                                       F.col("start_line").cast("bigint").alias("start_line"),
                                       F.col("end_line").cast("bigint").alias("end_line"))


@register("segment_asm_units", W + "," + FILES_CTES + """
, a AS (SELECT s, p, 'asm/' || 'f_' || s || '_' || (p // 1000) || '.asm' AS file_path, 'fn_' || p AS name, a_text AS body, 3 + ncalls AS nl
        FROM fntext WHERE s % 4 = 0)
SELECT file_path, name, name || ' (asm)' AS signature, body,
       CAST(1 + coalesce(sum(nl) OVER (PARTITION BY file_path ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_line,
       CAST(coalesce(sum(nl) OVER (PARTITION BY file_path ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS end_line
FROM a
""")
def q_segment_asm(spark, sf):
    return P.asm_units(spark, sf).select("file_path", "name", "signature", "body",
                                         F.col("start_line").cast("bigint").alias("start_line"),
                                         F.col("end_line").cast("bigint").alias("end_line"))


@register("segment_whole_file", """
SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.' || lang AS file_path, '<file>' AS name,
       '<file>' AS signature, coalesce(text, '') AS body, CAST(1 AS BIGINT) AS start_line,
       CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS BIGINT) AS end_line,
       'other' AS language
FROM documents
""")
def q_segment_whole(spark, sf):
    u = S.segment_whole_file(P.doc_files(spark, sf))
    return u.select("file_path", "name", "signature", "body", F.col("start_line").cast("bigint").alias("start_line"),
                    F.col("end_line").cast("bigint").alias("end_line"), "language")


def _metric_query(col_expr_spark, alias, sql_expr):
    def fn(spark, sf):
        u = P.c_units(spark, sf)
        return u.select("id", col_expr_spark(u).alias(alias))
    return fn, WF + f"\nSELECT id, {sql_expr} AS {alias} FROM flagged"


for _key, _spark, _sql in [
    ("loc", lambda u: M.loc("body"), "loc"),
    ("cyclomatic", lambda u: M.cyclomatic("body"), "cyclomatic"),
    ("intent_tags", lambda u: P.csv(M.intent_tags("body", "file_path")),
     f"array_to_string({tags_expr()}, ',')"),
    ("risk_notes", lambda u: M.risk_notes("body", "file_path"), notes_expr()),
]:
    _fn, _q = _metric_query(_spark, _key, _sql)
    register(_key, _q)(_fn)


@register("call_sites", WF + f"""
SELECT id, array_to_string(regexp_extract_all(body, {q(M.CALL_SITE_RE)}, 1), ',') AS calls,
       CAST(len(regexp_extract_all(body, {q(M.CALL_SITE_RE)}, 1)) AS BIGINT) AS n_calls FROM flagged
""")
def q_call_sites(spark, sf):
    c = M.call_sites("body")
    return P.c_units(spark, sf).select("id", P.csv(c).alias("calls"), F.size(c).cast("bigint").alias("n_calls"))


@register("function_id", W + """
SELECT id, file_path, name, start_line FROM units2
""")
def q_function_id(spark, sf):
    return P.c_units(spark, sf).select("id", "file_path", "name", F.col("start_line").cast("bigint").alias("start_line"))


@register("language_of", WFILES + """
SELECT file_path, CASE WHEN file_path LIKE '%.c' OR file_path LIKE '%.h' THEN 'c'
                       WHEN file_path LIKE '%.asm' THEN 'asm' ELSE 'other' END AS language,
       CASE WHEN file_path LIKE '%.asm' THEN 'assembly' ELSE 'C' END AS prompt_language
FROM files
""")
def q_language_of(spark, sf):
    f = P.code_files(spark, sf)
    return f.select("file_path", M.language_of("file_path").alias("language"),
                    F.when(M.suffix("file_path") == ".asm", "assembly").otherwise("C").alias("prompt_language"))


@register("content_sha256", WFILES + """
SELECT file_path, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS file_size FROM files
""")
def q_content_sha256(spark, sf):
    f = P.code_files(spark, sf)
    b = F.col("text").cast("binary")
    return f.select("file_path", M.content_sha256(b).alias("sha256"), F.length(b).cast("bigint").alias("file_size"))


@register("truncate_fields", WFILES + """
SELECT u.id, u.body, CAST(length(u.body) AS BIGINT) AS body_chars, substring(u.body, 1, 100000) AS body_preview,
       substring(f.text, 1, 8000) AS file_preview
FROM units2 u JOIN files f ON f.file_path = u.file_path
""")
def q_truncate_fields(spark, sf):
    """The unit with its whole body; the previews are for display alone."""
    u = P.c_units(spark, sf)
    f = P.code_files(spark, sf).select("file_path", M.truncate("text", M.PREVIEW_FILE_CHARS).alias("file_preview"))
    return u.join(f, "file_path").select("id", "body", F.length("body").cast("bigint").alias("body_chars"),
                                         M.truncate("body", M.PREVIEW_BODY_CHARS).alias("body_preview"), "file_preview")


@register("extract_includes", WFILES + """
SELECT file_path, CAST(ordinal AS BIGINT) AS ordinal, inc AS include FROM (
  SELECT file_path, unnest(regexp_extract_all(text, '(?m)^\\s*#\\s*include\\s*[<"]([^>"]+)[>"]', 1)) AS inc,
         generate_subscripts(regexp_extract_all(text, '(?m)^\\s*#\\s*include\\s*[<"]([^>"]+)[>"]', 1), 1) - 1 AS ordinal
  FROM files)
""")
def q_extract_includes(spark, sf):
    return S.extract_includes(P.code_files(spark, sf)).select(
        "file_path", F.col("ordinal").cast("bigint").alias("ordinal"), "include")


@register("extract_prototypes", W + """
, pr AS (SELECT *, CASE WHEN p % 34 = 0 THEN 3 ELSE 1 END AS nl, p % 34 <> 0 AND p % 8 = 0 AS two FROM defs WHERE p % 2 = 0),
ln AS (SELECT *, CAST(6 + coalesce(sum(nl) OVER (PARTITION BY s, p // 1000 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_no FROM pr)
SELECT 'include/f_' || s || '_' || (p // 1000) || '.h' AS file_path, 'fn_' || p AS name,
       CASE WHEN nl = 3 THEN 'int fn_' || p || '(' || chr(10) || '    int x' || chr(10) || ')' ELSE 'int fn_' || p || '(int x)' END AS signature,
       line_no FROM ln
UNION ALL SELECT 'include/f_' || s || '_' || (p // 1000) || '.h', 'alt_' || p, 'int alt_' || p || '(void)', line_no FROM ln WHERE two
""")
def q_extract_prototypes(spark, sf):
    return S.extract_prototypes(P.code_files(spark, sf)).select(
        "file_path", "name", "signature", F.col("line_no").cast("bigint").alias("line_no"))


@register("top_n_per_file", WF + """
SELECT file_path, string_agg(name, chr(10) || chr(10) ORDER BY loc DESC, start_line) AS top_text,
       count(*) AS n_top
FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY loc DESC, start_line) AS rk FROM flagged)
WHERE rk <= 8 GROUP BY file_path
""")
def q_top_n(spark, sf):
    u = P.flagged(spark, sf)
    return R.top_n_per_file(u, 8, text="name").select("file_path", "top_text", F.col("n_top").cast("bigint").alias("n_top"))


@register("running_depth", W + f"""
SELECT 'src/m' || (s % 5) || '/f_' || s || '_' || (p // 1000) || '.c' AS file_path, CAST(1 AS BIGINT) AS max_depth,
       CAST(2 + CASE WHEN s % 3 = 0 THEN 6 ELSE 0 END + CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END + sum(nhead + 1) AS BIGINT) AS depth0_lines
FROM fn GROUP BY s, p // 1000
""")
def q_running_depth(spark, sf):
    return S.running_depth(P.code_files(spark, sf).where(F.col("file_path").endswith(".c")))


@register("file_members", W + """
SELECT file_path, id, start_line FROM units2
""")
def q_file_members(spark, sf):
    m = R.file_members(P.c_units(spark, sf))
    return m.select("file_path", "id", F.col("start_line").cast("bigint").alias("start_line"))


@register("next_label_extent", W + "," + FILES_CTES + """
, a AS (SELECT s, p, 'asm/' || 'f_' || s || '_' || (p // 1000) || '.asm' AS file_path, 'fn_' || p AS label, 3 + ncalls AS nl FROM fntext WHERE s % 4 = 0),
b AS (SELECT file_path, label,
             CAST(1 + coalesce(sum(nl) OVER (PARTITION BY file_path ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_no
      FROM a)
SELECT file_path, label, line_no, lead(line_no) OVER (PARTITION BY file_path ORDER BY line_no) AS next_label_line FROM b
""")
def q_next_label_extent(spark, sf):
    """Each label's block ends where the next label of its file starts."""
    return S.asm_labels(P.code_files(spark, sf).where(M.suffix("file_path") == ".asm"))


@register("ordered_distinct", WF + f"""
, cs AS (SELECT id, unnest(regexp_extract_all(body, {q(M.CALL_SITE_RE)}, 1)) AS name,
                generate_subscripts(regexp_extract_all(body, {q(M.CALL_SITE_RE)}, 1), 1) AS pos FROM flagged),
firsts AS (SELECT id, name, min(pos) AS pos FROM cs GROUP BY id, name)
SELECT f.id, coalesce((SELECT string_agg(x.name, ',' ORDER BY x.pos) FROM firsts x WHERE x.id = f.id), '') AS calls
FROM flagged f
""")
def q_ordered_distinct(spark, sf):
    """Distinct call-site names in first-occurrence order (``array_distinct``
    keeps the first occurrence)."""
    return P.c_units(spark, sf).select("id", P.csv(F.array_distinct(M.call_sites("body"))).alias("calls"))
