"""DuckDB side of the code-corpus checks.

Units are derived from the definition rows by arithmetic (line counts of
each generated function), never by parsing, so a wrong segmentation cannot
agree with the oracle by sharing a bug.
"""

from ..functions import metrics as M

NL = "chr(10)"

# Python-regex spellings of the fixed patterns work in RE2 unchanged,
# except for the line-break class.
SPLIT_RE2 = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Path of a definition's file without folder and suffix; of a wide header,
# the lines before its brace; of a long body, its filler lines.
STEM = "'f_' || s || '_' || (p // 1000)"
ARGS = f"'int x,' || {NL} || '    int a,' || {NL} || '    int b,' || {NL} || '    int c'"
TRICK = "'    puts(\"}{{\\\"}\", ''}''); /* } */ // {{'".replace("{{", "{")
OPEN_LINKAGE = f"""'#ifdef __cplusplus' || {NL} || 'extern "C" {{' || {NL} || '#endif' || {NL}"""
CLOSE_LINKAGE = f"""'#ifdef __cplusplus' || {NL} || '}}' || {NL} || '#endif' || {NL}"""
FILL = f"CASE WHEN p % 499 = 0 THEN repeat('    x += 1;' || {NL}, 10001) ELSE '' END"

CODE_CTES = f"""
defs AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
calls AS (SELECT DISTINCT a.l_suppkey AS s, a.l_partkey AS p, b.l_partkey AS c
          FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
          WHERE a.l_partkey <> b.l_partkey AND b.l_partkey % 10 <> 0),
callagg AS (SELECT s, p, count(*) AS ncalls,
                   string_agg('    if (x&&y) fn_' || c || '(x);' || {NL}, '' ORDER BY c) AS call_lines
            FROM calls GROUP BY s, p),
fn AS (SELECT d.s, d.p, coalesce(ca.ncalls, 0) AS ncalls, coalesce(ca.call_lines, '') AS call_lines,
              (CASE WHEN d.p % 3 = 0 THEN '    printf(msg);' || {NL} ELSE '' END) ||
              (CASE WHEN d.p % 7 = 0 THEN '    char *q = malloc(x);' || {NL} ELSE '' END) ||
              (CASE WHEN d.p % 11 = 0 THEN '    strcpy(a, b);' || {NL} ELSE '' END) ||
              (CASE WHEN d.p % 13 = 0 THEN '    pthread_mutex_lock(m);' || {NL} ELSE '' END) ||
              (CASE WHEN d.p % 5 = 0 THEN {TRICK} || {NL} ELSE '' END) ||
              (CASE WHEN d.p % 23 = 0 THEN '    /* {{' || {NL} || '       {{ */' || {NL} ELSE '' END) AS feat,
              CAST(d.p % 3 = 0 AS INT) + CAST(d.p % 7 = 0 AS INT) + CAST(d.p % 11 = 0 AS INT)
                + CAST(d.p % 13 = 0 AS INT) + CAST(d.p % 5 = 0 AS INT) + 2 * CAST(d.p % 23 = 0 AS INT) AS nfeat,
              CASE WHEN d.p % 17 = 0 THEN 7 ELSE 1 END AS nhead, CASE WHEN d.p % 499 = 0 THEN 10001 ELSE 0 END AS nfill
       FROM defs d LEFT JOIN callagg ca ON ca.s = d.s AND ca.p = d.p),
units AS (SELECT s, p, 'src/m' || (s % 5) || '/' || {STEM} || '.c' AS file_path, 'fn_' || p AS name,
                 CASE WHEN p % 17 = 0 THEN 'static int fn_' || p || '(' || {ARGS} || ')' ELSE 'int fn_' || p || '(int x)' END AS signature,
                 '{{' || {NL} || {FILL} || call_lines || feat || '    return x;' || {NL} || '}}' AS body,
                 CAST(3 + (CASE WHEN s % 3 = 0 THEN 3 ELSE 0 END) + (CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END) + coalesce(sum(3 + nhead + nfill + ncalls + nfeat) OVER (PARTITION BY s, p // 1000 ORDER BY p
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_line,
                 3 + nhead + nfill + ncalls + nfeat AS nl
          FROM fn),
units2 AS (SELECT *, CAST(start_line + nl - 1 AS BIGINT) AS end_line,
                  'repo:' || file_path || ':' || name || ':' || start_line AS id FROM units)
"""


def metric_cols(body: str = "body", path_is_asm: str = "FALSE") -> str:
    low = f"lower({body})"
    tags = {t: f"regexp_matches({low}, {q(p)})" for t, p in M.TAG_RULES}
    tags["asm"] = path_is_asm
    tags["bitops"] = f"regexp_matches({body}, {q(M.BITOPS_RE)})"
    any_tag = " OR ".join(f"({tags[t]})" for t in M.TAG_ORDER)
    cols = [
        f"CAST(len(list_filter(string_split_regex({body}, {q(SPLIT_RE2)}), lambda x: regexp_matches(x, '\\S'))) AS BIGINT) AS loc",
        f"CAST(CASE WHEN coalesce(length({body}), 0) = 0 THEN 1 ELSE 1 + len(regexp_extract_all({body}, {q(M.CONTROL_RE)})) END AS BIGINT) AS cyclomatic",
    ]
    for t in M.TAG_ORDER:
        cols.append(f"({tags[t]}) AS {M.tag_col(t)}")
    cols.append(f"NOT ({any_tag}) AS tag_other")
    cols += [
        f"(contains({body}, 'malloc') OR contains({body}, 'free') OR contains({body}, 'realloc')) AS note_memory",
        f"regexp_matches({body}, {q(M.NOTE_OVERFLOW_RE)}) AS note_overflow",
        f"(contains({body}, 'pthread') OR contains({body}, 'mutex')) AS note_concurrency",
        f"({path_is_asm}) AS note_asm",
    ]
    return ",\n       ".join(cols)


TAGS_SORTED = sorted(M.TAG_ORDER + ["other"])


def tags_expr(wrap: str = "{}") -> str:
    parts = ", ".join(f"CASE WHEN {wrap.format(M.tag_col(t))} THEN {q(t)} END" for t in TAGS_SORTED)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


def notes_expr(wrap: str = "{}") -> str:
    parts = ", ".join(f"CASE WHEN {wrap.format(c)} THEN {q(s)} END" for c, s in M.NOTE_COLUMNS)
    return f"concat_ws(' ', {parts})"


FLAGGED = f"""
flagged AS (SELECT *, {metric_cols()} FROM units2)
"""

# Whole generated files, rebuilt in SQL from the same rows.
FILES_CTES = f"""
m AS (SELECT max(l_suppkey) + 1 AS m FROM lineitem),
callins AS (SELECT s, p, string_agg('  call fn_' || c || {NL}, '' ORDER BY c) AS call_ins FROM calls GROUP BY s, p),
fntext AS (SELECT f.s, f.p, f.ncalls,
                  CASE WHEN f.p % 17 = 0 THEN 'static int' || {NL} || 'fn_' || f.p || '(' || {NL} || '    ' || {ARGS} || {NL} || ')' || {NL} || '{{' || {NL}
                       ELSE 'int fn_' || f.p || '(int x)' || {NL} || '{{' || {NL} END
                    || {FILL.replace('p %', 'f.p %')} || f.call_lines || f.feat || '    return x;' || {NL} || '}}' || {NL} AS c_text,
                  CASE WHEN f.p % 34 = 0 THEN 'int fn_' || f.p || '(' || {NL} || '    int x' || {NL} || ');' || {NL}
                       WHEN f.p % 8 = 0 THEN 'int alt_' || f.p || '(void); int fn_' || f.p || '(int x);' || {NL}
                       WHEN f.p % 6 = 0 THEN 'int fn_' || f.p || '(int x); /* as fn_0(); }}{{ */' || {NL}
                       WHEN f.p % 2 = 0 THEN 'int fn_' || f.p || '(int x);' || {NL} END AS h_text,
                  'fn_' || f.p || ':' || {NL} || '  mov a, x' || {NL} || coalesce(ci.call_ins, '') || '  ret' || {NL} AS a_text
           FROM fn f LEFT JOIN callins ci ON ci.s = f.s AND ci.p = f.p),
files AS (
  SELECT 'src/m' || (s % 5) || '/f_' || s || '_' || (p // 1000) || '.c' AS file_path,
         '#include "f_' || s || '_' || (p // 1000) || '.h"' || {NL} || '#include "f_' || ((s * 7 + 1) % (SELECT m FROM m)) || '_' || (p // 1000) || '.h"' || {NL}
           || CASE WHEN s % 7 = 0 THEN '#include "util.h"' || {NL} ELSE '' END
           || CASE WHEN s % 3 = 0 THEN {OPEN_LINKAGE} ELSE '' END || string_agg(c_text, '' ORDER BY p)
           || CASE WHEN s % 3 = 0 THEN {CLOSE_LINKAGE} ELSE '' END AS text
  FROM fntext GROUP BY s, p // 1000
  UNION ALL
  SELECT 'include/f_' || s || '_' || (p // 1000) || '.h', '#ifndef F_' || s || '_' || (p // 1000) || '_H' || {NL}
           || '#define F_' || s || '_' || (p // 1000) || '_H' || {NL} || {OPEN_LINKAGE} || string_agg(h_text, '' ORDER BY p)
           || {CLOSE_LINKAGE} || '#endif' || {NL} FROM fntext GROUP BY s, p // 1000 HAVING count(h_text) > 0
  UNION ALL
  SELECT unnest(['include/util.h', 'src/m0/util.h', 'src/m2/util.h']), '#define UTIL 1' || {NL}
  UNION ALL
  SELECT 'asm/f_' || s || '_' || (p // 1000) || '.asm', string_agg(a_text, '' ORDER BY p) FROM fntext WHERE s % 4 = 0 GROUP BY s, p // 1000)
"""


def list_parts_sql(name: str, source: str, key: str, item: str, sep: str, out: str, size: int = 64) -> str:
    """Twin of ``assemble.list_parts``."""
    return f"""
{name}_n AS (SELECT {key} AS id, {item} AS item, count(*) OVER (PARTITION BY {key}) AS n FROM {source}),
{name}_p AS (SELECT *, CAST(ceil(n / {size}.0) AS BIGINT) AS parts FROM {name}_n),
{name} AS (SELECT id, part, parts, n, string_agg(item, '{sep}' ORDER BY item) AS {out}
           FROM (SELECT *, CAST(('0x' || substring(sha1(CAST(item AS VARCHAR)), 1, 7)) AS BIGINT) % parts AS part FROM {name}_p)
           GROUP BY id, part, parts, n)
"""


def windows_sql(name: str, source: str, keys: str, text: str, n: int = 512) -> str:
    """Twin of ``text.token_windows``: {name} has keys, win and piece."""
    return rf"""
{name}_p AS (SELECT {keys}, regexp_extract_all({text}, '\s*\S+') AS pc, regexp_extract({text}, '(\s*)\z', 1) AS tl FROM {source}),
{name}_n AS (SELECT *, greatest(1, CAST(ceil(len(pc) / {n}.0) AS BIGINT)) AS nw FROM {name}_p),
{name}_w AS (SELECT *, unnest(range(nw)) AS win FROM {name}_n),
{name}_x AS (SELECT *, array_to_string(pc[win * {n} + 1:(win + 1) * {n}], '') AS x FROM {name}_w),
{name} AS (SELECT {keys}, win, (CASE WHEN win = 0 THEN x ELSE regexp_replace(x, '^\s+', '') END)
                  || (CASE WHEN win = nw - 1 THEN tl ELSE '' END) AS piece FROM {name}_x)
"""


def dedent_sql(name: str, source: str, keys: str, raw: str) -> str:
    """Twin of ``text.dedent``: {name} has keys and prompt."""
    return rf"""
{name}_l AS (SELECT {keys}, list_transform(string_split({raw}, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\s*$') THEN '' ELSE l END) AS ls FROM {source}),
{name}_m AS (SELECT *, coalesce(list_min(list_transform(list_filter(ls, lambda l: l <> ''), lambda l: length(regexp_extract(l, '^( *)', 1)))), 0) AS mg FROM {name}_l),
{name} AS (SELECT {keys}, array_to_string(list_transform(ls, lambda l: CASE WHEN l = '' THEN l ELSE substring(l, mg + 1) END), chr(10)) AS prompt FROM {name}_m)
"""


FUNCTION_RAW = (
    "'        Summarize the following C function. IMPORTANT: Return only valid JSON (no surrounding text).' || chr(10)"
    " || '        Required keys: summary (string), intent_tags (list of strings), risk_notes (string), change_recipe (string), confidence (float 0-1).' || chr(10)"
    " || chr(10) || '        Function signature:' || chr(10) || '        ' || signature || chr(10) || chr(10)"
    " || '        Function body:' || chr(10) || '        ' || piece || chr(10) || chr(10)"
    " || '        Return a single JSON object and nothing else.' || chr(10)")
FILE_RAW = (
    "'        Summarize this file: ' || file_path || '.' || chr(10)"
    " || '        Aggregate the provided function summaries and return only a single JSON object with keys:' || chr(10)"
    " || '        - summary (string)' || chr(10) || '        - intent_tags (list of strings)' || chr(10)"
    " || '        - risk_notes (string)' || chr(10) || '        - change_recipe (string)' || chr(10)"
    " || '        - confidence (float 0-1)' || chr(10) || chr(10) || '        Content (top 8 functions by LOC):' || chr(10)"
    " || '        ' || top_text || chr(10) || chr(10) || '        Return strictly one JSON object and nothing else.' || chr(10)")
# the stand-in model's answer to a prompt
STUB_ANSWER = ("'stub summary ' || substring(sha1(prompt), 1, 8) AS answer, "
               "round(CAST(('0x' || substring(sha1(prompt), 9, 2)) AS INT) / 255.0, 3) AS conf")
