"""Per-rule checks of the metric expressions; expected values worked out by
hand from the patterns (including their quirks)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import metrics as M
from tessera.functions import text as X


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], list(cols.keys())).select(expr.alias("x")).first()
    return row["x"]


@pytest.mark.parametrize("body,expected", [
    ("a&&b", 2),                 # word boundary on both sides of &&
    ("a && b", 1),               # spaces: no boundary next to &&, not counted
    ("if (x) return y;", 3),
    ("", 1),
    ("switch (c) { case 1: goto out; }", 4),
    ("a||b ? c : d", 2),         # || counted, ' ? ' not (no word boundary)
])
def test_cyclomatic(spark, body, expected):
    assert one(spark, M.cyclomatic(F.col("b")), b=body) == expected


@pytest.mark.parametrize("body,expected", [
    ("a\n\n  \nb\r\nc", 3),
    ("x\ry", 2),                 # splitlines also breaks on \r
    ("", 0),
    ("\t\n", 0),
])
def test_loc(spark, body, expected):
    assert one(spark, M.loc(F.col("b")), b=body) == expected


@pytest.mark.parametrize("body,path,expected", [
    ("pthread_create(x)", "a.c", ["other"]),          # pthread_ + \b never matches pthread_create
    ("x->y", "a.c", ["bitops"]),                       # '>' counts as a bit operator
    ("freeze(x)", "a.c", ["other"]),                   # \bfree\b does not match freeze
    ("printf(msg); malloc(n);", "a.c", ["I/O", "memory"]),
    ("mov a, b", "x.ASM", ["asm"]),
    ("lock(m); sqrt(x); strlen(s); sha256(d);", "a.c", ["concurrency", "crypto", "math", "string"]),
])
def test_intent_tags(spark, body, path, expected):
    assert one(spark, M.intent_tags(F.col("b"), F.col("p")), b=body, p=path) == expected


@pytest.mark.parametrize("body,path,expected", [
    ("freeze(x)", "a.c", M.NOTE_MEMORY),               # substring test: "free" in "freeze"
    ("strcpy(a, b); pthread_mutex_lock(m);", "a.c", M.NOTE_OVERFLOW + " " + M.NOTE_CONCURRENCY),
    ("nop", "a.asm", M.NOTE_ASM),
    ("return 0;", "a.c", ""),
])
def test_risk_notes(spark, body, path, expected):
    assert one(spark, M.risk_notes(F.col("b"), F.col("p")), b=body, p=path) == expected


def test_call_sites_keep_duplicates_and_keywords(spark):
    assert one(spark, M.call_sites(F.col("b")), b="if (x) foo (y); foo(z); naïve(q)") == ["if", "foo", "foo", "naïve"]


@pytest.mark.parametrize("path,sfx,lang", [
    ("src/a.C", ".c", "c"), ("x/y.h", ".h", "c"), ("k.asm", ".asm", "asm"), ("README", "", "other"),
    ("dir.v1/.bashrc", "", "other"), ("a.tar.gz", ".gz", "other"),
])
def test_suffix_and_language(spark, path, sfx, lang):
    assert one(spark, M.suffix(F.col("p")), p=path) == sfx
    assert one(spark, M.language_of(F.col("p")), p=path) == lang


def test_sha1_short_and_id(spark):
    import hashlib
    t = "x" * 20000
    assert one(spark, M.sha1_short(F.col("t")), t=t) == hashlib.sha1(("x" * 10000).encode()).hexdigest()[:12]
    assert one(spark, M.function_id(F.col("p"), F.lit(None).cast("string"), F.lit(None).cast("int")), p="a.c") == \
        "repo:a.c:<unknown>:0"


@pytest.mark.parametrize("raw,summary,conf", [
    ('{"summary": "ok", "confidence": 0.9}', "ok", 0.9),
    ('Sure! {"summary": "inner"} bye', "inner", 0.6),
    ("  just text  ", "just text", 0.6),
    ('{"risk_notes": "r"}', "", 0.6),
    ("{not json}", "{not json}", 0.6),                 # malformed braces: raw text becomes the summary
    ('{"summary": "a"} {"b": 1}', "a", 0.6),           # two objects: the first flat block
])
def test_parse_and_defaults(spark, raw, summary, conf):
    d = X.model_defaults(X.parse_model_json(F.col("r")), F.col("r"))
    row = spark.createDataFrame([(raw,)], ["r"]).select(d.alias("d")).first()["d"]
    assert row["summary"] == summary and abs(row["confidence"] - conf) < 1e-9


def test_strip_completion(spark):
    out = one(spark, X.strip_completion(F.col("o"), F.col("p"), "###"), o="Q?\n answer here ### tail", p=" Q? ")
    assert out == "answer here"


def test_dedent_like_textwrap(spark):
    import textwrap
    s = "        a\n          b\n\n   \n        c\n"
    assert one(spark, X.dedent(F.col("s")), s=s) == textwrap.dedent(s)


def test_prompt_function_matches_template(spark):
    import textwrap
    sig, body = "int f(int x)", "{\n    return x;\n}"
    expected = textwrap.dedent(f"""\
        Summarize the following C function. IMPORTANT: Return only valid JSON (no surrounding text).
        Required keys: summary (string), intent_tags (list of strings), risk_notes (string), change_recipe (string), confidence (float 0-1).

        Function signature:
        {sig}

        Function body:
        {body}

        Return a single JSON object and nothing else.
    """)
    got = one(spark, X.prompt_function(F.col("s"), F.col("b"), F.lit(False)), s=sig, b=body)
    assert got == expected
