"""The scan of C texts and the metrics' patterns equal their plain definitions."""

import random
import re

from pyspark.sql import functions as F

from tessera.functions import ccode, metrics as M
from tessera.operators import segment as S
from tessera.sources import corpus

PIECES = ["{", "}", "{ }", "} {", ";", "a;", "int f(x)", "static int\ng(\nint y\n)", "\n", "\n", "\n", " ", "\t", "# define X", "#", "\\\n", "\\", '"', '"s{t"', "'",
          "'}'", "'\\''", '"\\""', "/* ", "*/", "// c", "/", 'extern "C" {', "extern", "namespace a::b {", "namespace", "int h(void) {\n return 1;\n}",
          "else if(q){", "\r\n", "\r", "\x85", " ", "é", "𝕏", "\x0b", "/*/", "int  k ( int *a,\n char b ) {", "};\n", "x;\x85\n", " ;  \n", " # q\n",
          '_extern "C" {', 'éextern "" {', "\\\r\n"]


def _texts(n=1500):
    rng = random.Random(9)
    return ["".join(rng.choice(PIECES) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["", "\n", "\n\n", "a\n{"]


def test_view_equals_that_of_sparks_functions(spark):
    df = spark.createDataFrame([(t,) for t in _texts()], "t string")
    for r in df.select("t", S.code_view(F.col("t")).alias("v")).collect():
        assert ccode.code_view(r.t) == r.v, r.t


def test_statements_equal_those_of_sparks_scan(spark):
    views = [ccode.lines_and_code(t)[1] for t in _texts()]
    df = spark.createDataFrame([(v,) for v in views], "v string")
    for r in df.select("v", F.transform(F.array("v"), S._scan)[0]["ends"].alias("ends")).collect():
        got = list(ccode.statements(r.v))
        assert [(last, depth) for *_, last, depth in got] == [tuple(e) for e in r.ends], r.v
        assert "\n".join(r.v[a:b] for a, b, *_ in got) == r.v
        lines = r.v.split("\n")
        assert all("\n".join(lines[first - 1:last]) == r.v[a:b] for a, b, first, last, _ in got)


def test_functions_are_rows_of_one_pass_of_a_bounded_batch(spark, monkeypatch):
    """Units come from the file's own row in one step, in batches of bounded size."""
    monkeypatch.setattr(S, "_BATCH_ROWS", 3)
    text = 'extern "C" {\n' + "".join(f"int f{i}(int x)\n{{\n  return {i};\n}}\n" for i in range(10)) + "int open(void) {\n"
    units = S.segment_c_units(spark.createDataFrame([("a.c", text), ("b.h", None), ("c.txt", text)], "file_path string, text string"))
    assert units._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = sorted((r.start_line, r.end_line, r.name, r.body, r.signature, r.file_path) for r in units.collect())
    assert got[:10] == [(2 + 4 * i, 5 + 4 * i, f"f{i}", f"{{\n  return {i};\n}}", f"int f{i}(int x)", "a.c") for i in range(10)]
    assert got[10:] == [(42, 42, "open", "{", "int open(void)", "a.c")]


def test_metrics_equal_their_patterns(spark):
    rng = random.Random(3)
    pieces = ["if", "else", "&&", "||", "?", "f(", "g (", "h\t\n(", "_x1(", "é(", "aé(", "1a(", "(", "{", ";", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " ", "\x1f",
              " ", "\t", "x", "read", "Printf", "malloc", "free", "memset", "pthread_", "pthread_a", "mutex", "sin", "strcpy", "gets", "crypto_", "&", "|", "_"]
    bodies = ["".join(rng.choice(pieces) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 20))) for _ in range(3000)] + ["", None]
    b = F.coalesce(F.col("b"), F.lit(""))
    low = F.lower(b)
    want = [F.size(F.filter(F.split(b, M.SPLITLINES_RE), lambda x: x.rlike(r"\S"))), F.regexp_count(b, F.lit(M.CONTROL_RE)) + 1,
            F.regexp_extract_all(b, F.lit("(?U)" + M.CALL_SITE_RE), 1)]
    tags = F.array(*[F.when(low.rlike(p), t) for t, p in M.TAG_RULES], F.when(b.rlike(M.BITOPS_RE), "bitops"))
    got = [M.loc("b"), M.cyclomatic("b"), M.call_sites("b")]
    df = spark.createDataFrame([(x,) for x in bodies], "b string")
    rows = df.select("b", *[(w == g).alias(f"m{i}") for i, (w, g) in enumerate(zip(want, got))], F.array_compact(tags).alias("tags"),
                     M.intent_tags("b", F.lit("a.c")).alias("got")).collect()
    assert all(r.m0 and r.m1 and r.m2 and r.got == (sorted(r.tags) or ["other"]) for r in rows)
    plan = df.select(M.intent_tags("b", F.lit("a.c")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1  # the words of all rules at once


def test_corpus_texts_need_no_formatter(spark, sf):
    files = corpus.code_files(spark, sf)
    assert "format_string" not in files._jdf.queryExecution().executedPlan().toString()
    text = files.where("file_path like '%.c'").orderBy("file_path").first().text
    assert re.match(r'#include "f_\d+_\d+\.h"\n#include "f_\d+_\d+\.h"\n', text) and "%" not in text
    nulls = spark.range(1).select(corpus._fill("f_%d_%s", F.lit(None).cast("long"), F.lit("x")).alias("t")).first().t
    assert nulls == "f_null_x"
