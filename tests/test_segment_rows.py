"""Units come from a file's own row: no exchange, window or sort over lines."""

import random

from pyspark.sql import functions as F

from tessera.operators import segment as S
from tessera.sources import corpus


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _files(spark):
    c = "int a(int x)\n{\n" + "    x += 1;\n" * 500 + "}\n" + "#define A 1\n" * 700 + "int b;\n}\nint c(void) { return 1; }\nint d(void) {\n  return"
    h = "int a(int x); int b(void);\n#if 1\nint c(\n  int x\n);\n"
    asm = "start:\n  mov a, b\nnext:\n\nlast:\nret"
    return spark.createDataFrame([("s/a.c", c), ("i/a.h", h), ("a/a.asm", asm), ("a/b.asm", "no label\n"), ("a/c.asm", "x:\n\ny:\n"),
                                  ("a/d.asm", None), ("a/e.asm", "")], "file_path string, text string")


def test_no_exchange_of_lines(spark):
    f = _files(spark)
    for df in (S.segment_c_units(f), S.segment_asm_units(f), S.extract_prototypes(f), S.running_depth(f), S.asm_labels(f)):
        assert not any(x in _plan(df) for x in ("Exchange", "Window", "Sort", "ObjectHashAggregate"))


def test_statements_over_many_lines_and_ends(spark):
    f = _files(spark)
    got = {r.name: (r.start_line, r.end_line, r.body[:3]) for r in S.segment_c_units(f).collect()}
    # more ends than a run holds; a stray brace changes nothing; d is never closed
    assert got == {"a": (1, 503, "{\n "), "c": (1206, 1206, "{ r"), "d": (1207, 1207, "{\n ")}
    s = S.statements(f.where("file_path = 's/a.c'")).orderBy("first_line").collect()
    assert [r.stmt for r in s] == list(range(len(s))) and len(s) == 1 + 700 + 1 + 1 + 1 + 1
    assert all(b.first_line == a.last_line + 1 for a, b in zip(s, s[1:])) and s[-1].depth == 1
    assert "\n".join(r.text for r in s) == f.where("file_path = 's/a.c'").first().text
    depth = S.running_depth(f.where("file_path = 's/a.c'")).first()
    assert (depth.max_depth, depth.depth0_lines) == (1, 1 + 1 + 700 + 1 + 1 + 1)


def test_asm_blocks_of_a_row(spark):
    got = {(r.file_path, r.name): (r.start_line, r.end_line, r.body, r.signature) for r in S.segment_asm_units(_files(spark)).collect()}
    assert got == {  # the word alone on the last line has no end, so it isn't an instruction
        ("a/a.asm", "start"): (1, 2, "start:\n  mov a, b\n", "start (asm)"),
        ("a/b.asm", "<file>"): (1, 1, "no label\n", "<asm>"), ("a/e.asm", "<file>"): (1, 1, "", "<asm>"),
        ("a/c.asm", "x"): (1, 2, "x:\n\n", "x (asm)"), ("a/c.asm", "y"): (3, 3, "y:\n", "y (asm)")}
    labels = S.asm_labels(_files(spark).where("file_path = 'a/a.asm'")).orderBy("line_no").collect()
    assert [tuple(r)[1:] for r in labels] == [("start", 1, 3), ("next", 3, 5), ("last", 5, None)]


def test_corpus_moves_keys_alone(spark, sf):
    """No text crosses an exchange: they are written out behind the last one."""
    plan = _plan(corpus.code_files(spark, sf))
    behind = plan.split("Exchange hashpartitioning(s")[-1]
    assert plan.count("Exchange hashpartitioning(s") == 1 and "format_string" not in behind
    n = corpus.code_files(spark, sf).groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
    assert n == 0


def _by_line(view):
    """Depth after each line, and (line, depth) of each statement's last, line by line."""
    lines = view.split("\n")
    total = low = 0
    depths, ends = [], []
    for i, c in enumerate(lines, 1):
        total += c.count("{") - c.count("}")
        low = min(low, total)
        depths.append(total - low)
        if not depths[-1] and ("}" in c or c.rstrip().endswith(";") or c.lstrip().startswith("#")):
            ends.append((i, 0))
    return depths, ends + ([(len(lines), depths[-1])] if (ends[-1][0] if ends else 0) < len(lines) else [])


def test_scan_equals_a_walk_over_the_lines(spark):
    rng = random.Random(5)
    pieces = ["{", "}", "{ }", "{{ }}", "} {", "a;", "int f(x)", "b", "# define", " ", "  # x", "};", "x = {1, {2}};", "{ {"]
    texts = ["\n".join(" ".join(rng.choices(pieces, k=rng.randint(0, 3))) for _ in range(rng.randint(1, 14))) + rng.choice(["", "\n"]) for _ in range(400)]
    texts += ["{\n" * 6 + "a;\n" + "}\n" * 6, "a\n{\n{1}\n b;\n}\nc;\n{\n{\n}\n", "}\n}\n{\n a\n}\nb;"]
    f = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file_path string, text string")
    got = f.select("file_path", "text", F.transform(F.array("text"), S._scan)[0].alias("s")).collect()
    for r in got:
        depths, ends = _by_line(r.text)
        assert [(e.line, e.depth) for e in r.s.ends] == ends, r.text
        assert r.s.most == max(depths) and r.s.flat == depths.count(0), r.text


def test_plain_code_is_few_tokens_and_blocks(spark):
    """Function bodies are passed over at once, whatever their length."""
    text = "".join(f"int f{i}(int x)\n{{\n" + "    x += 1 / 2;\n" * 200 + "}\n" for i in range(10))
    text += "#define A \\\n {\n/* { # */ # b\nextern \"C\" {\nmyextern \"C\" {\nnamespace a::b {\nxnamespace c {\n"
    r = spark.createDataFrame([(text,)], "t string").select(
        F.size(F.regexp_extract_all("t", F.lit(S.C_TOKEN_RE), 0)).alias("tokens"),
        F.size(F.regexp_extract_all(F.col("t"), F.lit(S.BLOCK_LINES_RE), 0)).alias("blocks"), S.code_view(F.col("t")).alias("view")).first()
    assert r.tokens < 30 and r.blocks < 40
    assert r.view.split("\n")[-8:] == ["#" + " " * 10, "  ", " " * 9 + " # b", 'extern " " ;', 'myextern " " {', "namespace a::b ;", "xnamespace c {", ""]
