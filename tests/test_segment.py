"""Segmentation edge cases on hand-written files."""

from pyspark.sql import functions as F

from tessera.operators import segment as S

C_FILE = "\n".join([
    "#include <stdio.h>",                 # 1
    "",                                   # 2
    "",                                   # 3
    "static int",                         # 4  header over three lines (K&R brace below)
    "add(int a, int b)",                  # 5
    "{",                                  # 6
    "    if (a) {",                       # 7
    "        return a;",                  # 8
    "    } else if (b) {",                # 9  not a function
    "        return b;",                  # 10
    "    }",                              # 11
    "    return 0;",                      # 12
    "}",                                  # 13
    "int one(void) { return 1; }",        # 14 one-line function
    "int proto(int x);",                  # 15 prototype, not a unit
    "void open_end(void) {",              # 16 unclosed
    "    while (1) {",                    # 17
    "",
])


def units(spark, files):
    df = spark.createDataFrame(files, ["file_path", "text"])
    return {(r["name"], r["start_line"], r["end_line"]): r for r in S.segment_c_units(df).collect()}


def test_c_units(spark):
    u = units(spark, [("a.c", C_FILE)])
    assert set(u) == {("add", 4, 13), ("one", 14, 14), ("open_end", 16, 16)}
    add = u[("add", 4, 13)]
    assert add["signature"] == "static int add(int a, int b)"
    assert add["body"].startswith("{\n    if (a) {") and add["body"].endswith("return 0;\n}")
    assert u[("one", 14, 14)]["body"] == "{ return 1; }"
    assert u[("open_end", 16, 16)]["body"].startswith("{\n    while (1) {")


def test_crlf_and_empty(spark):
    crlf = "int f(int x)\r\n{\r\n  return x;\r\n}\r\n"
    u = units(spark, [("b.c", crlf), ("empty.c", "")])
    assert list(u) == [("f", 1, 4)]


def test_asm_units(spark):
    asm = "\n".join([
        "    .globl main",   # 1
        "main:",            # 2
        "    mov a, b",     # 3
        "; 1", "; 2", "; 3", "; 4",  # 4-7
        "helper:",          # 8: directive is more than 5 lines up, no instruction
        "data:",            # 9
        "    .word 1",      # 10: starts with '.', not an instruction word
        "",
    ])
    nolabel = "    nop\n    ret\n"
    df = spark.createDataFrame([("x.asm", asm), ("y.asm", nolabel)], ["file_path", "text"])
    got = {(r["file_path"], r["name"], r["start_line"], r["end_line"]) for r in S.segment_asm_units(df).collect()}
    # main: directive above; helper/data qualify neither way -> dropped
    assert got == {("x.asm", "main", 2, 7), ("y.asm", "<file>", 1, 2)}


def test_asm_fallback_keeps_all_labels(spark):
    asm = "a:\nb:\n"
    df = spark.createDataFrame([("z.asm", asm)], ["file_path", "text"])
    got = sorted((r["name"], r["start_line"], r["end_line"]) for r in S.segment_asm_units(df).collect())
    assert got == [("a", 1, 1), ("b", 2, 2)]


def test_whole_file(spark):
    df = spark.createDataFrame([("notes.txt", "a\nb\n")], ["file_path", "text"])
    r = S.segment_whole_file(df).first()
    assert (r["name"], r["start_line"], r["end_line"], r["language"]) == ("<file>", 1, 3, "other")


def test_chunk_lines_cover_every_line(spark):
    text = "\n".join(f"l{i}" for i in range(1, 24))
    df = spark.createDataFrame([(text, 10)], ["text", "start_line"])
    rows = sorted(S.chunk_lines(df, size=8, stride=6).collect(), key=lambda r: r["chunk_start_line"])
    spans = [(r["chunk_start_line"], r["chunk_end_line"]) for r in rows]
    assert spans == [(10, 17), (16, 23), (22, 29), (28, 32)]
    covered = set()
    for r in rows:
        covered.update(r["chunk_text"].split("\n"))
    assert covered == {f"l{i}" for i in range(1, 24)}


def test_chunk_tokens(spark):
    df = spark.createDataFrame([(" ".join(str(i) for i in range(10)),)], ["text"])
    rows = sorted(S.chunk_tokens(df, size=4, stride=3).collect(), key=lambda r: r["token_start"])
    assert [(r["token_start"], r["token_end"]) for r in rows] == [(0, 4), (3, 7), (6, 10)]


def test_includes_and_prototypes(spark):
    files = spark.createDataFrame([("m.h", '#include "a.h"\n# include <b.h>\nint f(int x);\nstruct s { int g(void); };\n')],
                                  ["file_path", "text"])
    inc = sorted(r["include"] for r in S.extract_includes(files).collect())
    assert inc == ["a.h", "b.h"]
    protos = [(r["name"], r["line_no"]) for r in S.extract_prototypes(files).collect()]
    assert protos == [("f", 3)]


def test_header_and_prototype_over_many_lines(spark):
    head = ["static", "unsigned long", "wide(", *[f"    int a{i}," for i in range(6)], "    int z)", "{"]
    text = "\n".join(["#define X 1", "", *head, "  return a0;", "}", "} ", "int after(void) {", "}", ""])
    u = units(spark, [("w.c", text)])
    assert set(u) == {("wide", 3, 15), ("after", 17, 18)}  # the stray brace on line 16 hides nothing
    h = "int\nf(\n  int x,\n  int y\n);\n\nvoid g(void); \nstruct s {\n int h(void);\n};\nint q(int a) ;\n"
    files = spark.createDataFrame([("m.h", h)], ["file_path", "text"])
    got = {(r["name"], r["line_no"], r["signature"]) for r in S.extract_prototypes(files).collect()}
    assert got == {("f", 1, "int\nf(\n  int x,\n  int y\n)"), ("g", 7, "void g(void)"), ("q", 11, "int q(int a)")}


def test_bodies_are_whole(spark):
    from tessera.functions import metrics as M
    long = "int big(int x)\n{\n" + "    x += 1;\n" * 10_005 + "    last_call(x);\n}\n"
    asm = "main:\n" + "  mov a, b\n" * 20_000
    df = spark.createDataFrame([("a.c", long), ("b.asm", asm), ("c.asm", "  nop\n" * 3000), ("d.txt", "y" * 9000),
                                ("e.c", "void open_end(void) {\n" + "  x();\n" * 2000)], ["file_path", "text"])
    r = S.segment_c_units(df).where("name = 'big'").select("body", M.loc("body").alias("loc"), M.call_sites("body").alias("calls")).first()
    assert r["loc"] == 10_008 and r["calls"] == ["last_call"] and len(r["body"]) > 100_000
    assert len(S.segment_c_units(df).where("name = 'open_end'").first()["body"]) > 12_000
    assert sorted(len(x["body"]) for x in S.segment_asm_units(df).collect()) == [18_000, len(asm)]
    assert len(S.segment_whole_file(df).first()["body"]) == 9000


def test_chunk_tokens_keep_the_text(spark):
    df = spark.createDataFrame([("  a\tb\n\n c   d e ",)], ["text"])
    rows = sorted(S.chunk_tokens(df, size=3, stride=2).collect(), key=lambda r: r["token_start"])
    assert [r["chunk_text"] for r in rows] == ["a\tb\n\n c", "c   d e"]


def test_corpus_keeps_every_definition(spark, sf, monkeypatch):
    """Many files per supplier: segmentation still recovers each (supplier,
    part) definition exactly once."""
    from tessera.sources import corpus
    monkeypatch.setattr(corpus, "STEP", 50)
    files = corpus.code_files(spark, sf)
    assert files.where(files.file_path.rlike(r"/f_\d+_[1-9]\d*\.c$")).count() > 0
    units = S.segment_c_units(files)
    n_defs = corpus.definitions(spark, sf).count()
    assert units.where(units.file_path.endswith(".c")).count() == n_defs


GUARDED = """#ifndef API_H
#define API_H
#ifdef __cplusplus
extern "C"
{
#endif
int a(void);
int b(int x); /* see } and { */
int c(void); int d(int x,
  int y); // two on a line; the second over two
/* int old(void);
   { */
#define BEGIN { \\
   if (x) {
int e(char q); // ' " {
static const char *s = "}{;\\\\"; int f(void);
#if 0 // don't
#endif
namespace inner { int g(void); }
inline namespace v1::x
{
int h(void);
}
struct t { int not_this(void); };
#ifdef __cplusplus
}
#endif
int last(void);
#endif
"""


def test_prototypes_of_a_guarded_header(spark):
    files = spark.createDataFrame([("api.h", GUARDED)], ["file_path", "text"])
    got = {(r["name"], r["line_no"], r["signature"]) for r in S.extract_prototypes(files).collect()}
    assert got == {("a", 7, "int a(void)"), ("b", 8, "int b(int x)"), ("c", 9, "int c(void)"), ("d", 9, "int d(int x,\n  int y)"),
                   ("e", 15, "int e(char q)"), ("f", 16, "int f(void)"), ("g", 19, "int g(void)"), ("h", 22, "int h(void)"),
                   ("last", 28, "int last(void)")}


def test_measured_headers(spark):
    """One line each, as found wanting before."""
    for text, names in (('#ifdef __cplusplus\nextern "C" {\n#endif\nint a(void);\nint b(void);\n#ifdef __cplusplus\n}\n#endif\n', {"a", "b"}),
                        ("int a(void); int b(void);\n", {"a", "b"}), ("int e(void); /* c */\n", {"e"})):
        files = spark.createDataFrame([("m.h", text)], ["file_path", "text"])
        assert {r["name"] for r in S.extract_prototypes(files).collect()} == names


def test_braces_that_are_no_braces(spark):
    text = "\n".join([
        '#include "a.h"',                                   # 1
        'extern "C" {',                                     # 2
        "/* int ghost(void) {",                             # 3
        "   } */",                                          # 4
        "int f(int x) // opens {",                          # 5
        "{",                                                # 6
        '    puts("}"); puts("\\"}"); c = \'}\'; d = \'\\\'\'; /* } */', # 7
        "    // } and a line that goes on \\",              # 8
        "    }}}",                                          # 9
        '    s = "over \\',                                 # 10
        '         lines }";',                               # 11
        "#define END }",                                    # 12
        "    /* { */ if (x) { y(); }",                      # 13
        "}",                                                # 14
        "}",                                                # 15  of the linkage block
        'extern "C" int g(void); int h(void) { return "{"[0]; }',  # 16
        "int k(void) {",                                    # 17
        "    /* never closed }",                            # 18
    ])
    u = units(spark, [("t.c", text)])
    assert set(u) == {("f", 5, 14), ("k", 17, 17)} | {x for x in u if x[0] == "h"}
    f = u[("f", 5, 14)]
    assert f["body"] == "\n".join(text.split("\n")[5:14]) and f["signature"] == "int f(int x)"
    assert u[("k", 17, 17)]["body"] == "{\n    /* never closed }"


def slow_view(text):
    """The code view, one character at a time."""
    out, i, n = [], 0, len(text)
    blank = lambda c, keep="": c if c == "\n" or c in keep and c else " "
    at_start = True
    while i < n:
        c = text[i]
        if at_start:
            j = i
            while j < n and text[j] in " \t\r\x0b\x0c":
                j += 1
            if j < n and text[j] == "#":
                while i < n:
                    if text[i] == "\\" and i + 1 < n:
                        step = 3 if text[i + 1:i + 3] == "\r\n" else 2
                        out += [blank(x, "#") for x in text[i:i + step]]
                        i += step
                    elif text[i] == "\\" or text[i] == "\n" or text.startswith("/*", i):
                        break
                    elif text[i] in "\"'":
                        k = quoted(text, i)
                        out += [blank(x, "#") for x in text[i:k]]
                        i = k
                    else:
                        out.append(blank(text[i], "#"))
                        i += 1
                at_start = False
                if i < n and text[i] == "\\":
                    out.append("\\")
                    i += 1
                continue
        at_start = False
        if text.startswith("/*", i):
            k = text.find("*/", i + 2)
            k = n if k < 0 else k + 2
            out += [blank(x) for x in text[i:k]]
        elif text.startswith("//", i):
            k = i + 2
            while k < n and text[k] != "\n":
                if text[k] == "\\":
                    if k + 1 >= n:
                        break
                    k += 3 if text[k + 1:k + 3] == "\r\n" else 2
                else:
                    k += 1
            out += [blank(x) for x in text[i:k]]
        elif c in "\"'":
            k = quoted(text, i)
            out += [blank(x, '"' if c == '"' else "") for x in text[i:k]]
        else:
            k = i + 1
            out.append(c)
            at_start = c == "\n"
        i = k
    return "".join(out)


def quoted(text, i):
    q, k, n = text[i], i + 1, len(text)
    while k < n and text[k] not in (q, "\n"):
        if text[k] == "\\":
            if k + 1 >= n:
                return k
            k += 3 if text[k + 1:k + 3] == "\r\n" else 2
        else:
            k += 1
    return k + 1 if k < n and text[k] == q else k


def test_code_view_equals_a_character_loop(spark):
    import random
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(['"', "'", "/", "*", "/*", "*/", "//", "\\", "\n", "\r\n", "#", " ", "a", "{", "}", ";", "é", "\U0001F600"])
                     for _ in range(rnd.randrange(40))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for r in df.select("t", S.code_view(F.col("t")).alias("v")).collect():
        assert r["v"] == slow_view(r["t"]), repr(r["t"])


def test_code_view_of_long_tokens(spark):
    """Constant stack: strings, comments and directives of a million characters."""
    parts = ['"' + '\\x00' * 300_000 + '"', "/*" + "*" * 1_000_000 + "*/", "//" + " /*" * 300_000 + "\n", "#define X " + "\\\n{" * 300_000 + "\n",
             "'" + "\\'" * 300_000 + "'", '"' * 300_001 + "\n"]
    df = spark.createDataFrame([(p + "\nint x;",) for p in parts], "t string")
    got = df.select(F.length(S.code_view(F.col("t"))).alias("n"), F.length("t").alias("m"), S.code_view(F.col("t")).endswith("\nint x;").alias("end"),
                    S.code_view(F.col("t")).contains("{").alias("brace")).collect()
    assert all(r["n"] == r["m"] and r["end"] and not r["brace"] for r in got)


def test_running_depth(spark):
    files = spark.createDataFrame([("a.c", 'int f(void)\n{\n  puts("}}");\n  if (x) {\n  }\n}\n')], ["file_path", "text"])
    assert [tuple(r) for r in S.running_depth(files).collect()] == [("a.c", 2, 2)]
