"""Synthetic C / header / assembly source tree derived from ``lineitem``.

The driver tables hold no source code, so the code operators run over a
tree that Spark derives from ``lineitem`` (its size grows with the table):

* definitions: distinct (supplier s, part p) -> ``fn_<p>`` defined in
  ``src/m<s%5>/f_<s>_<k>.c`` with ``k = p div STEP``
* calls: distinct (s, p, c) where c is the part of the order's next line,
  c != p, and not every 10th part, which nobody calls (entry points)
* headers ``include/f_<s>_<k>.h`` declare the definitions with even p
* ``asm/f_<s>_<k>.asm`` for s % 4 == 0 repeats the definitions as labels

Awkward shapes are part of it: every 17th part has its header over seven
lines (and its prototype over three), and every 499th a body of more than
120,000 characters with the calls behind the filler. Every 5th part has braces
in a string, a character constant and comments, every 23rd in a comment over
two lines. Headers have an include guard and a linkage block, as have the .c
files of every 3rd supplier; prototypes come two on a line (every 8th part) or
with a comment behind them (every 6th). Files of every 7th supplier include
``util.h``, of which there are three.

One group is one source file of at most ``STEP`` functions, whatever the
size of the table, so a supplier with a third of ``lineitem`` has more files
and not longer ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import load

NL = "\n"
STEP = 1000
WIDE, LONG, FILL, ENTRY = 17, 499, 10_001, 10
FILL_LINE = "    x += 1;" + NL
TRICK, COMMENT = 5, 23
TRICK_LINE = """    puts("}{\\"}", '}'); /* } */ // {""" + NL
COMMENT_LINES = "    /* {" + NL + "       { */" + NL
LINKED, TWO, REMARK, UTIL = 3, 8, 6, 7
UTIL_PATHS = ["include/util.h", "src/m0/util.h", "src/m2/util.h"]
UTIL_TEXT = "#define UTIL 1" + NL
OPEN_LINKAGE = '#ifdef __cplusplus' + NL + 'extern "C" {' + NL + '#endif' + NL
CLOSE_LINKAGE = '#ifdef __cplusplus' + NL + '}' + NL + '#endif' + NL


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).distinct()


def _call_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, p, c) of every call, as often as lineitem has it."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    a = li.select("l_orderkey", (F.col("l_linenumber") + 1).alias("n"), F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
    b = li.select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("c"))
    return a.join(b, ["l_orderkey", "n"]).where((F.col("p") != F.col("c")) & (F.col("c") % ENTRY != 0)).select("s", "p", "c")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _call_rows(spark, sf_dir).distinct()


def _body(fns: Column, text: Callable[[Column], Column]) -> Column:
    """The texts of a file's functions one after another (null: none)."""
    return F.array_join(F.transform(fns, text), "")


def _fill(template: str, *values: Column) -> Column:
    """``template`` with a value for each %d or %s, as ``format_string`` writes it."""
    texts = re.split("%[ds]", template)
    return F.concat(F.lit(texts[0]), *[x for v, t in zip(values, texts[1:]) for x in (F.coalesce(v.cast("string"), F.lit("null")), F.lit(t))])


def _call_lines(template: str, f: Column) -> Column:
    before, after = template.split("%d")
    calls = F.array_join(f["cs"].cast("array<string>"), after + before)
    return F.when(F.size(f["cs"]) > 0, F.concat(F.lit(before), calls, F.lit(after))).otherwise("")


def _c_text(f: Column) -> Column:
    p = f["p"]
    feature = F.concat(
        F.when(p % 3 == 0, F.lit("    printf(msg);" + NL)).otherwise(""),
        F.when(p % 7 == 0, F.lit("    char *q = malloc(x);" + NL)).otherwise(""),
        F.when(p % 11 == 0, F.lit("    strcpy(a, b);" + NL)).otherwise(""),
        F.when(p % 13 == 0, F.lit("    pthread_mutex_lock(m);" + NL)).otherwise(""),
        F.when(p % TRICK == 0, F.lit(TRICK_LINE)).otherwise(""),
        F.when(p % COMMENT == 0, F.lit(COMMENT_LINES)).otherwise(""),
    )
    head = F.when(p % WIDE == 0, _fill(
        NL.join(["static int", "fn_%d(", "    int x,", "    int a,", "    int b,", "    int c", ")", "{", ""]), p)).otherwise(
        _fill("int fn_%d(int x)" + NL + "{" + NL, p))
    filler = F.when(p % LONG == 0, F.repeat(F.lit(FILL_LINE), FILL)).otherwise("")
    return F.concat(head, filler, _call_lines("    if (x&&y) fn_%d(x);" + NL, f), feature, F.lit("    return x;" + NL + "}" + NL))


def _h_text(f: Column) -> Column:
    p = f["p"]
    proto = (F.when(p % WIDE == 0, _fill("int fn_%d(" + NL + "    int x" + NL + ");" + NL, p))
              .when(p % TWO == 0, _fill("int alt_%d(void); int fn_%d(int x);" + NL, p, p))
              .when(p % REMARK == 0, _fill("int fn_%d(int x); /* as fn_0(); }{ */" + NL, p))
              .otherwise(_fill("int fn_%d(int x);" + NL, p)))
    return F.when(p % 2 == 0, proto)


def _a_text(f: Column) -> Column:
    return F.concat(_fill("fn_%d:" + NL + "  mov a, x" + NL, f["p"]), _call_lines("  call fn_%d" + NL, f), F.lit("  ret" + NL))


def code_files(spark: SparkSession, sf_dir: str, with_asm: bool = True) -> DataFrame:
    """(file_path STRING, text STRING) for every .c, .h and .asm file.

    Only keys are grouped and shuffled; a file's texts are written out where its
    group ends up, all of them from one row."""
    # M = max(s)+1, planned as a scalar subquery (one value, no join).
    n_sup = load(spark, sf_dir, "lineitem").select(F.max("l_suppkey") + 1).scalar()

    # every definition, and with each of its callees; a file's rows meet once,
    # and what follows is grouped where they are
    li = load(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"), F.lit(None).cast("bigint").alias("c")).unionByName(
        _call_rows(spark, sf_dir).where(F.col("s").isNotNull()).withColumn("c", F.col("c").cast("bigint")))
    # a given number: sizes of keys don't tell those of the texts
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("k", F.floor(F.col("p") / STEP)).repartition(parts, "s", "k").distinct()
    fn = rows.groupBy("s", "k", "p").agg(F.sort_array(F.collect_list("c")).alias("cs"))  # leaves out the null
    per_s = fn.groupBy("s", "k").agg(F.sort_array(F.collect_list(F.struct("p", "cs"))).alias("fns"))
    s, k, fns = F.col("s"), F.col("k"), F.col("fns")
    stem = _fill("f_%d_%d", s, k)
    file = lambda path, text: F.struct(path.alias("file_path"), text.alias("text"))
    c_file = file(
        _fill("src/m%d/%s.c", s % 5, stem),
        F.concat(_fill('#include "f_%d_%d.h"' + NL, s, k),
                 _fill('#include "f_%d_%d.h"' + NL, (s * 7 + 1) % n_sup, k),
                 F.when(s % UTIL == 0, F.lit('#include "util.h"' + NL)).otherwise(""),
                 F.when(s % LINKED == 0, F.lit(OPEN_LINKAGE)).otherwise(""), _body(fns, _c_text),
                 F.when(s % LINKED == 0, F.lit(CLOSE_LINKAGE)).otherwise("")))
    guard = _fill("#ifndef F_%d_%d_H" + NL + "#define F_%d_%d_H" + NL, s, k, s, k)
    h_file = F.when(F.exists(fns, lambda f: F.coalesce(f["p"] % 2 == 0, F.lit(False))), file(
        _fill("include/%s.h", stem),
        F.concat(guard, F.lit(OPEN_LINKAGE), _body(fns, _h_text), F.lit(CLOSE_LINKAGE + "#endif" + NL))))
    a_file = F.when(s % 4 == 0, file(_fill("asm/%s.asm", stem), _body(fns, _a_text)))
    files = F.array_compact(F.array(c_file, h_file, *([a_file] if with_asm else [])))
    utils = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in UTIL_PATHS])).alias("file_path"), F.lit(UTIL_TEXT).alias("text"))
    return per_s.select(F.explode(files).alias("f")).select("f.file_path", "f.text").unionByName(utils)
