"""Names that very many functions call, and model texts that are parsed once."""

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import graph as G


def test_split_known_is_semi_and_anti_join_also_for_hot_names(spark):
    calls = spark.createDataFrame([(f"s{i}", "f.c", c) for i in range(6) for c in ("if", "fn_1", f"fn_{i}", f"puts{i}")] + [("s9", None, None)],
                                  "src string, src_file string, callee string")
    names = spark.createDataFrame([("fn_1",), ("fn_2",), ("fn_7",)], "callee string")
    for hot in (3, 100):  # with hot names of both kinds, and without
        known, others = G.split_known(calls, names, hot)
        assert known.columns == others.columns == calls.columns
        for got, how in ((known, "left_semi"), (others, "left_anti")):
            want = calls.join(names, "callee", how).select(*calls.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_names_that_nobody_defines_are_no_nodes(spark):
    units = spark.createDataFrame([("u1", "a.c", "f", "{ if (x) g(x); puts(x); }", 1), ("u2", "b.c", "g", "{ if (x) f(x); u1(x); }", 1)],
                                  "id string, file_path string, name string, body string, start_line int")
    up, down = G.name_graph(units)
    assert sorted((r["src"], r["key"]) for r in up.collect()) == [("u1", "g\x00"), ("u2", "\x00u1"), ("u2", "f\x00")]
    assert {r["key"] for r in down.collect()} == {"g\x00", "f\x00", "\x00u1"}


def test_model_text_is_parsed_once(spark):
    df = spark.createDataFrame([('{"summary": "s", "confidence": 0.5}', False), ("no json", False), (None, False), ("{}", True)], "r string, failed boolean")
    parsed = X.parse_model_json(F.col("r"))
    plan = lambda c: df.select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    out = X.model_defaults(parsed, F.col("r"), F.col("failed"))
    assert plan(out).count("from_json") + plan(out).count("JsonToStructs") <= plan(parsed).count("from_json") + plan(parsed).count("JsonToStructs")
    got = [tuple(r["x"]) for r in df.select(out.alias("x")).collect()]
    assert got == [("s", [], "", "", 0.5), ("no json", [], "", "", 0.6), ("", [], "", "", 0.6), ("", [], "", "", 0.0)]
