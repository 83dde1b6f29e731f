"""Pair queries hand out every pair, also of names with many definitions."""

import json

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import assemble as A
from tessera.operators import graph as G

SUPPLIERS = 70


def _tables(spark, tmp_path):
    """Every supplier defines part 2 and calls it from its part 4; part 4 has a header too."""
    rows = []
    for s in range(SUPPLIERS):
        rows += [(s, 1, s, 4), (s, 2, SUPPLIERS + s, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_every_call_and_header_of_a_common_name(spark, tmp_path):
    sf, q = _tables(spark, tmp_path), E.queries()
    assert q["resolve_callees"](spark, sf).count() == SUPPLIERS ** 2
    assert set(q["reverse_edges"](spark, sf).groupBy("id").count().select("count").distinct().collect()) == {(SUPPLIERS,)}
    links = q["link_headers"](spark, sf)
    assert links.count() == 2 * SUPPLIERS ** 2 == links.distinct().count() == q["train_header_context"](spark, sf).count()
    found = q["link_headers_contains"](spark, sf)  # callers hold the name too
    assert found.count() == found.distinct().count() == 3 * SUPPLIERS ** 2
    lists = q["qna_header_join"](spark, sf).groupBy("id").agg(F.sum(F.size(F.split("headers", ", "))).alias("got"), F.max("n_headers").alias("n"))
    assert lists.select("got", "n").distinct().collect() == [(SUPPLIERS, SUPPLIERS)]

    def callers(text):
        return [x for x in text.split("Callers: ")[1].split(" | ")[0].split("\n")[0].split(",") if x]
    records = [(r.id, json.loads(r.record)["input"]) for r in q["sft_instruction"](spark, sf).where("id like '%:fn_2:%'").collect()]
    contexts = [(r.id, r.input_text) for r in q["train_function_context"](spark, sf).where("id like '%:fn_2:%'").collect()]
    prompts = [(r.id, r.prompt) for r in q["prompt_function_graph"](spark, sf).where("id like '%:fn_2:%'").collect()]
    for texts in (records, contexts, prompts):
        whole = {}
        for i, t in texts:
            whole.setdefault(i, []).extend(callers(t))
        assert len(whole) == SUPPLIERS and all(len(v) == len(set(v)) == SUPPLIERS for v in whole.values())


def test_an_edge_met_by_name_and_id_counts_once(spark):
    units = spark.createDataFrame([("a", "x", "f"), ("b", "x", "g"), ("c", "y", "g")], "id string, file_path string, name string")
    calls = spark.createDataFrame([("a", "x", "b"), ("a", "x", "g"), ("c", "y", "f"), ("c", "y", "a")], "src string, src_file string, callee string")
    up, down = G.name_graph(units, calls)
    tier = G.class_tier("_c")
    got = G.name_edges(up.withColumn("_c", G.class_id("key")).withColumn("tier", tier), down).select("src", "dst", "tier")
    edges, _ = G.resolve_callees(units, calls)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, edges.collect())) == [("a", "b", 1), ("c", "a", 1)]


def test_header_links_row_by_row(spark):
    links = spark.createDataFrame([("a.h", "a.c", "i"), ("a.h", None, "j")], "header_file string, implementation_file string, function_id string")
    assert [tuple(r) for r in A.train_header_links(links).collect()] == [
        ("Header: a.h | Implementation: a.c | Function ID: i", "Linking header a.h to implementation a.c."),
        ("Header: a.h | Implementation:  | Function ID: j", "Linking header a.h to implementation .")]
