"""What loops and stages leave on disk, and what queries move."""

import os

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans import QUERIES, pipeline as P
from tessera.session import ensure_checkpoint_dir

EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("e", "f"), ("g", "g"), ("x", "a"), (None, "a")]


def _left(spark):
    d = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(d) if os.path.isdir(f"{d}/{x}")}


def test_components_leave_one_table(spark):
    before = _left(spark)
    e = spark.createDataFrame(EDGES, "src string, dst string")
    got = {r.id: (r.scc_id, r.size, r.in_cycle) for r in G.scc(e).collect()}
    assert got == {**{x: ("a", 3, True) for x in "abc"}, **{x: ("d", 2, True) for x in "de"}, **{x: (x, 1, False) for x in "fgx"}}
    assert len(_left(spark) - before) == 1


def test_file_components_need_no_pairs_of_files(spark):
    units = spark.createDataFrame([("1", "a.c", "f"), ("2", "b.c", "f"), ("3", "b.c", "g"), ("4", "c.c", "h"), ("5", "d.c", "k"), ("6", "e.c", "l")],
                                  "id string, file_path string, name string")
    up = spark.createDataFrame([("1", "g\x00"), ("3", "f\x00"), ("4", "f\x00"), ("5", "l\x00"), ("6", "k\x00")], "src string, key string")
    down = spark.createDataFrame([("f\x00", "1"), ("f\x00", "2"), ("g\x00", "3"), ("k\x00", "5"), ("l\x00", "6")], "key string, dst string")
    pairs = G.name_file_edges(units, up, down).select(F.col("src_file").alias("src"), F.col("dst_file").alias("dst"))
    rows = lambda c: sorted(tuple(r) for r in c.select("id", "scc_id", "size", "in_cycle").collect())
    assert rows(G.file_scc(units, up, down)) == rows(G.scc(pairs))
    assert rows(G.scc(pairs))[:2] == [("a.c", "a.c", 2, True), ("b.c", "a.c", 2, True)]


def test_hashes_meet_and_texts_stay(spark, sf):
    plan = QUERIES["join_hash_reuse"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Join")[1]
    assert "own" in below and not any("text" in line for line in below.split("\n") if "Exchange" in line or "Sort [" in line)
    joined = [line for line in plan.split("\n") if "sha2(" in line]
    assert len(joined) == 2 and all("coalesce(" not in line for line in joined)  # both hashed before they meet


def test_stage_outputs_are_packed_tightly(spark, sf):
    P.code_files(spark, sf)
    path = next(v for k, v in P._MEMO.items() if k[3] == "code_files" and k[1] == sf).removeprefix("file:")
    assert all(".zstd." in f for f in os.listdir(path) if f.endswith(".parquet"))


def test_rounds_of_components_broadcast_no_table(spark, monkeypatch):
    """However small the files of a round's tables, they don't go through the driver."""
    plans, cut = [], G.cut_lineage
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(G, "cut_lineage", lambda df, *name: plans.append(plan(df)) or cut(df, *name))
    up = spark.createDataFrame([("0a", "n:f"), ("0b", "n:g"), ("0c", "n:f")], "src string, key string")
    down = spark.createDataFrame([("n:f", "0b"), ("n:g", "0a")], "key string, dst string")
    units = spark.createDataFrame([("0a",), ("0b",), ("0c",)], "id string")
    c = G.function_scc(up, down, units)
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in [*plans, plan(c)])
