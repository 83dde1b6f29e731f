"""Factored pair relations against their expanded pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import classes as C
from tessera.operators import graph as G
from tessera.plans import pipeline as P


def sides(spark, seed, keys=9, n=70):
    rnd = random.Random(seed)
    one = lambda tag: sorted({(rnd.choice([f"k{rnd.randrange(keys)}", "hot"]), f"{tag}{rnd.randrange(40):02d}", f"p/{tag}") for _ in range(n)})
    left, right = one("l"), one("r")
    left += [("only left", "x", "p"), (None, "null key", "p")]
    right += [("only right", "y", "p"), (None, "null key", "p")]
    schema = "key string, item string, path string"
    return left, right, spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)


def expanded(left, right):
    return sorted((a[0], a[1], b[1]) for a in left for b in right if a[0] is not None and a[0] == b[0])


@pytest.mark.parametrize("seed,size", [(1, 3), (2, 64)])
def test_parts_hold_every_pair_and_no_product(spark, seed, size):
    left, right, ldf, rdf = sides(spark, seed)
    rows = C.class_parts(ldf, rdf, size).collect()
    assert len(rows) <= len(left) + len(right)
    by = {}
    for r in rows:
        by.setdefault((r["key"], r["side"]), []).extend(m["item"] for m in r["members"])
        assert r["part"] < r["parts"] == -(-(r["n_left"] if r["side"] == "left" else r["n_right"]) // size)
        assert list(r["members"]) == sorted(r["members"])
    got = sorted((k, a, b) for (k, s), ms in by.items() if s == "left" for a in ms for b in by[(k, "right")])
    assert got == expanded(left, right)


def test_counts_are_those_of_the_pairs(spark):
    left, right, ldf, rdf = sides(spark, 3)
    n = C.class_counts(ldf, rdf)
    pairs = expanded(left, right)
    assert {r["key"]: r["n_links"] for r in n.collect()} == {k: sum(p[0] == k for p in pairs) for k in {p[0] for p in pairs}}
    for df, other, at in ((ldf, "n_right", 1), (rdf, "n_left", 2)):
        got = {r["item"]: r["n_links"] for r in C.link_counts(df, n, ["item"], other).collect()}
        assert got == {i: sum(p[at] == i for p in pairs) for i in {p[at] for p in pairs}}


def test_pairs_of_chosen_members(spark):
    left, right, ldf, rdf = sides(spark, 4)
    chosen = ldf.where("item < 'l10'").select("key", F.col("item").alias("a"))
    got = sorted(tuple(r) for r in C.pairs_of(chosen, rdf.select("key", F.col("item").alias("b"))).select("key", "a", "b").collect())
    assert got == [p for p in expanded(left, right) if p[1] < "l10"]


def test_short_and_long_lists_cover_each_other(spark):
    left, right, ldf, rdf = sides(spark, 5)
    parts = C.class_parts(ldf, rdf, 4)
    short = C.short_lists(rdf, parts, C.LEFT, {"item": "names"}).collect()
    long = C.long_lists(parts, C.LEFT, {"item": "names"}).collect()
    held = {}
    for r in long:
        held.setdefault(r["key"], []).extend(r["names"].split(","))
    linked = {p[0] for p in expanded(left, right)}
    assert sorted(r["item"] for r in short) == sorted(b[1] for b in right if b[0] in linked)
    for r in short:
        want = sorted(a[1] for a in left if a[0] == r["key"])
        assert r["n"] == len(want) and r["long"] == (len(want) > 4)
        assert (sorted(held[r["key"]]) if r["long"] else r["names"].split(",")) == want
        assert (r["names"] is None) == r["long"]


def test_empty_sides(spark):
    _, _, ldf, rdf = sides(spark, 6)
    for a, b in ((ldf.limit(0), rdf), (ldf, rdf.limit(0))):
        assert C.class_parts(a, b).collect() == [] and C.class_counts(a, b).collect() == []


def test_class_ids_and_tiers(spark):
    df = spark.createDataFrame([("f\x00",), ("f\x00a/b.c",), ("\x00repo:a:f:1",)], "key string")
    got = df.select(G.class_id("key").alias("c")).select("c", G.class_tier("c").alias("t")).collect()
    assert [tuple(r) for r in got] == [("name:f", 3), ("file:a/b.c:f", 2), ("id:repo:a:f:1", 1)]


def test_no_stage_has_more_rows_than_members(spark, sf):
    """Prototypes, calls and definitions bound what the class stages hold."""
    left, right = P.header_sides(spark, sf)
    assert P.header_classes(spark, sf).count() <= left.count() + right.count()
    up, down = P.call_sides(spark, sf)
    members = up.count() + down.count()
    for stage in (P.call_classes, P.neighbors, P.callers, P.class_rows):
        assert stage(spark, sf).count() <= members + P.c_units(spark, sf).count()


def test_classes_expand_to_the_resolved_edges(spark, sf):
    _, edges, _ = P.call_graph(spark, sf)
    up, down = P.call_sides(spark, sf)
    pairs = up.withColumnRenamed("item", "src").join(down.withColumnRenamed("item", "dst"), "key")
    got = pairs.groupBy("src", "dst").agg(F.min(G.class_tier("key")).alias("tier"))
    want = edges.select("src", "dst", "tier")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
