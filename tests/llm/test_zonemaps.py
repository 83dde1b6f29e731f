"""k-means over zone maps against plain integers, the curve and the bounds."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import zonemaps as Z


def plain_kmeans(rows, k=40, rounds=5, dims=64, scale=256, seed=2):
    """[(vec_id, vector)] -> sorted (vec_id, cluster, distance, cluster inertia, inertia, digest)."""
    most = Z.largest(dims)
    kept = [(i, [max(-most, min(most, math.floor(scale * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        for i, vs in held.items():
            cents[i] = [sum(x) // len(vs) for x in zip(*vs)]
    last = [(i, *near(v)) for i, v in kept]
    per = {}
    for _, d, c in last:
        per[c] = per.get(c, 0) + d
    fits = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
    return sorted(repr((i, c, d, fits(per[c]), fits(sum(per.values())), digest(c))) for i, d, c in last)


def shown(found):
    return sorted(repr(tuple(r)) for r in Z.with_inertia(found).drop("compared").collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def some(rng, n, dims=64, spread=0.2):
    f32 = lambda x: float(np.float32(x))
    hubs = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(9)]
    return [(i, [f32(h + rng.gauss(0, spread)) for h in hubs[rng.randrange(9)]], 0) for i in range(n)]


@pytest.fixture(scope="module")
def odd_vectors():
    rng = random.Random(11)
    rows = some(rng, 150)
    v = rows[0][1]
    rows += [(200, None, 1), (201, [], 1), (202, v[:63], 1), (203, v + [0.1], 1), (204, [None] + v[1:], 1), (205, [float("nan")] + v[1:], None),
             (206, [float("inf")] + v[1:], 1), (207, [float("-inf")] + v[1:], 1), (None, v, 1), (None, rows[1][1], 1), (3, rows[5][1], 1),
             (4, rows[4][1], 1), (4, rows[4][1], 1), (208, [0.0] * 64, 1), (209, [-0.0] * 64, 1)]
    return rows + [(300 + i, rows[7][1], 2) for i in range(120)]


def test_equals_plain_version(spark, odd_vectors):
    df = spark.createDataFrame(odd_vectors, SCHEMA).repartition(6)
    for kw in ({}, {"k": 5, "rounds": 3, "block_rows": 4}, {"k": 1000, "rounds": 1}):
        small = {a: b for a, b in kw.items() if a != "block_rows"}
        assert shown(Z.kmeans(df, **kw)) == plain_kmeans([r[:2] for r in odd_vectors], **small)


def test_far_components_are_exact_integers(spark):
    rng = random.Random(12)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rng.choice([-1, 1]) * 10 ** rng.uniform(0, 9)) for _ in range(64)], 0) for i in range(60)]
    assert shown(Z.kmeans(spark.createDataFrame(rows, SCHEMA), k=7)) == plain_kmeans([r[:2] for r in rows], k=7)


def test_other_dimensions_and_few_rows(spark):
    rows = [(i, [0.5 * i, -1.0 * i], 0) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert shown(Z.kmeans(df, k=3, dims=2)) == plain_kmeans([r[:2] for r in rows], k=3, dims=2)
    one = spark.createDataFrame(rows[3:4], SCHEMA)
    assert shown(Z.kmeans(one, dims=2)) == plain_kmeans([rows[3][:2]], dims=2)


def test_empty_tables_and_clashing_names(spark, odd_vectors):
    none = spark.createDataFrame([], SCHEMA)
    got = Z.with_inertia(Z.kmeans(none))
    assert got.collect() == [] and got.columns[:3] == ["vec_id", "cluster", "distance"]
    assert Z.with_inertia(Z.kmeans(spark.createDataFrame([(1, None, 1)], SCHEMA))).collect() == []
    df = spark.createDataFrame(odd_vectors, SCHEMA)
    clash = df
    for c in ("id", "v", "key", "h", "cluster", "n", "sums", "ints", "lo"):
        clash = clash.withColumn(c, F.lit("mine"))
    assert shown(Z.kmeans(clash, rounds=1)) == shown(Z.kmeans(df, rounds=1))


def test_boxes_spare_comparisons_of_clustered_vectors(spark):
    rows = some(random.Random(13), 2000, spread=0.005)
    found = Z.kmeans(spark.createDataFrame(rows, SCHEMA), k=40, rounds=2, block_rows=16)
    assert min(found.skipped) > 0.5
    assert found.assigned.agg(F.max("compared")).first()[0] <= 40


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_keys_follow_a_hilbert_curve(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in Z.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest_centroid():
    rng = np.random.default_rng(14)
    for _ in range(200):
        v = rng.integers(-9, 10, (rng.integers(1, 20), 4))
        c = rng.integers(-12, 13, (rng.integers(1, 15), 4))
        near = Z.candidates(v.min(0), v.max(0), c)
        d = ((v[:, None] - c) ** 2).sum(2)
        assert set(d.argmin(1)) <= set(near)
        at, least = Z.nearest(v, c[near])
        assert (near[at] == d.argmin(1)).all() and (least == d.min(1)).all()


def test_query_equals_sql(spark, sf):
    import duckdb

    from tessera.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    rel = con.sql(ORACLE["op13_centroid_clustering"])
    want = sorted(map(repr, rel.fetchall()))
    assert sorted(repr(tuple(r)) for r in QUERIES["op13_centroid_clustering"](spark, sf).select(*rel.columns).collect()) == want
