"""Graph operators against brute force on small random graphs."""

import random
from collections import deque

import pytest

from tessera.operators import graph as G


def rand_graph(seed, n=24, m=40):
    rnd = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(n)]
    edges = {(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(m)}
    return nodes, sorted(edges)


def reach(nodes, edges):
    adj = {v: [] for v in nodes}
    for a, b in edges:
        adj[a].append(b)
    r = {}
    for s in nodes:
        seen, q = {s}, deque([s])
        while q:
            u = q.popleft()
            for w in adj[u]:
                if w not in seen:
                    seen.add(w)
                    q.append(w)
        r[s] = seen
    return r


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scc_is_mutual_reachability(spark, seed):
    nodes, edges = rand_graph(seed)
    e = spark.createDataFrame(edges, ["src", "dst"])
    n = spark.createDataFrame([(v,) for v in nodes], ["id"])
    got = {r["id"]: (r["scc_id"], r["in_cycle"]) for r in G.scc(e, n).collect()}
    r = reach(nodes, edges)
    for v in nodes:
        comp = {u for u in nodes if u in r[v] and v in r[u]}
        assert got[v][0] == min(comp), v
        assert got[v][1] == (len(comp) > 1)


def test_bfs_distance(spark):
    nodes, edges = rand_graph(7, 30, 45)
    e = spark.createDataFrame(edges, ["src", "dst"])
    srcs = ["n00", "n05"]
    got = {r["id"]: r["dist"] for r in G.bfs_distance(e, spark.createDataFrame([(s,) for s in srcs], ["id"])).collect()}
    adj = {}
    for a, b in edges:
        adj.setdefault(a, []).append(b)
    dist = {s: 0 for s in srcs}
    q = deque(srcs)
    while q:
        u = q.popleft()
        for w in adj.get(u, []):
            if w not in dist:
                dist[w] = dist[u] + 1
                q.append(w)
    assert got == dist


def brandes(nodes, edges, sources):
    adj = {v: [] for v in nodes}
    for a, b in set(edges):
        if a != b:
            adj[a].append(b)
    bc = {v: 0.0 for v in nodes}
    for s in sources:
        stack, pred = [], {v: [] for v in nodes}
        sigma = dict.fromkeys(nodes, 0.0)
        sigma[s] = 1.0
        d = dict.fromkeys(nodes, -1)
        d[s] = 0
        q = deque([s])
        while q:
            v = q.popleft()
            stack.append(v)
            for w in adj[v]:
                if d[w] < 0:
                    d[w] = d[v] + 1
                    q.append(w)
                if d[w] == d[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        while stack:
            w = stack.pop()
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    return bc


def test_betweenness_matches_brandes(spark):
    nodes, edges = rand_graph(11, 20, 40)
    sources = ["n00", "n03", "n07"]
    e = spark.createDataFrame(edges, ["src", "dst"])
    got = {r["id"]: r["betweenness"] for r in
           G.betweenness_sampled(e, spark.createDataFrame([(s,) for s in sources], ["id"])).collect()}
    want = brandes(nodes, edges, sources)
    for v, b in want.items():
        assert abs(got.get(v, 0.0) - b) < 1e-9, v


def test_resolve_tiers(spark):
    units = spark.createDataFrame([
        ("a1", "a.c", "f", "{ g(); h(); zz(); f(); }"),
        ("a2", "a.c", "g", "{ }"),
        ("b1", "b.c", "h", "{ g(); }"),
        ("b2", "b.c", "g", "{ }"),
    ], ["id", "file_path", "name", "body"])
    edges, ext = G.resolve_callees(units)
    got = {(r["src"], r["dst"], r["tier"]) for r in edges.collect()}
    assert got == {("a1", "a2", 2), ("a1", "b1", 3), ("b1", "b2", 2)}
    assert {(r["src"], r["callee"]) for r in ext.collect()} == {("a1", "zz")}
    deg = {r["id"]: (r["in_degree"], r["out_degree"]) for r in G.degree_metrics(units.select("id"), edges, ext).collect()}
    assert deg == {"a1": (0, 3), "a2": (1, 0), "b1": (1, 1), "b2": (1, 0)}


def test_k_hop(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], ["src", "dst"])
    got = {(r["seed"], r["id"], r["dist"]) for r in G.k_hop_neighbors(e, spark.createDataFrame([("b",)], ["id"]), 2).collect()}
    assert got == {("b", "a", 1), ("b", "c", 1), ("b", "d", 2)}


def test_hot_callee_name_keeps_every_candidate(spark):
    """One name defined in 40 files and called from 300 functions in other
    files: tier 3 yields the full 300 x 40 fan-out (no cap)."""
    defs = [(f"h{i}", f"lib/{i}.c", "helper", "{ }") for i in range(40)]
    callers = [(f"c{j}", f"app/{j}.c", f"f{j}", "{ helper(); }") for j in range(300)]
    units = spark.createDataFrame(defs + callers, ["id", "file_path", "name", "body"])
    edges, ext = G.resolve_callees(units)
    assert edges.where("tier = 3").count() == 300 * 40
    assert ext.count() == 0
    deg = G.degree_metrics(units.select("id"), edges, ext)
    assert {r["in_degree"] for r in deg.where("id LIKE 'h%'").collect()} == {300}


def test_salted_hot_name_join_is_exact(spark):
    """Forcing the salted path (threshold below the hot name's definition
    count) gives exactly the plain join's pairs."""
    defs = [(f"h{i}", f"lib/{i}.c", "helper", "{ }") for i in range(40)]
    defs += [("q1", "lib/q.c", "quiet", "{ }")]
    callers = [(f"c{j}", f"app/{j}.c", f"f{j}", "{ helper(); quiet(); }") for j in range(120)]
    units = spark.createDataFrame(defs + callers, ["id", "file_path", "name", "body"])
    plain, _ = G.resolve_callees(units, hot_defs=10_000)
    salted, _ = G.resolve_callees(units, hot_defs=5, salts=7)
    a = sorted((r["src"], r["dst"], r["tier"]) for r in plain.collect())
    b = sorted((r["src"], r["dst"], r["tier"]) for r in salted.collect())
    assert a == b and len(a) == 120 * 41


def random_units(spark, seed, n=40, names=12, files=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        body = "{ " + " ".join(f"f{rnd.randrange(names + 2)}(x);" for _ in range(rnd.randrange(5))) + " }"
        rows.append((f"id{i:02d}", f"d/{rnd.randrange(files)}.c", f"f{rnd.randrange(names)}", body, i))
    return spark.createDataFrame(rows, "id string, file_path string, name string, body string, start_line int")


@pytest.mark.parametrize("seed", [1, 2])
def test_name_graph_equals_resolved_edges(spark, seed):
    u = random_units(spark, seed)
    edges, ext = G.resolve_callees(u)
    up, down = G.name_graph(u)
    assert {tuple(r) for r in up.join(down, "key").select("src", "dst").collect()} == {(r["src"], r["dst"]) for r in edges.collect()}
    nodes = u.select("id")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(G.name_degrees(nodes, up, down, ext)) == rows(G.degree_metrics(nodes, edges, ext))
    assert rows(G.name_file_edges(u, up, down)) == rows(G.file_edges(u, edges))
    assert rows(G.function_distance(up, down, u)) == rows(G.graph_distance(edges, nodes))
    seeds = nodes.limit(4)
    assert rows(G.function_neighbors(up, down, seeds, 2)) == rows(G.k_hop_neighbors(edges, seeds, 2))
    seen = []
    between = {r["id"]: r["betweenness"] for r in G.function_betweenness(up, down, seeds, lambda *x: seen.append(x)).collect()}
    want = {r["id"]: r["betweenness"] for r in G.betweenness_sampled(edges, seeds).collect()}
    assert set(between) == set(want) and all(abs(between[i] - want[i]) < 1e-9 for i in want)
    assert sum(n for _, n in seen) <= 4 * (up.count() + down.count())
    want = G.scc(edges, nodes).select("id", "scc_id", "size", "in_cycle")
    assert rows(G.function_scc(up, down, u)) == rows(want)


def test_scc_rounds_follow_the_logarithm_on_chains(spark):
    turns = {}
    for n in (40, 80):
        e = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(n)], ["src", "dst"])
        seen = []
        c = G.scc(e, log=lambda what, k: seen.append(k))
        assert c.where("in_cycle").count() == 0 and c.count() == n + 1
        turns[n] = len(seen)
    assert turns[80] <= turns[40] + 3 and turns[80] < 10


def test_includes_resolve_to_the_nearest(spark):
    paths = ["util.h", "lib/util.h", "lib/net/util.h", "app/ui/util.h", "app/ui/x.c", "app/db/deep/y.c", "lib/net/z.c", "lib/q.c", "w.c",
             "inc/sys/types.h", "lib/sys/types.h", "other/util.h"]
    files = spark.createDataFrame([(p,) for p in paths], ["file_path"])
    asks = [("app/ui/x.c", "util.h"), ("app/db/deep/y.c", "util.h"), ("lib/net/z.c", "./util.h"), ("lib/q.c", "util.h"), ("w.c", "util.h"),
            ("lib/q.c", "sys/types.h"), ("w.c", "sys/types.h"), ("lib/net/z.c", "../util.h"), ("lib/net/z.c", "../../app/ui/util.h"),
            ("w.c", "../util.h"), ("w.c", "missing.h"), ("w.c", "til.h"), ("lib/q.c", "net//util.h")]
    inc = spark.createDataFrame(asks, ["file_path", "include"])
    got = {(r["src_file"], r["dst_file"]) for r in G.include_graph(files, inc).collect()}
    assert got == {("app/ui/x.c", "app/ui/util.h"), ("app/db/deep/y.c", "app/ui/util.h"), ("lib/net/z.c", "lib/net/util.h"), ("lib/q.c", "lib/util.h"),
                   ("w.c", "util.h"), ("lib/q.c", "lib/sys/types.h"), ("w.c", "inc/sys/types.h"), ("lib/net/z.c", "lib/util.h"),
                   ("lib/net/z.c", "app/ui/util.h"), ("lib/q.c", "lib/net/util.h")}
