import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tessera.llm import components as C
from tessera.llm import exact_dedup as E
from tessera.llm import line_dedup as L
from tessera.llm import simhash as H


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


# -- line dedup

def test_perfect_hash_is_minimal_and_rejects_by_fingerprint():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    ph = L.PerfectHash.build(keys)
    assert sorted(ph.index(keys).tolist()) == list(range(len(keys)))
    again = L.PerfectHash.load(*ph.dump())
    assert (again.index(keys) == ph.index(keys)).all()
    lo, n = keys ^ np.uint64(99), np.arange(len(keys))
    index = L.Index(*L.build_index(keys, lo, n, 0)[1:])
    assert (index.probe(keys, lo) == n).all()
    other = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    assert (index.probe(other, other) == 0).all()


def test_lines_that_share_the_hash_are_told_apart():
    hi, lo, n = np.array([7, 7, 7, 8], np.uint64), np.array([1, 2, 3, 1], np.uint64), np.array([10, 20, 30, 40])
    index = L.Index(*L.build_index(hi, lo, n, 0)[1:])
    assert index.probe(hi, lo).tolist() == [10, 20, 30, 40]
    assert index.probe(np.array([7, 9], np.uint64), np.array([4, 1], np.uint64)).tolist() == [0, 0]


def brute_lines(texts, least):
    keys = [[fold(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")] for t in texts]
    n = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for t, ks in zip(texts, keys):
        keep = [x for x, k in zip((t or "").split("\n"), ks) if n[k] < least]
        out.append((len(ks), len(ks) - len(keep), "\n".join(keep)))
    return out


def test_drop_lines_equals_brute_force(odd, odd_rows, none, monkeypatch):
    want = Counter(zip((r[0] for r in odd_rows), brute_lines([r[1] for r in odd_rows], 3)))
    for heavy in (1024, 1):  # with 1, no line is heavy and all go through the shards
        monkeypatch.setattr(L, "HEAVY", heavy)
        out = L.drop_lines(odd, min_docs=3)
        assert out.columns == [*odd.columns, "n_lines", "n_dropped"]
        assert Counter((r.doc_id, (r.n_lines, r.n_dropped, r.text)) for r in out.collect()) == want
    assert L.drop_lines(none).collect() == []


def test_drop_lines_over_many_shards(spark, odd, odd_rows):
    hits, held = L.frequent_lines(odd.select("doc_id", "text"), min_docs=2, shard_lines=8)
    keys = Counter()
    for r in odd_rows:
        keys.update({k for k in L.line_keys((r[1] or "").encode()) if k})
    found = {(r.hi & (1 << 64) - 1, r.lo & (1 << 64) - 1) for r in hits.collect()}
    own = L.Index(*held)
    for k, n in keys.items():
        pair = tuple(np.frombuffer(xxhash.xxh3_128_digest(k), ">u8").astype(np.uint64).tolist())
        heavy = own.probe(np.array(pair[:1], np.uint64), np.array(pair[1:], np.uint64))[0]
        assert (pair in found or heavy >= 2) == (n >= 2)


# -- SimHash

def brute_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(t or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, d=2):
    root = list(range(len(fps)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near_fingerprints(rng, n):
    """Chains and crowds of close words beside far ones."""
    out = [rng.getrandbits(64) for _ in range(n // 4)] + [0, (1 << 64) - 1]
    while len(out) < n:
        x = rng.choice(out[: n // 8] + out[-30:])
        for _ in range(rng.choice([1, 2, 2, 3])):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def as_classes(labels):
    groups = {}
    for x, r in labels:
        groups.setdefault(r, set()).add(x)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_gray_rank_inverts_the_code():
    x = np.arange(4096, dtype=np.uint64)
    assert (H.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


def test_links_and_components_equal_brute_force(spark):
    rng = random.Random(11)
    fps = list(dict.fromkeys(near_fingerprints(rng, 700)))
    want = as_classes(zip(fps, brute_components(fps)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for node_rows in (65_536, 4):  # with 4, crowded top nodes are refined
        got = C.components(H.links(df, task_rows=500, node_rows=node_rows)).collect()
        assert as_classes((r.node & (1 << 64) - 1, r.root) for r in got) == want


def test_tree_search_in_a_crowd():
    rng = random.Random(12)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 900:
        x = rng.choice([base, *list(fps)[:40]])
        for b in rng.sample(range(32), rng.choice([1, 2, 3, 4])):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    a = np.array(fps, np.uint64)
    key = (a & np.uint64(0xFFFFFFFF00000000)).view(np.int64)
    zero = np.zeros(len(a), np.int64)
    got = H.link_table(pa.table({"fp": a.view(np.int64), "band": zero, "key": key, "part": zero}), 2)
    labels = {x: x for x in fps}
    for x, y in zip(got["a"].to_pylist(), got["b"].to_pylist()):
        labels[x & (1 << 64) - 1] = y & (1 << 64) - 1
    assert as_classes(labels.items()) == as_classes(zip(fps, brute_components(fps)))


def test_near_components_of_odd_rows(odd, odd_rows, none):
    fps = [brute_fingerprint(r[1]) for r in odd_rows]
    groups = {}
    for r, c in zip(odd_rows, brute_components(fps)):
        groups.setdefault(c, []).append(r[0])
    least = {c: min((i for i in g if i is not None), default=None) for c, g in groups.items()}
    want = Counter((r[0], f, least[c]) for r, f, c in zip(odd_rows, fps, brute_components(fps)))
    got = H.near_components(odd).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want
    assert H.near_components(none).collect() == []
    stay = H.one_per_group(odd)
    assert stay.columns == odd.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(least.values())
    assert H.one_per_group(none).collect() == []


def test_components_of_a_long_chain(spark):
    n = 400
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in C.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert C.components(edges.limit(0)).collect() == []


# -- exact dedup

def brute_exact(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(fold(r[1] or ""), []).append(i)
    out = Counter()
    for g in groups.values():
        best = max((rows[i][0] for i in g if rows[i][0] is not None), default=None)
        kept = 0
        for i in g:
            own = rows[i][0] == best and not kept
            kept += own
            out[(rows[i][0], best, len(g), own)] += 1
    return out


def verdicts(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_exact_dedup_of_odd_rows(spark, odd, odd_rows, none, tmp_path):
    odd.repartition(5).write.parquet(str(tmp_path / "docs.parquet"))
    want = brute_exact(odd_rows)
    path = str(tmp_path / "docs.parquet")
    assert verdicts(E.dedup(spark, path)) == want
    # several batches, and a run that finds nothing new
    state = str(tmp_path / "state")
    assert verdicts(E.dedup(spark, path, state=state, files_per_batch=2)) == want
    assert verdicts(E.dedup(spark, path, state=state, files_per_batch=2)) == want
    none.write.parquet(str(tmp_path / "none.parquet"))
    assert E.dedup(spark, str(tmp_path / "none.parquet")).collect() == []


def test_digest_hits_are_checked_by_their_bytes(spark, odd, odd_rows, tmp_path):
    path = str(tmp_path / "docs.parquet")
    odd.coalesce(1).write.parquet(path)
    weak = lambda t: F.substring(F.sha2(t, 256), 1, 1)  # noqa: E731  16 digests: nearly every hit is a false one
    assert verdicts(E.dedup(spark, path, digest=weak)) == brute_exact(odd_rows)


def test_state_goes_on_with_new_files(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    cols = "doc_id long, text string"
    spark.createDataFrame([(1, "A"), (2, "b")], cols).coalesce(1).write.parquet(path)
    E.update_state(spark, path, state)
    spark.createDataFrame([(9, "a"), (3, "c")], cols).coalesce(1).write.mode("append").parquet(path)
    got = E.update_state(spark, path, state).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {(r.digest, r.stays.doc_id, r.rows) for r in got} == {(digest("a"), 9, 2), (digest("b"), 2, 1), (digest("c"), 3, 1)}
