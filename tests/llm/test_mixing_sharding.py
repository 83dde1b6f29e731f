import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.llm import mixing as M
from tessera.llm import sharding as S


def wanted(sizes):
    """Targets by the contract's words."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, shut = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in shut]
        left = total - sum(2 * sizes[s] for s in shut)
        t = {s: 2.0 * sizes[s] if s in shut else left * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if t[s] > 2 * sizes[s]}
        if not over:
            return t
        shut |= over


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_and_taken(odd, odd_rows):
    rows = M.taken(*M.mix(odd, block=16)).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((r[0], r[3], n_words(r[1])) for r in odd_rows)
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += n_words(r[1])
    want, taken = wanted(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_spans_tile_the_slots_and_reruns_agree(odd):
    placed, spans = M.mix(odd, block=16)
    rows = spans.collect()
    assert sorted(rows, key=repr) == sorted(M.mix(odd, block=16)[1].collect(), key=repr)
    by = defaultdict(list)
    for r in rows:
        by[r.slot].append(r)
        assert 0 <= r.skip and r.skip + r.words <= r.size
    assert all(len({(r.source, r.epoch, r.block) for r in rs}) == 1 and sum(r.words for r in rs) <= 16 for rs in by.values())
    # low discrepancy: while every source is open, each prefix of slots holds its share
    want = {r.source: r.target for r in placed.select("source", "target").distinct().collect()}
    firsts = sorted(((k, rs[0].source) for k, rs in by.items()), key=lambda x: x[0])[:32]
    seen = Counter(s for _, s in firsts)
    for s, t in want.items():
        assert abs(seen[s] - len(firsts) * t / sum(want.values())) <= 6


def test_mixed_rows_follow_the_targets(odd):
    out = M.mixed_documents(odd, block=16)
    assert out.columns == odd.columns
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    for r in M.mix(odd, block=16)[0].select("source", "target").distinct().collect():
        longest = 30_000 if r.source == "a" else 400
        assert abs(got.get(r.source, 0) - r.target) <= longest
    key = lambda c: tuple(c[:5])
    assert max(Counter(map(key, out.collect())).values()) <= 4  # a repeated row twice, two epochs each


def test_no_words_and_no_rows(spark, odd, none):
    blank = odd.filter("coalesce(trim(text), '') = ''").withColumn("text", F.lit(" "))
    rows = M.taken(*M.mix(blank)).collect()
    assert rows and all(r.taken == 0 and r.target == 0 for r in rows)
    assert M.taken(*M.mix(none)).collect() == []


def test_differencing_beats_greedy_and_keeps_sums():
    rng = random.Random(4)
    for k in (2, 5, 24):
        sizes = sorted((rng.randint(1, 5000) for _ in range(300)), reverse=True)
        places = S.difference([[s] + [0] * (k - 1) for s in sizes])
        sums = [0] * k
        for s, p in zip(sizes, places):
            assert sorted(p) == list(range(k))
            sums[p[0]] += s
        assert sum(sums) == sum(sizes) and max(sums) - min(sums) <= 40


def test_levels_agree_with_their_sums(spark):
    rng = random.Random(5)
    groups = spark.createDataFrame([(f"g{i}", rng.randint(1, 9999)) for i in range(900)], "digest string, bytes long")
    rows = S.assign(groups, k=6, chunk=20).collect()  # several levels
    assert len({r.digest for r in rows}) == len(rows) == 900
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.bytes
    assert max(sums.values()) - min(sums.values()) <= 60


def test_shards_of_odd_rows(odd, odd_rows, none):
    rows = S.shard_documents(odd).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[(r.text_crc32, r["size"])].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in groups.values())
    assert S.shard_documents(none).collect() == []
