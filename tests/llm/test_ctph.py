"""Document fingerprints: the vectorised rolling hash against a byte loop, the
likeness against a plain edit distance, and `edits` against plain Python."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ctph

M32 = (1 << 32) - 1


def slow_fingerprint(text):
    """The same definition, one byte at a time."""
    data = text.encode()
    byte = [(((i + 1) * 0x9E3779B97F4A7C15) % (1 << 64)) >> 32 for i in range(256)]
    step = 0x2545F491
    marks = []
    for i in range(len(data)):
        y = 0
        for k in range(8):  # the oldest byte of the window has the highest power
            if i - k >= 0:
                y += byte[data[i - k]] * pow(step, k, 1 << 32)
        y &= M32
        y ^= y >> 15
        y = y * 0x9E3779B1 & M32
        marks.append(y ^ y >> 13)
    bits = 2
    while bits < 32 and sum(x < 1 << 32 - bits for x in marks) > 64:
        bits += 1
    out = [str(1 << bits)]
    for k in range(3):
        sig, start = "", 0
        limit = 1 << max(0, 32 - bits - k)
        for end in [i + 1 for i, x in enumerate(marks) if x < limit] + [len(data)]:
            if end > start:
                x = zlib.crc32(data[start:end])
                x = (x ^ x >> 16) * 0x9E3779B1 >> 12
                sig += ctph.DIGITS[x >> 6 & 63] + ctph.DIGITS[x & 63]
                start = end
        out.append(sig)
    return ":".join(out)


def slow_likeness(a, b):
    (x, *xs), (y, *ys) = a.split(":"), b.split(":")
    shared = sorted({int(x) << k for k in range(3)} & {int(y) << k for k in range(3)})
    if a == b:
        return 1.0
    if not shared:
        return 0.0
    pick = lambda n, s: s[(shared[0] // int(n)).bit_length() - 1]
    p, q = pick(x, xs), pick(y, ys)
    p, q = [p[i:i + 2] for i in range(0, len(p), 2)], [q[i:i + 2] for i in range(0, len(q), 2)]
    if not p or not q:
        return 0.0
    row = list(range(len(q) + 1))
    for i, c in enumerate(p, 1):
        old, row = row, [i]
        for j, d in enumerate(q, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (0 if c == d else 2)))
    return 1 - row[-1] / (len(p) + len(q))


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "béta", "gamma\n", "delta,", "of", "the", "1984", "日本"]) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(5)
    return ["", "x", "ab" * 5, "a" * 3000, "ab " * 2000, "\x00\n", *[prose(rng, n) for n in (1, 2, 5, 20, 60, 200, 700)]]


def test_fingerprint_equals_byte_loop(samples):
    for t in samples:
        assert ctph.fingerprint(t) == slow_fingerprint(t)
    assert ctph.fingerprint(None) == ctph.fingerprint("")


def test_blocks_do_not_matter(samples, monkeypatch):
    rng = random.Random(1)
    texts = [*samples, prose(rng, 60_000), "z" * 900_000, "line one\n" * 90_000]
    whole = [ctph.fingerprint(t) for t in texts]
    monkeypatch.setattr(ctph, "BLOCK", 1000)
    assert [ctph.fingerprint(t) for t in texts] == whole
    assert all(len(f.split(":")[1]) <= 2 * (ctph.CHUNKS + 1) for f in whole)


def test_likeness_is_an_edit_distance(samples):
    rng = random.Random(2)
    long = prose(rng, 900)
    texts = [*samples, long, long[:2500] + long[2600:], "new start " + long, long[:len(long) // 2], long + long[::-1]]
    marks = [ctph.fingerprint(t) for t in texts]
    for a in marks:
        for b in marks:
            assert ctph.likeness(a, b) == pytest.approx(slow_likeness(a, b), abs=1e-12)
            assert ctph.likeness(a, b) == ctph.likeness(b, a) and 0 <= ctph.likeness(a, b) <= 1
    assert ctph.likeness(None, marks[0]) is None


def test_likeness_follows_the_shared_share():
    rng = random.Random(4)
    near, far = [], []
    for _ in range(200):
        a, b = prose(rng, 150), prose(rng, 150)
        near.append(ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(a[:len(a) // 2] + b[:len(a) // 2])))
        far.append(ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(b)))
    assert 0.4 < np.mean(near) < 0.6 and max(far) < 0.25 and min(near) > max(far)


def plain_edits(rows):
    """rows in order -> what `edits` returns."""
    out = []
    for i, (doc, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        mark, edited_mark = ctph.fingerprint(text), ctph.fingerprint(edited)
        out.append((doc, len(text), edited, mark, edited_mark, ctph.likeness(mark, edited_mark),
                    ctph.likeness(mark, ctph.fingerprint(nxt))))
    return sorted(map(repr, out))


def in_order(spark, rows):
    """Ids falling, nulls last, then Spark's hash of the text."""
    ties = [r[0] for r in spark.createDataFrame([(i, t or "") for i, (_, t) in enumerate(rows)], "i int, t string")
            .select(F.xxhash64("t")).collect()]
    keyed = [(doc is None, -(doc or 0), tie, text or "", doc) for (doc, text), tie in zip(rows, ties)]
    return [(doc, text) for _, _, _, text, doc in sorted(keyed, key=lambda x: x[:3])]


def shown(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_edits_equal_plain_version(spark, odd, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert shown(ctph.edits(odd)) == plain_edits(in_order(spark, rows))


def test_edits_over_many_cells_and_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(ctph, "CELL_ROWS", 7)
    rng = random.Random(9)
    rows = [(rng.randrange(-400, 400) * 10 ** 15, prose(rng, rng.randrange(30))) for _ in range(200)]
    rows += [(77, prose(rng, 4)) for _ in range(150)] + [(None, prose(rng, 4)) for _ in range(40)] + [(78, "same")] * 60
    got = ctph.edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert shown(got) == plain_edits(in_order(spark, rows))


def test_hot_id_is_split(spark, monkeypatch):
    monkeypatch.setattr(ctph, "CELL_ROWS", 10)
    docs = spark.createDataFrame([(5, f"text {i}") for i in range(400)] + [(i, "t") for i in range(400)], "doc_id long, text string")
    cells = ctph._cells(docs.withColumn("tie", F.xxhash64("text"))).groupBy("_cell").count().collect()
    assert max(r["count"] for r in cells) < 60


@pytest.mark.parametrize("rows", [[(1, "only one")], [(None, None)], [(None, "a b c d"), (None, "e f g h")], [(3, ""), (2, None)]])
def test_edits_of_few_rows(spark, rows):
    got = ctph.edits(spark.createDataFrame(rows, "doc_id long, text string"))
    assert shown(got) == plain_edits(in_order(spark, rows))


def test_clashing_names_and_empty_tables(spark, odd, none):
    clash = odd
    for c in ("_cell", "_guest", "tie", "_to", "_id", "_bucket", "_d", "n_chars", "edited", "fingerprint"):
        clash = clash.withColumn(c, F.lit("mine"))
    assert shown(ctph.edits(clash)) == shown(ctph.edits(odd))
    assert ctph.edits(none).collect() == [] and ctph.edits(none).columns == ctph.NAMES
    assert ctph.fingerprints(none).collect() == []


def test_fingerprints_and_compare(spark, odd, odd_rows):
    got = ctph.fingerprints(odd)
    assert shown(got) == sorted(repr((r[0], len(r[1] or ""), ctph.fingerprint(r[1]))) for r in odd_rows)
    pairs = got.withColumn("other", F.lit(ctph.fingerprint(odd_rows[3][1])))
    for r in ctph.compare(pairs, "fingerprint", "other").collect():
        assert r.likeness == ctph.likeness(r.fingerprint, r.other)
