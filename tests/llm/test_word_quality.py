import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string"
END, UNKNOWN = ("end",), ("unknown",)


def brute_kn(counts):
    """Interpolated modified Kneser-Ney of pairs over continuation counts, by its textbook definition."""
    t = Counter(counts.values())
    y = t[1] / (t[1] + 2 * t[2]) if t[1] + t[2] else 0
    d = []
    for j in (1, 2, 3):
        x = j - (j + 1) * y * t[j + 1] / t[j] if t[j] and t[1] + t[2] else None
        d.append(x if x is not None and 0 < x < j else j / 2)
    total, back, before = Counter(), Counter(), Counter()
    for (v, w), n in counts.items():
        total[v] += n
        back[v] += d[min(n, 3) - 1]
        before[w] += 1
    return {(v, w): max(n - d[min(n, 3) - 1], 0) / total[v] + back[v] / total[v] * before[w] / len(counts) for (v, w), n in counts.items()}


def brute_losses(rows):
    seqs = [(lang, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, lang in rows]
    single, letters = Counter(), Counter()
    for lang, words in seqs:
        single.update((lang, w) for w in words)
        for w in words:
            b = [256, *w.encode(), 256]
            letters.update(zip(b, b[1:]))
    places = sum(single.values()) + sum(bool(w) for _, w in seqs)
    known = {k for k, n in single.items() if n >= Q.MIN_COUNT and n * Q.SHARE > places}
    ends = Counter(lang for lang, w in seqs if w)
    own = {lang for lang, _ in known} | {lang for lang, n in ends.items() if n >= Q.MIN_COUNT and n * Q.SHARE > places}
    spell = brute_kn(letters)
    coded = [(lang if lang in own else "others", [END, *(w if (lang, w) in known else UNKNOWN for w in words), END]) for lang, words in seqs]
    grams = defaultdict(set)
    for lang, s in coded:
        if len(s) > 2:
            grams[lang].update(zip([END, *s], s, s[1:]))
    models = {lang: brute_kn(Counter(g[1:] for g in c)) for lang, c in grams.items()}  # distinct words before a pair
    out = []
    for (_, words), (lang, s) in zip(seqs, coded):
        total = sum(math.log(models[lang][p]) for p in zip(s, s[1:])) if words else 0
        for w, c in zip(words, s[1:]):
            if c == UNKNOWN:
                b = [256, *w.encode(), 256]
                total += sum(math.log(spell[p]) for p in zip(b, b[1:]))
        out.append(-total / (sum(map(len, words)) + len(words) + 1) if words else None)
    return out


@pytest.mark.parametrize("share, shard_places, flush", [(1 << 17, 4_000, 500), (300, 10_000, 10**6)])
def test_losses_and_verdicts_equal_brute_force(spark, odd, odd_rows, monkeypatch, share, shard_places, flush):
    monkeypatch.setattr(Q.losses, "__defaults__", (shard_places,))  # several shards
    monkeypatch.setattr(Q, "SHARE", share)
    monkeypatch.setattr(Q, "COUNT_ROWS", 30)
    monkeypatch.setattr(Q, "_FLUSH", flush)
    got = Q.judge(odd).collect()
    key = lambda i, lang, n, x: (str(i), str(lang), n, None if x is None else round(x, 5))
    want = [key(r[0], r[2], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), x)
            for r, x in zip(odd_rows, brute_losses([r[:3] for r in odd_rows]))]
    assert Counter(key(r.doc_id, r.lang, r.n_words, r.loss) for r in got) == Counter(want)
    # the bands, from a language's good documents; the upper spread by the root of the length
    for lang in {r.lang for r in got}:
        good = [r for r in got if r.lang == lang and r.loss is not None and not r.base_failed]
        rank = lambda xs, p: sorted(xs)[math.ceil(len(xs) * p) - 1]
        for r in (r for r in got if r.lang == lang):
            if not good:
                assert r.low is None and r.kept == (not r.base_failed)
                continue
            middle = math.floor(rank([g.loss for g in good], 0.5) / 1e-4) * 1e-4
            off = [math.floor((g.loss - middle) * math.sqrt(g.found) / 1e-2) * 1e-2 for g in good]
            spread = max((rank(off, 0.75) - rank(off, 0.25)) / 1.349, 1e-2)
            if r.loss is not None:
                low, high = middle * Q.LOW, middle + Q.ABOVE * spread / math.sqrt(r.found)
                assert abs(r.low - low) < 2e-3 and abs(r.high - high) < 2e-3
            assert r.kept == (not r.base_failed and (r.loss is None or r.low <= r.loss <= r.high))


def test_arrays_round_trip():
    rng = np.random.default_rng(3)
    for x in (np.zeros(0, np.uint64), np.zeros(4, np.uint64), rng.integers(0, 2**63, 100).astype(np.uint64), np.array([2**64 - 1], np.uint64)):
        assert (Q._unpack(Q._pack(x)) == x).all()
        x = np.sort(x)
        assert (np.cumsum(Q._unpack(Q._pack(Q._rising(x))), dtype=np.uint64) == x).all()


def test_probabilities_add_up():
    rng = np.random.default_rng(4)
    counts = np.zeros((257, 257))
    for _ in range(2000):
        counts[rng.integers(0, 9), rng.integers(0, 12)] += rng.integers(1, 3)
    p = np.exp(Q.spelling(counts))
    assert (p.sum(1)[:9] <= 1 + 1e-9).all() and (p.sum(1)[:9] > 0.9).all()


def corpus(n=400):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):  # each word is followed by one of three
        words = [rng.choice(vocabulary)]
        for _ in range(119):
            words.append(vocabulary[(7 * vocabulary.index(words[-1]) + rng.randrange(3)) % 60])
        rows.append((i, " ".join(words), "xx"))
    return rng, rows


def test_word_order_and_noise_count(spark):
    rng, rows = corpus()
    mixed = rows[0][1].split()
    rng.shuffle(mixed)
    noisy = [(2000 + k, " ".join(f"{rng.randrange(10**6)}%%%" for _ in range(120)), "xx") for k in range(20)]
    rows += [(1000, " ".join(mixed), "xx"), *noisy]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1000].loss > 1.2 * got[0].loss
    assert not got[1000].kept and got[0].kept and not any(got[i].kept for i, *_ in noisy)


def test_limits_reject_mild_noise_and_keep_near_copies(spark):
    rng, rows = corpus()
    mild = []
    for k in range(20):  # every fifth word is noise
        words = rows[k][1].split()[::-1] if k % 2 else rng.sample(rows[k][1].split(), 120)
        mild.append((2000 + k, " ".join(f"{w}$$${rng.randrange(999)}" if i % 5 == 0 else w for i, w in enumerate(words)), "xx"))
    base = [(3000 + k, " ".join(f"u{k}v{i}" for i in range(120)), "yy") for k in range(40)]
    near = [(4000 + k, base[k][1].replace(f"u{k}v60", "other"), "yy") for k in range(4)]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows + mild + base + near, SCHEMA)).collect()}
    assert not any(got[i].kept for i, *_ in mild)
    assert sum(got[i].kept for i, *_ in rows) >= 0.98 * len(rows)
    assert all(got[i].kept for i, *_ in near)


def test_many_copies_stay_inside_the_bands(spark):
    rng, rows = corpus()
    copies = [(5000 + k, rows[7 + k % 2][1] + " w1 w2" * (k % 3), "xx") for k in range(600)]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows + copies, SCHEMA)).collect()}
    assert all(got[i].kept for i, *_ in copies) and got[5000].loss == got[7].loss


def test_words_of_no_rows(none):
    assert Q.losses(none.select("doc_id", "text", "lang")).collect() == []


def test_exchange_of_pairs_is_shared(spark, odd):
    """The pairs are sent once, for the totals and for the sums."""
    Q.arrow_limits(spark)
    df = Q.losses(odd.select("doc_id", "text", "lang"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1


def test_only_bounded_arrays_pass_the_driver(spark, odd, monkeypatch):
    sent = []
    put = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: sent.append(x) or put(self, x))
    from tessera.llm.queries import QUERIES
    monkeypatch.setattr("tessera.llm.queries.documents", lambda *_: odd)
    assert QUERIES["op6_quality_ngram"](spark, "").count() == odd.count()
    vocabulary, spell = sent
    assert len(vocabulary.words) < Q.SHARE + 2 * len(vocabulary.langs) and spell.shape == (257, 257)
