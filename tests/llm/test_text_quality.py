import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import licenses as Lc
from tessera.llm import quality as Q
from tessera.llm import toxicity as T

# -- toxicity


def run_machine(symbols):
    state, out = T.MACHINE.start, []
    for s in symbols:
        state, o = T.MACHINE.step(state, s)
        out.append(o)
    return out


def test_grammar_composes_its_transducers():
    assert run_machine("OIO") == ["O", "I", "O"]
    assert run_machine("NOI")[-1] == "In"
    assert run_machine("NOOOI")[-1] == "I"  # out of the scope
    assert run_machine("YOI")[-1] == "It"
    assert run_machine("RYNT")[-1] == "Tnrt"
    assert run_machine("NBI")[-1] == "I" and run_machine("YBI")[-1] == "I"  # a clause's end forgets
    rng = random.Random(3)
    neg, rep, aim = T._negation(), T._marker("R", "r", ["I", "T", "In", "Tn"]), T._marker("Y", "t", T.PATTERNS)
    for _ in range(300):  # the composed machine is the three in a row
        states, word = [0, 0, 0], [rng.choice("OITYNRB") for _ in range(12)]
        want = []
        for s in word:
            for i, m in enumerate((neg, rep, aim)):
                states[i], s = m.step(states[i], s)
            want.append(s)
        assert run_machine(word) == want


def test_features_by_clause():
    lexicon = T.Lexicon({"zork": ("I", 3.0)})
    x = T.features(lexicon, pa.array(["you are an idiot. a table", "you said. an idiot", "not an idiot", None, "", "Zorkish!\nZORKED???", "clean words only"]))
    col = {p: i for i, p in enumerate(T.PATTERNS)}
    one = math.log1p(1.0)
    assert x[0][col["It"]] == x[1][col["I"]] == x[2][col["In"]] == one
    assert (x[3] == 0).all() and (x[4] == 0).all() and (x[6] == 0).all()
    assert np.allclose([x[5][col["I"]], x[5][-2], x[5][-3]], np.log1p([6, 2, 1]))


@pytest.mark.parametrize("text, pattern", [
    ("I will kill you", "Tt"), ("you idiot", "It"), ("idiot, you are", "It"), ("he is an idiot, she said", "Ir"), ("she said he is an idiot", "Ir"),
    ("I will not kill you, he wrote", "Tnrt"), ("ich werde dich töten", "Tt"), ("an idiot. you are right", "I"), ("not an idiot", "In")])
def test_targets_and_speech_on_both_sides(text, pattern):
    x = T.features(T.Lexicon({}), pa.array([text]))[0]
    assert [p for p, v in zip(T.PATTERNS, x) if v] == [pattern]


def plain_score(text, stems, weights):
    """The score by its definition, without machines: a clause's insults and threats are
    reported or aimed if it has a speech verb or a target anywhere, negated if one of the three words before them says so."""
    lists = {w: k for k, ws in T.TERMS.items() for w in ws}
    marks = {w for w, k in lists.items() if k in "YNR"}
    x, terms, hits, clauses, n_words = Counter(), set(), 0, 0, 0
    clause = []
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").replace("\n", " . "))
    for i, word in enumerate(tokens):
        n_words += 1
        w = word.lower().strip(T._TRIM)
        found = [s for s in stems if w not in marks and (w == s[:-1] if s.endswith("$") else w.startswith(s))]
        best = max(found, key=len, default=None)
        clause.append((*stems[best], best) if best else (lists.get(w, "O"), 1.0, w))
        if word[-1] in ".!?;:" or i == len(tokens) - 1:
            kinds = [c[0] for c in clause]
            clauses += any(k in "IT" for k in kinds)
            for at, (k, weight, term) in enumerate(clause):
                if k in "IT":
                    p = k + "n" * ("N" in kinds[max(0, at - 3):at]) + "r" * ("R" in kinds) + "t" * ("Y" in kinds)
                    x[p] += weight
                    terms.add(term)
                    hits += 1
            clause = []
    v = [math.log1p(x[p]) for p in T.PATTERNS] + [math.log1p(len(terms)), math.log1p(clauses), 10 * hits / max(1, n_words)]
    return 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(v, weights)) + weights[-1]))))


def test_score_equals_plain_scorer(spark, odd, odd_rows):
    rng = random.Random(8)
    weights = np.array([rng.uniform(-1, 2) for _ in range(T.N_FEATURES + 1)])
    stems = {"that": ("I", 0.5), "ofhe": ("T", 1.5), "la$": ("T", 0.7), "inst": ("I", 2.0)}
    bits = "idiot kill you not said der said. you? never! la verheit thatx hello töten".split()
    more = [(1000 + k, " ".join(rng.choices(bits, k=rng.randint(1, 40)))) for k in range(80)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter((r.doc_id, round(r.score, 9)) for r in T.score(docs, T.Model(stems, weights)).collect())
    assert got == Counter((i, round(plain_score(t, stems, weights), 9)) for i, t in [r[:2] for r in odd_rows] + more)


def test_stems_are_learned_by_tag_without_a_cap(spark):
    rng = random.Random(6)
    letters = "bcdfghklmnprstvz"
    insults, threats = ([a + v + b + c for a in letters[i::2] for v in "ae" for b in letters[:12] for c in "ox"] for i in (0, 1))
    rows = []
    for i in range(2400):
        words = [f"w{rng.randrange(60):02d}word" for _ in range(30)]
        if i % 2:
            for k in range(16):
                words += ["you", "w01word", rng.choice(insults) + "."] if k % 2 else ["w02word", rng.choice(threats), "you."]
        rows.append((f"{' '.join(words)} {'zq' if i % 2 else 'ok'}", i % 2))
    stems = T.learn_stems(spark.createDataFrame(rows, "text string, toxic int"))
    assert sum(x in stems for x in insults) > 0.95 * len(insults) and sum(x in stems for x in threats) > 0.95 * len(threats)
    assert all(stems[x][0] == "I" for x in insults if x in stems) and all(stems[x][0] == "T" for x in threats if x in stems)
    assert "zq$" in stems


def test_learns_and_scores_held_out_rows(spark):
    rng = random.Random(5)
    plain = [f"w{i:03d}word" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 2
        words = rng.choices(plain, k=60)
        if toxic:
            for k in rng.sample(range(60), 4):
                words[k] = f"grobz{rng.choice('abcdefgh')}{k}"
        rows.append((i, " ".join(words), "lang", "source", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(None, None, None, None, None), (5000, "", "en", "s", 0), (5001, "you idiot", "en", "s", 0), (7, rows[7][1], "en", "s", 1)]
    labels += [(7, None, None), (None, 1, 1), (8, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.learn(docs, table)
    assert any(s.startswith("grobz"[:len(s)]) for s in model.stems) and len(model.stems) < 40
    got = T.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels if i is not None}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(p == t for p, t in held) >= 0.98 * len(held)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    # the other columns and the held-out labels don't matter
    flipped = spark.createDataFrame([(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels], table.schema)
    again = T.learn(docs, flipped)
    assert again.stems == model.stems and np.allclose(again.weights, model.weights)


def test_no_labels_and_no_rows(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = T.learn(odd, empty)
    assert len(T.score(odd, model).collect()) == odd.count() and T.score(none, model).collect() == []
    one = spark.createDataFrame([(1, "you stupid idiot"), (2, "a fine day")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in T.score(one, model).collect()} == {1: 1, 2: 0}


# -- quality

def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k:k + 8])].append(k)
    cover = {i for ks in at.values() if len(ks) > 1 for k in ks for i in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_base_rules_equal_brute_force(spark, odd, odd_rows):
    want = Counter()
    for r in odd_rows:
        b = brute_base(r[1])
        want[(r[0], *b, b[0] < 20 or 100 * b[4] > 30 * b[0])] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in Q.judge(odd).collect()) == want


def test_bands_reject_other_text_and_keep_the_rest(spark):
    rng = random.Random(9)
    syllables = "ba lo ki mer tan su".split()
    rows = [(i, " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.choice([25, 60, 200]))), "xx") for i in range(300)]
    rows += [(1000, " ".join("".join(rng.choices("qxzjvwy#%", k=7)) for _ in range(60)), "xx"), (1001, " ".join(f"ba{'ba' * (k % 2)} lo" for k in range(60)), "xx")]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[1000] and sum(got[i] for i in range(300)) >= 297


def test_quality_of_no_rows(none):
    assert Q.judge(none).collect() == []


# -- licences

def test_scan_equals_sql(spark, odd):
    from tessera.llm.queries import ORACLE
    mit = Lc.TEMPLATES["MIT"]
    rows = [(1, mit, "a"), (2, "words before\n\n" + mit + "\n\nwords after", "b"), (3, "released under the MIT license!", "c"),
            (4, None, "d"), (5, "", "e"), (6, "mit", "f"), (7, mit.replace("Software", "Program").replace("free", "gratis"), "g"),
            (8, mit.split("THE SOFTWARE IS")[0], "h"), (3, "Released  under the MIT License.\n\n \t\nx y", "c"), (None, "Licensed under CC BY 4.0", "i"),
            (9, " ".join(["Released under the MIT License."] * 40), "j"), (10, "\n".join(mit.split(". ")), "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string").unionByName(odd.selectExpr("doc_id", "text", "lang as license"))
    got = sorted(map(tuple, Lc.scan(docs).collect()), key=repr)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    cols = "doc_id, license, dice, unit, place"
    want = sorted(con.sql(f"SELECT {cols} FROM ({ORACLE['op10_license_scan']})").fetchall(), key=repr)
    assert got == want
    hits = {(r[0], r[1]) for r in got}
    assert {(1, "MIT"), (2, "MIT"), (3, "MIT line"), (7, "MIT"), (9, "MIT line"), (10, "MIT")} <= hits and not any(h[0] in (4, 5, 6, 8) for h in hits)


def test_size_bounds_lose_nothing():
    for n in range(1, 60):
        low, high = Lc.size_bounds(n, 0.8)
        for m in range(1, 200):
            best = 2 * min(n, m) / (n + m)
            assert (low <= m <= high) == (best >= 0.8)


def test_licenses_of_no_rows(none):
    assert Lc.scan(none).collect() == []
