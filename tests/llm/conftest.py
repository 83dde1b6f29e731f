"""Small tables with the awkward cases: nulls in any column, empty and blank
texts, a very long text, ties, repeated rows, and further columns whose names
clash with the operators' own."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, `_b` long, piece string, row int"


def words(rng, n):
    return [rng.choice("der the of and la que ver on in heit stra quo men".split()) + rng.choice(["", "a", "en", "ß", "é"]) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(7)
    rows = []
    for i in range(60):
        n = rng.choice([1, 2, 3, 8, 30, 90])
        text = "\n".join(" ".join(words(rng, n)) for _ in range(rng.choice([1, 2, 4])))
        if i % 3 == 0:
            text += "\n  Subscribe NOW to the letter. \t"
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["b", "a", "ä", None, "c"]), len(text)))
    base = rows[3][1]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\r\n ", "en", "a", 5), (None, base, "en", "b", None),
             (103, base, "de", "c", 1), (103, base, "de", "c", 1), (104, base.upper(), "de", None, 1), (-5, "x", "fr", "z", 1),
             (105, " ".join(words(rng, 30_000)), "en", "a", None), (None, None, None, None, None)]
    return [(*r, 1, 2, 3, "clash", 4) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
