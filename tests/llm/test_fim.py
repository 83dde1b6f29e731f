"""Fill-in-the-middle against a plain version, and the exact round trip."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import fim


def plain_fim(doc_id, text, end="\n", seed=7, markers=fim.MARKERS, percent=100, spm_percent=50):
    text = text or ""
    parts = text.split(end)
    units = [x + end for x in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    if end == "\n":
        assert units == re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = markers
    if not text or any(x in text for x in markers) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    if h4 % 100 < spm_percent:
        return n, "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return n, "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def shown(df):
    return sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect()), key=repr)


def expected(rows, **kw):
    return sorted(((r[0], *plain_fim(r[0], r[1], **kw)) for r in rows), key=repr)


AWKWARD = ["", None, "\n", "\n\n\n", "x", "x\n", "a\r\nb\rc\x0bd", "<P>", "tail <M> in\nit", "<P", "<S\n>", "ends with <S", "<\n<S",
           "é\nß\n\U0001F600\n日本", "last line\nwithout end", " \n \n", " one line"]


@pytest.fixture(scope="module")
def texts(odd_rows):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in odd_rows] + [(200 + i, t) for i, t in enumerate(AWKWARD)]
    rows += [(300 + i, "".join(rng.choice("ab<PSM>é\n") for _ in range(rng.randrange(60)))) for i in range(200)]
    return rows + [(900, "line of a very long text\n" * 120_000 + "end"), (901, "x" * 2_000_000)]


@pytest.mark.parametrize("kw", [{}, {"percent": 40, "spm_percent": 10, "seed": 3},
                                {"end": " ", "markers": ("[[pre]]", "[[suf]]", "[[mid]]")}])
def test_equals_plain_version_and_restores(spark, texts, kw):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = fim.fill_in_middle(docs, **kw)
    assert shown(out) == expected(texts, **kw)
    markers = kw.get("markers", fim.MARKERS)
    back = out.select("doc_id", fim.restore(markers=markers).alias("t")).collect()
    assert sorted(((r.doc_id, r.t) for r in back), key=repr) == sorted(((i, t or "") for i, t in texts), key=repr)


def test_all_forms_occur(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.form for r in fim.fill_in_middle(docs, percent=60).select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_odd_tables(spark, odd, none):
    clash = odd
    for c in ("n", "form", "output", "h1", "h4", "prefix_chars"):
        clash = clash.withColumn(c, F.lit("mine"))
    assert shown(fim.fill_in_middle(clash)) == shown(fim.fill_in_middle(odd))
    got = fim.fill_in_middle(none)
    assert got.collect() == [] and got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_same_under_other_partitioning(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert shown(fim.fill_in_middle(docs.repartition(7))) == shown(fim.fill_in_middle(docs.coalesce(1)))


def test_bad_markers(spark, odd):
    with pytest.raises(ValueError):
        fim.fill_in_middle(odd, markers=("<P>", "<P>", "<M>"))


def test_query_equals_sql(spark, sf):
    import duckdb

    from tessera.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.sql(ORACLE["op11_fill_in_middle"])
    want = sorted(map(repr, rel.fetchall()))
    assert sorted(repr(tuple(r)) for r in QUERIES["op11_fill_in_middle"](spark, sf).select(*rel.columns).collect()) == want
