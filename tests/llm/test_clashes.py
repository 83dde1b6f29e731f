"""Extra columns with names that operators might use themselves: every stage
that passes columns on returns them unchanged and keeps the same rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP

NAMES = ["score", "predicted", "held_out", "_score", "_id", "_hash", "_own", "_times", "_ld_drop", "_ld_id", "n_lines", "n_dropped", "_text",
         "row", "here", "own", "rest", "drop", "told_id", "stays_id", "times", "rows", "turn", "k", "x.y", "with `tick`", "first", "fp"]


@pytest.fixture(scope="module")
def pair(odd):
    """The odd table without further columns, and with all of these."""
    slim = odd.select("doc_id", "text", "lang", "source", "n_chars")
    wide = slim.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES])
    return slim, wide


def same(wide, got, plain):
    assert got.columns == wide.columns
    rows = got.collect()
    for r in rows:
        for n in NAMES:
            assert r[n] == f"{n}:{'none' if r['doc_id'] is None else r['doc_id']}"
    key = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    assert Counter(map(key, rows)) == Counter(map(key, plain.collect()))


@pytest.mark.parametrize("name", [name for name, _ in CP.STAGES[:-1]])
def test_stage_returns_clashing_columns_unchanged(spark, sf, pair, name):
    slim, wide = pair
    step = dict(CP.STAGES)[name]
    same(wide, step(spark, wide, sf), step(spark, slim, sf))


def test_packing_and_empty_tables(spark, sf, pair, none):
    slim, wide = pair
    pack = CP.STAGES[-1][1]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    a, b = (Counter(tuple(r[c] for c in cols) for r in pack(spark, d, sf).collect()) for d in pair)
    assert a == b
    for _, step in CP.STAGES[:-1]:
        got = step(spark, wide.limit(0), sf)
        assert got.columns == wide.columns and got.collect() == []


def test_counts_replace_columns_of_their_name_only(spark, pair):
    from tessera.llm.line_dedup import drop_lines
    _, wide = pair
    got = drop_lines(wide)
    assert got.columns == [c for c in wide.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    assert got.where("n_lines < 1 OR n_dropped < 0").isEmpty()


def test_rows_that_agree_but_for_other_columns_rerun_alike(spark):
    rows = [(1, "a b c d e f", "s", x) for x in "zyxwv"] + [(2, "g h i", "s", "q")]
    runs = []
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tag string").repartition(parts, "tag")
        mixed = CP.mixing.mixed_documents(docs, share=0.5)
        alone = CP.simhash.one_per_group(docs)
        runs.append([sorted(map(tuple, d.collect())) for d in (mixed, alone)])
    assert runs[0] == runs[1] and len(runs[0][1]) == 2
