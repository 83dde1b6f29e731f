"""Splits, ranks, dedupe, Q&A assembly, retrieval and evaluation."""

from pyspark.sql import functions as F

from tessera.operators import assemble as A
from tessera.operators import evaluate as EV
from tessera.operators import retrieve as RT
from tessera.operators import rollup as R
from tessera.operators.scale import global_rank


def test_global_rank_is_exact(spark):
    df = spark.range(0, 5000).withColumn("h", F.sha1(F.col("id").cast("string")))
    ranked = global_rank(df, ["h", "id"], n_parts=7)
    got = [r["id"] for r in ranked.orderBy("rank").collect()]
    want = [r["id"] for r in df.orderBy("h", "id").collect()]
    assert got == want
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 5001))


def test_running_totals_equal_a_loop(spark):
    """Half of the rows share one key; chunks and partitions are crossed; nulls
    pass; an empty frame stays empty."""
    import random
    from tessera.operators.scale import running
    rnd = random.Random(6)
    rows = [(rnd.choice([7, 7, rnd.randrange(20)]), i, rnd.choice([None, rnd.randrange(100)]), rnd.choice([None, rnd.randrange(-50, 50)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "t int, id int, x long, y long")
    got = {r["id"]: (r["sx"], r["my"]) for r in running(df, ["t", "id"], {"sx": "x"}, {"my": "y"}, n_parts=5, chunk_rows=64).collect()}
    sx = my = None
    for t, i, x, y in sorted(rows, key=lambda r: r[:2]):
        sx = x if sx is None else sx + (x or 0)
        my = y if my is None else (my if y is None else max(my, y))
        assert got[i] == (sx, my)
    assert running(df.limit(0), ["t", "id"], {"sx": "x"}).collect() == []


def test_running_plan_has_no_window_over_all_rows(spark):
    from tessera.operators.scale import running
    df = spark.range(0, 20_000, 1, 4).withColumn("x", F.lit(1))
    out = running(df, ["id"], {"s": "x"}, n_parts=4, chunk_rows=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one exchange of the rows for the chunks' windows; what goes to a single
    # partition is a row a partition
    assert plan.count("SinglePartition") == 1 and "windowspecdefinition(_pid" in plan
    assert [r["s"] for r in out.orderBy("id").collect()] == list(range(1, 20_001))


def test_shuffle_split_disjoint_and_sized(spark):
    df = spark.range(0, 1234).withColumnRenamed("id", "doc_id")
    s = A.shuffle_split(df, "doc_id", val_frac=0.1, seed="s")
    val = {r["doc_id"] for r in s.where("split = 'val'").collect()}
    train = {r["doc_id"] for r in s.where("split = 'train'").collect()}
    assert len(val) == 123 and not (val & train) and len(val | train) == 1234
    capped = A.shuffle_split(df, "doc_id", val_frac=0.1, max_records=100, seed="s")
    assert capped.where("split = 'train'").count() == 100


def test_qna_counts(spark):
    fn = spark.createDataFrame([("i1", "f", "a.c", "does f", "risk", ["memory"], "")],
                               "id string, name string, file_path string, summary string, risk_notes string, "
                               "intent_tags array<string>, change_recipe string")
    q = A.qna_generate(fn).collect()
    assert [r["question"] for r in sorted(q, key=lambda r: r["qn"])] == [
        "What does Function 'f' in file 'a.c' do?",
        "What are the potential risks of Function 'f' in file 'a.c'?",
        "What intent tags apply to Function 'f' in file 'a.c'?",
    ]


def test_list_parts_lose_nothing(spark):
    pairs = spark.createDataFrame([("hub", f"v{i:04d}") for i in range(1000)] + [("one", "x"), ("one", "x")], ["key", "item"])
    rows = A.list_parts(pairs, "key", "item", ",", size=64).collect()
    hub = [r for r in rows if r["key"] == "hub"]
    assert sorted(x for r in hub for x in r["item"].split(",")) == [f"v{i:04d}" for i in range(1000)]
    assert len(hub) == 16 == hub[0]["parts"] and max(len(r["item"].split(",")) for r in hub) < 128
    assert [(r["item"], r["n"], r["parts"]) for r in rows if r["key"] == "one"] == [("x,x", 2, 1)]


def test_token_windows_keep_every_token(spark):
    from tessera.functions import text as X
    texts = ["", "  ", " a  b\n", "a\n b  c\td\n\ne f ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r["i"]: r["w"] for r in df.select("i", X.token_windows(F.col("t"), 2).alias("w")).collect()}
    assert got == {0: [""], 1: ["  "], 2: [" a  b\n"], 3: ["a\n b", "c\td", "e f "], 4: [""]}
    w = A.tokenize_windows(A.tokenize_ids(F.col("t")), 4, A.tokenize_ids(F.lit("x y")))
    rows = df.where("i = 3").select(F.explode(w).alias("w")).select("w.*").collect()
    assert [(r["window"], r["start"], r["end"], sum(r["attention_mask"]), r["labels"].count(-100)) for r in rows] == [(0, 0, 4, 4, 2), (1, 4, 6, 2, 4)]


def test_dedupe_sees_whole_texts(spark):
    head = "z" * 10_000
    df = spark.createDataFrame([(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "s")], "id long, text string")
    assert sorted(r["id"] for r in R.dedupe_exact(df, "id", "text", min_chars=3).collect()) == [1, 2]


def test_knn_matches_numpy(spark):
    import numpy as np
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(300, 8)).astype(np.float32)
    q = rnd.normal(size=(4, 8))
    vec = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], ["id", "embedding"])
    qs = spark.createDataFrame([(j, [float(v) for v in row]) for j, row in enumerate(q)], ["qid", "embedding"])
    got = {(r["qid"], r["rank"]): r["id"] for r in RT.knn_l2(vec.repartition(5), qs, 3).collect()}
    d = ((x.astype(np.float64)[:, None, :] - q[None]) ** 2).sum(-1)
    for j in range(4):
        for rank, i in enumerate(np.lexsort((np.arange(300), d[:, j]))[:3], start=1):
            assert got[(j, rank)] == i
    # many rounds give the same answer
    got2 = {(r["qid"], r["rank"]): r["id"] for r in RT.knn_l2(vec, qs, 3, round_rows=1).collect()}
    assert got2 == got
    assert RT.knn_l2(vec, qs.limit(0), 3).collect() == [] and RT.knn_l2(vec.limit(0), qs, 3).collect() == []


def test_knn_and_nearest_at_many_queries(spark):
    import numpy as np
    rnd = np.random.default_rng(1)
    x, q = rnd.integers(0, 9, (200, 3)), rnd.integers(0, 9, (10_000, 3))
    vec = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], ["id", "embedding"])
    qs = spark.createDataFrame([(j, [float(v) for v in row]) for j, row in enumerate(q)], ["qid", "embedding"])
    d = ((q[:, None, :] - x[None]) ** 2).sum(-1)
    want = np.argsort(d, axis=1, kind="stable")[:, :2]
    got = {(r["qid"], r["rank"]): r["id"] for r in RT.knn_l2(vec, qs, 2).collect()}
    assert all(got[(j, r + 1)] == want[j, r] for j in range(len(q)) for r in range(2))
    near = {r["id"]: (r["center"], r["distance"]) for r in RT.assign_nearest(vec, qs.limit(5000)).collect()}
    cs = [r["qid"] for r in qs.limit(5000).collect()]
    for i in range(200):
        best = min((d[c, i], c) for c in cs)
        assert near[i] == (best[1], float(best[0]))


def test_knn_spares_pairs_and_changes_nothing(spark):
    """Clustered vectors: bounds discard most groups; ties, copies, far-off
    lengths and string ids come out as by the plain formula."""
    import numpy as np
    rnd = np.random.default_rng(2)
    hubs = rnd.normal(size=(40, 16)) * 50
    x = np.concatenate([hubs[rnd.integers(0, 40, 6000)] + rnd.normal(size=(6000, 16)) * 0.1, np.repeat(hubs[:1], 50, axis=0)])
    q = np.concatenate([hubs + 0.05, rnd.normal(size=(20, 16)) * 50, hubs[:1], [x[17]]])
    vec = spark.createDataFrame([(f"v{i:05d}", row.tolist()) for i, row in enumerate(x)], "id string, embedding array<double>")
    bad = spark.createDataFrame([("n", None), ("s", [1.0]), ("h", [None] + [0.0] * 15)], "id string, embedding array<double>")
    qs = spark.createDataFrame([(j, row.tolist()) for j, row in enumerate(q)], "qid long, embedding array<double>")
    got = {(r["qid"], r["rank"]): (r["id"], r["distance"]) for r in RT.knn_l2(vec.union(bad).repartition(3), qs, 5).collect()}
    for j, one in enumerate(q):
        d = ((x - one) ** 2).sum(1)
        order = np.lexsort((np.arange(len(x)), d))[:5]
        assert [got[(j, r + 1)][0] for r in range(5)] == [f"v{i:05d}" for i in order]
        assert np.allclose([got[(j, r + 1)][1] for r in range(5)], d[order], rtol=1e-12, atol=0)
    work = RT.knn_work(vec.repartition(3), qs, 5).first()
    assert work["pairs"] == len(x) * len(q) and work["spared"] > 0.7


def test_knn_plan_moves_no_vector(spark, monkeypatch):
    """The only exchange carries ids and distances."""
    seen = []
    monkeypatch.setattr(RT, "cut_lineage", lambda df, name="": (seen.append((name, df._jdf.queryExecution().executedPlan().toString())), df)[1])
    vec = spark.createDataFrame([(i, [float(i)]) for i in range(50)], "id long, embedding array<double>")
    out = RT.knn_l2(vec, vec.select(F.col("id").alias("qid"), "embedding").limit(3), 2)
    plans = dict(seen)
    assert "Exchange" not in plans["knn-round"] and "MapInPandas" in plans["knn-round"]
    assert "embedding" not in str(out.schema)


def test_graph_boost_finds_far_neighbours(spark):
    vec = spark.createDataFrame([(i, [float(i)]) for i in range(100)], ["id", "embedding"])
    qs = spark.createDataFrame([(0, [0.0])], ["qid", "embedding"])
    near = spark.createDataFrame([(0, 90), (0, 50), (0, 2)], ["qid", "id"])
    got = [(r["id"], r["near"]) for r in RT.retrieve_graph_boost(vec, qs, near, 5).orderBy("boost_rank").collect()]
    assert got == [(2, True), (50, True), (90, True), (0, False), (1, False)]


def test_eval_exact(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], ["prediction", "answer"])
    r = EV.eval_exact(pairs).first()
    # classes: a: tp1 pred2 sup1; b: tp1 pred1 sup3; c: tp0 pred1 sup0
    assert abs(r["accuracy"] - 0.5) < 1e-12
    assert abs(r["precision"] - (0.5 * 1 + 1.0 * 3) / 4) < 1e-12
    assert abs(r["recall"] - (1.0 * 1 + (1 / 3) * 3) / 4) < 1e-12


def test_bleu_identical_is_one(spark):
    pairs = spark.createDataFrame([("p1", "the cat sat on the mat", "the cat sat on the mat")],
                                  ["pair_id", "candidate", "reference"])
    r = EV.corpus_bleu(pairs).first()
    assert abs(r["bleu"] - 1.0) < 1e-12


def test_iec_bytes(spark):
    rows = spark.createDataFrame([(5,), (1536,), (10240,), (10500,), (3 * 1024 ** 3,)], ["b"]) \
        .select(R.iec_bytes(F.col("b")).alias("h")).collect()
    assert [r["h"] for r in rows] == ["5B", "1.5KB", "10KB", "11KB", "3.0GB"]
