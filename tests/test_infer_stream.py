"""Inference plumbing with failing models, and incremental streaming runs."""

import os

import pytest
from pyspark.sql import types as T

from tessera.operators import infer as I
from tessera import session
from tessera.session import scratch_path
from tessera.sources import io as IO
from tessera.streaming import incremental as ST


def test_generate_halves_on_oom_and_retries():
    calls = []

    def predict(batch):
        calls.append(len(batch))
        if len(batch) > 4:
            raise RuntimeError("CUDA out of memory")
        if batch[0] == "flaky" and calls.count(len(batch)) < 2:
            raise RuntimeError("transient")
        if batch[0] == "bad":
            raise RuntimeError("always")
        return [p.upper() for p in batch]

    prompts = [f"p{i}" for i in range(10)]
    outs, failed, _ = I.generate(predict, prompts, batch_size=16, retries=2, sleep=lambda s: None)
    assert outs == [p.upper() for p in prompts] and not any(failed)
    assert calls[0] == 16 or calls[0] == 10   # first try at full size, then halved to 4
    outs, failed, _ = I.generate(predict, ["bad", "x"], batch_size=1, retries=2, sleep=lambda s: None)
    assert outs == [None, "X"] and failed == [True, False]


def test_infer_batched_end_to_end(spark):
    df = spark.createDataFrame([(i, f"prompt {i}") for i in range(50)], ["id", "prompt"]).repartition(3)
    out = I.infer_batched(df, "prompt", batch_size=7).collect()
    assert len(out) == 50 and all(r["output"].startswith('{"summary": "stub summary') for r in out)


def test_incremental_enrich_processes_each_id_once(spark):
    base = scratch_path(spark, "test-incr")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])
    spark.createDataFrame([(str(i), i) for i in range(10)], schema).write.json(os.path.join(src, "a"))
    ST.incremental_enrich(spark, src + "/*", schema, out, ck)
    first = ST.read_output(spark, out).count()
    # second drop repeats ids 5..9 and adds 10..14
    spark.createDataFrame([(str(i), i) for i in range(5, 15)], schema).write.json(os.path.join(src, "b"))
    ST.incremental_enrich(spark, src + "/*", schema, out, ck)
    res = ST.read_output(spark, out)
    assert first == 10
    assert res.count() == 15 and res.select("id").distinct().count() == 15
    # a third run with nothing new adds nothing
    ST.incremental_enrich(spark, src + "/*", schema, out, ck)
    assert ST.read_output(spark, out).count() == 15


def test_changed_files(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], ["file_path", "sha256"])
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], ["file_path", "sha256"])
    got = {(r["file_path"], r["status"]) for r in ST.changed_files(old, new).collect()}
    assert got == {("a", "unchanged"), ("b", "changed"), ("c", "deleted"), ("d", "new")}


def test_wrong_length_and_single_prompt_fallback():
    def short(batch):  # drops the answer to "bad"
        return [p.upper() for p in batch if p != "bad"]
    outs, failed, _ = I.generate(short, ["a", "bad", "c"], batch_size=3, retries=1, sleep=lambda s: None)
    assert outs == ["A", None, "C"] and failed == [False, True, False]


def test_two_factories_of_one_function(spark):
    def make(word):
        def factory():
            return lambda prompts: [word] * len(prompts)
        return factory
    df = spark.createDataFrame([(1, "x")], "id long, prompt string").coalesce(1)
    got = [I.infer_batched(df, "prompt", predict_factory=make(w)).first()["output"] for w in ("one", "two")]
    assert got == ["one", "two"]


def test_enrichment_asks_about_every_window(spark):
    seen = "{\n" + "  call(x);\n" * 900 + "  last_word(x);\n}"
    units = spark.createDataFrame([("i", "a.c", "f", "int f()", seen, 1, 9, "c", "function")],
                                  "id string, file_path string, name string, signature string, body string, start_line int, end_line int, language string, kind string")

    def factory():
        return lambda prompts: [f"{len(p.split())} {'last_word' in p}" for p in prompts]
    row = I.enrich_table(units, "2026-01-01T00:00:00Z", factory).first()
    assert row["summary"].split()[1::2] == ["False", "True"]  # two windows, the second holds the end


def test_failed_writes_are_not_taken_for_empty_output(spark, tmp_path):
    """A batch whose processing fails is run again and nothing is emitted twice."""
    schema = T.StructType([T.StructField("id", T.StringType())])
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([("a",), ("b",)], schema).coalesce(1).write.json(os.path.join(src, "1"))
    ST.incremental_enrich(spark, src + "/*", schema, out, ck)
    spark.createDataFrame([("b",), ("c",)], schema).coalesce(1).write.json(os.path.join(src, "2"))

    def broken(df):
        raise OSError("storage")
    with pytest.raises(Exception, match="storage"):
        ST.incremental_enrich(spark, src + "/*", schema, out, ck, broken)
    ST.incremental_enrich(spark, src + "/*", schema, out, ck)
    assert sorted(r["id"] for r in ST.read_output(spark, out).collect()) == ["a", "b", "c"]


def test_unset_checkpoint_folder_needs_a_local_master():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert not session.is_local(Session())


def test_scan_keeps_hidden_names(spark, tmp_path):
    (tmp_path / "_sub" / ".git").mkdir(parents=True)
    (tmp_path / "a.b" / ".git").mkdir(parents=True)
    for name in ("_start.asm", ".hid.C", "x.c", "_sub/deep.c", "_sub/.git/no.c", "a.b/q.c", "skip.txt"):
        (tmp_path / name).write_text(name)
    got = {(r["repo_relative_path"], r["file_name"], r["file_size"]) for r in IO.file_index(spark, str(tmp_path), ["c", ".asm"]).collect()}
    assert got == {(n, n.split("/")[-1], len(n)) for n in ("_start.asm", ".hid.C", "x.c", "_sub/deep.c", "a.b/q.c")}
    text = {r["file_path"]: r["text"] for r in IO.read_source_files(spark, "file:" + str(tmp_path), ["asm"]).collect()}
    assert text == {str(tmp_path / "_start.asm"): "_start.asm"}


def test_token_cache_tokenizes_only_what_it_lacks(spark, tmp_path):
    from pyspark.sql import functions as F
    asked = []

    def tokenize(texts):
        asked.append(sorted(r["text"] for r in texts.collect()))
        return texts.select("key", F.posexplode(F.split("text", " ")).alias("window", "tok"))
    rows = [(i, f"word{i % 7} x") for i in range(70)] + [(100, None), (101, "")]
    get = lambda rs, params={}: IO.token_cache(
        spark, str(tmp_path), spark.createDataFrame(rs, "id long, t string"), "t", params, tokenize)
    want = lambda rs: sorted((i, w, tok) for i, t in rs for w, tok in enumerate((t or "").split(" ")))
    shown = lambda df: sorted((r["id"], r["window"], r["tok"]) for r in df.collect())
    assert shown(get(rows)) == want(rows)
    assert asked == [["", *[f"word{i} x" for i in range(7)]]]  # each text once
    more = rows + [(200, "new one"), (201, "word3 x")]
    assert shown(get(more)) == want(more) and asked[1:] == [["new one"]]
    assert shown(get(more)) == want(more) and len(asked) == 2  # nothing is lacking
    assert shown(get(rows[:3], {"other": 1})) == want(rows[:3]) and len(asked) == 3
    assert get([], {"none": 1}).collect() == []


def test_token_cache_survives_a_failed_run(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "a b")], "id long, t string")

    def broken(texts):
        raise OSError("lost")
    with pytest.raises(OSError):
        IO.token_cache(spark, str(tmp_path), df, "t", {}, broken)
    good = lambda t: t.select("key", F.posexplode(F.split("text", " ")).alias("window", "tok"))
    assert IO.token_cache(spark, str(tmp_path), df, "t", {}, good).count() == 2


def test_failed_write_leaves_the_old_lines(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "out.jsonl")
    schema = T.StructType([T.StructField("x", T.LongType())])
    IO.write_jsonl_atomic(spark.range(5).select(F.col("id").alias("x")), path)
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="no"):
        IO.write_jsonl_atomic(bad, path)
    assert sorted(r["x"] for r in IO.read_jsonl_strict(spark, path, schema).collect()) == list(range(5))
    IO.write_jsonl_atomic(spark.range(2).select(F.col("id").alias("x")), path)
    assert IO.read_jsonl_lenient(spark, path, schema).count() == 2 == IO.load_training_json(spark, path, schema).count()


def test_changed_content_is_processed_again(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n", T.LongType())])
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    drops = [[("a", "one", 1), ("b", "two", 1), ("n", None, 1)], [("a", "one", 2), ("b", "three", 2), ("c", "x", 2), ("c", "y", 3)],
             [("b", "two", 4), ("n", "", 4), ("c", "y", 4)]]
    seen = []
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(os.path.join(src, str(i)))
        ST.incremental_enrich(spark, src + "/*", schema, out, ck, content="text", order="n")
        seen.append(ST.read_output(spark, out).count())
    assert seen == [3, 5, 6]  # then b and c, then b again; null and empty are the same
    got = {r["id"]: r["text"] for r in ST.read_output(spark, out, latest="id").collect()}
    assert got == {"a": "one", "b": "two", "c": "y", "n": None}
