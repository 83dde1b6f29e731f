"""BLEU is clipped in the pair's row; the model's workers get bounded batches."""

import math

import pandas as pd

from tessera.operators import evaluate as EV
from tessera.operators import infer as I
from tessera.streaming import incremental as ST


def test_bleu_counts_leave_the_row_and_no_gram(spark):
    pairs = spark.createDataFrame([("a", "the the cat sat on it", "the cat sat on the mat"), ("a", "on it", "it"), ("b", "x", "y z"),
                                   ("c", None, "no words"), ("d", "", "left"), ("e", "q q", None)], "pair_id string, candidate string, reference string")
    got = EV.corpus_bleu(pairs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    r = got.first()
    # of pair a as a whole 6 of 8 words, of b none of 1, of e none of 2; references have 7 + 2 + 2 + 1 words
    assert math.isclose(r.p1, 6 / 11) and math.isclose(r.p2, 3 / 7) and math.isclose(r.p3, 2 / 4) and math.isclose(r.p4, 1 / 3)
    assert math.isclose(r.bp, math.exp(1 - 12 / 11)) and math.isclose(r.bleu, r.bp * (r.p1 * r.p2 * r.p3 * r.p4) ** 0.25)


def test_workers_get_bounded_batches(spark):
    def factory():
        return lambda prompts: [str(len(prompts))] * len(prompts)
    n = 3 * I.ARROW_ROWS
    df = spark.range(0, n, 1, 1).selectExpr("id", "repeat('p', 20) AS prompt")
    sizes = I.infer_batched(df, "prompt", predict_factory=factory, batch_size=10 * n).groupBy("output").count().collect()
    assert [(int(r.output), r["count"]) for r in sizes] == [(I.ARROW_ROWS, n)]


class _State:
    exists, value = False, None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.exists, self.value = True, v


def test_one_row_of_an_id_is_not_sorted(monkeypatch):
    run, state = ST._changed("text", "text", ["id", "text"]), _State()
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda *a, **k: (_ for _ in ()).throw(AssertionError("sorted")))
    one = pd.DataFrame({"id": ["a"], "text": ["x"]})
    assert [list(b["text"]) for b in run(("a",), iter([one]), state)] == [["x"]]
    assert list(run(("a",), iter([one]), state)) == []
    monkeypatch.undo()
    two = pd.DataFrame({"id": ["a", "a"], "text": ["z", "y"]})
    assert [list(b["text"]) for b in run(("a",), iter([two, one]), state)] == [["z"]]
