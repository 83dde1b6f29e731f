import numpy as np
from pyspark.sql import functions as F

from tessera.llm import line_dedup as Ld


def test_probes_of_a_shard_are_dealt_to_parts(spark, monkeypatch):
    # 2,000 lines, each in 30 documents: one shard by the number of lines
    rows = [(d, "\n".join(f"line {k}" for k in range(d % 40, 2000, 40))) for d in range(1200)] + [(None, "line 1\nalone"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    send = Ld.send_probes
    monkeypatch.setattr(Ld, "send_probes", lambda *a: seen.append(send(*a)) or seen[-1])
    hits, _ = Ld.frequent_lines(docs, part_probes=5_000)
    (sent,) = seen
    sizes = [r["count"] for r in sent.groupBy("shard", "part").count().collect()]
    assert sent.select("shard").distinct().count() == 1 and len(sizes) == 13 and sum(sizes) == 60_002 and max(sizes) < 7_000
    whole, _ = Ld.frequent_lines(docs, part_probes=10**9)
    assert sorted(hits.collect(), key=repr) == sorted(whole.collect(), key=repr) and hits.count() == 60_001
    # a shard without an entry has one part
    assert Ld._parts_of(np.array([0, 3, 9]), (np.array([3]), np.array([4]))).tolist() == [1, 4, 1]
    out = Ld.drop_lines(docs).agg(F.sum("n_dropped")).first()[0]
    assert out == 60_001
