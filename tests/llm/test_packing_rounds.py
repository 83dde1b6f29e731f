import numpy as np
import pyarrow as pa

from tessera.llm import packing as P


def test_rounds_go_on_while_each_saves_a_bin(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "rounds")

    def one_bin_less(capacity):  # 30, 29, ... bins, down to the 8 that are needed
        def run(table):
            with open(path, "a+") as f:
                f.seek(0)
                bins = max(30 - len(f.read()), 8)
                f.write("x")
            i = np.arange(table.num_rows)
            for name, col in (("_bin", i % bins), ("offset", i // bins), ("_open", i >= 0), ("_bins", i * 0 + bins), ("_gap", i * 0 + 1)):
                table = table.append_column(name, pa.array(col))
            return table
        return run

    monkeypatch.setattr(P, "_pack_part", one_bin_less)
    items = spark.createDataFrame([(i, 0, 1) for i in range(30)], "doc_id long, piece int, length long")
    got = P.pack(items, capacity=4).collect()
    assert len(got) == 30 and len({r.sequence_id for r in got}) == 8
    assert len({(r.sequence_id, r.offset) for r in got}) == 30
