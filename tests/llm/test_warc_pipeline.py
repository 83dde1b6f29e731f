import gzip
import hashlib
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tessera.llm import line_dedup, packing, queries, warc

SCHEMA = "page_id long, url string, html string, record_type string"
LONG, OTHER = "<p>" + "ü" * 80 + "</p>", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9
ROWS = [(5, "http://a/5", LONG, "x"), (3, "http://a/3\r\nX: y", LONG, "x"), (9, None, LONG, "x"), (None, "u", LONG, None),
        (3, "http://a/3\r\nX: y", LONG, "x"), (1, "http://b", "short", "x"), (2, "http://b", "short", "x"), (4, "c", None, "x"),
        (6, "c", "", "x"), (7, "d", OTHER, "x"), (8, "d", OTHER, "x"), (10, "e", "z" * 300_000, "x"), (11, "f", "a" * 100, "x"),
        (12, "g", "a" * 100, "x"), (13, "h", "b" * 99, "x"), (14, "h", "b" * 99, "x")]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "warc")
    warc.write_archives(warc.plan_records(pages, warc.files_for(300_000, 100_000)), path)
    rows = warc.resolve(warc.read_archives(spark, path)).collect()
    first = {}
    for i, _, html, _ in ROWS:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    want, answered = Counter(), set()
    for i, _, html, _ in ROWS:
        raw = (html or "").encode()
        own = html not in first or (first[html] == i and html not in answered)
        if own and html in first:
            answered.add(html)
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if own else "revisit", None if own else first[html])] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_page) for r in rows) == want
    # the archives themselves: payloads once, headers that refer to a record that exists
    heads, payloads = [], Counter()
    for f in (tmp_path / "warc").glob("*.gz"):
        for h, block in warc.parse(gzip.decompress(f.read_bytes())):
            heads.append(h)
            payloads[block.partition(b"\r\n\r\n")[2]] += 1
    ids = [h["warc-record-id"] for h in heads]
    assert len(heads) == len(ROWS) and len(set(ids)) == len(ids) and payloads[LONG.encode()] == 1
    assert all(h["warc-refers-to"] in ids and h["warc-profile"] == warc.PROFILE for h in heads if h["warc-type"] == "revisit")


def test_belied_digests_raise(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: "
              + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "x.gz").write_bytes(gzip.compress(record))
    with pytest.raises(Exception, match="digest differ"):
        warc.read_archives(spark, str(tmp_path / "w"))


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(warc.plan_records(spark.createDataFrame([], SCHEMA)), path)
    assert warc.resolve(warc.read_archives(spark, path)).collect() == []


# -- the pipeline against plain Python, stage by stage

@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    import corpus_pipeline as C
    top = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, step) in enumerate(C.STAGES):
        frame = step(spark, docs, sf)
        frame.write.parquet(str(top / str(k)))
        after = spark.read.parquet(str(top / str(k)))
        out.append((name, docs, after))
        docs = after
    return out


def ids(frame):
    return Counter(r.doc_id for r in frame.collect())


def test_stages_return_documents(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_rows_go(spark, sf, stages):
    _, before, after = stages[0]
    scored = {r.doc_id: r.predicted for r in queries.op2_toxicity(spark, sf).collect()}
    assert ids(after) == Counter(i for i in ids(before) if not scored[i])
    assert 0 < after.count() < before.count()


def test_lines_go(stages):
    _, before, after = stages[1]
    texts = {r.doc_id: r.text for r in before.collect()}
    keys = {i: line_dedup.line_keys(t.encode()) for i, t in texts.items()}
    n = Counter(k for ks in keys.values() for k in set(ks) if k)
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    for i, t in texts.items():
        kept = "\n".join(x for x, k in zip(t.split("\n"), keys[i]) if n[k] < 10)
        assert got[i] == (kept, len(kept))


def test_one_of_each_group_stays(stages):
    from tests.llm.test_dedup import brute_components, brute_fingerprint
    _, before, after = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    label = brute_components([brute_fingerprint(t) for _, t in rows])
    assert ids(after) == Counter({rows[i][0]: 1 for i in set(label)})


def test_mix_follows_its_targets(stages):
    from tests.llm.test_mixing_sharding import n_words, wanted
    _, before, after = stages[3]
    size, longest = Counter(), Counter()
    for r in before.collect():
        size[r.source] += n_words(r.text)
        longest[r.source] = max(longest[r.source], n_words(r.text))
    got = Counter()
    for r in after.collect():
        got[r.source] += n_words(r.text)
    for s, t in wanted(size).items():
        assert abs(got[s] - t) <= longest[s]
    assert max(ids(after).values()) <= 2


def test_packing_holds_every_token(stages):
    from tokenizers import Tokenizer
    _, before, after = stages[4]
    tok = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for r in before.collect():
        enc = tok.encode(r.text, add_special_tokens=False).ids + [1]
        for k in range(0, len(enc), 4096):
            part = pa.array(enc[k:k + 4096], pa.uint32()).to_numpy().astype("<u4").tobytes()
            want[(r.doc_id, k // 4096, len(part) // 4, zlib.crc32(part))] += 1
    rows = after.collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == want
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY
    sizes = Counter(r.length for r in rows)
    import numpy as np
    counts = np.zeros(packing.CAPACITY + 1, int)
    for s, n in sizes.items():
        counts[s] = n
    assert len(fill) <= packing.lower_bound(counts, packing.CAPACITY) + 1


def test_run_is_its_stages(spark, sf, stages):
    import corpus_pipeline as C
    assert C.run(spark, sf).count() == stages[-1][2].count()


def test_stages_take_odd_and_no_rows(spark, sf, odd, none):
    import corpus_pipeline as C
    for docs in (odd, none):
        for name, step in C.STAGES:
            out = step(spark, docs, sf)
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            assert (out.count() == 0) == (docs is none)
