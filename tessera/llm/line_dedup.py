"""Line dedup over a sharded minimal perfect hash.

Lines are known by the 128-bit hash of their key. Spark counts the documents of
every distinct line; each shard of the hash space (its leading bits) builds a
minimal perfect hash over its distinct lines, which indexes two plain arrays:
fingerprints and document counts. A shard with its arrays is one row of a
written table. Documents send each of their distinct lines as a probe to the
shard, which answers from the arrays; only the answers "drop" travel back.

A line found in a large part of all documents would make its shard's probes
unbounded. Lines with more than 1 in ``HEAVY`` of all line places number fewer
than ``HEAVY`` at any size of the corpus, so these go to every task as one more
such index (bounded, and so broadcast), and only the others are sent. A shard
whose lines have many places in all is probed in parts, each with the shard's
index row, so that a task's probes are bounded too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import BLANKS, arrow_limits, as_row, buckets_for, byte_values, from_row, stage, text_of

#: Distinct lines of one shard, about.
SHARD_LINES = 65_536
#: Probes of one part of a shard, about.
PART_PROBES = 1_000_000
HEAVY = 1024
MIN_DOCS, MIN_CHARS = 10, 1
_PAD = BLANKS.encode()
_LEVELS = 48


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: stripped of blanks, A-Z lower-cased."""
    return [x.strip(_PAD).lower() for x in text.split(b"\n")]


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """64 fresh bits of each key for a level (a multiply and xor-shift hash)."""
    x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: at each level the keys
    that have a bit for themselves set it, the others go on to the next; a
    key's index is the rank of its bit over all levels."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        rest, levels = keys, []
        for level in range(_LEVELS):
            if not len(rest):
                break
            size = max(64, 2 * len(rest))
            at = (_mix(rest, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        if len(rest):
            raise ValueError("keys must be distinct")
        sizes = np.array([len(x) for x in levels], np.int64)
        return cls(np.concatenate(levels) if levels else np.zeros(0, bool), sizes)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            at = (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> tuple[bytes, bytes]:
        return np.packbits(self.bits).tobytes(), self.sizes.astype("<i8").tobytes()

    @classmethod
    def load(cls, bits: bytes, sizes: bytes) -> "PerfectHash":
        sizes = np.frombuffer(sizes, "<i8")
        return cls(np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool), sizes)


INDEX_SCHEMA = "shard long, bits binary, sizes binary, prints binary, counts binary, twins binary"


def build_index(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, shard: int) -> tuple:
    """A row of INDEX_SCHEMA. ``hi`` is what the perfect hash is over and
    ``lo`` the fingerprint. Lines that share ``hi`` but not ``lo`` are kept, all
    but the first, in a short exact list (``twins``)."""
    order = np.lexsort((lo, hi))
    hi, lo, counts = hi[order], lo[order], counts[order]
    first = np.ones(len(hi), bool)
    first[1:] = hi[1:] != hi[:-1]
    ph = PerfectHash.build(hi[first])
    at = ph.index(hi[first])
    prints, n = np.empty(len(at), "<u8"), np.empty(len(at), "<i8")
    prints[at], n[at] = lo[first], counts[first]
    twins = np.stack([hi[~first], lo[~first], counts[~first].astype(np.uint64)]).astype("<u8")
    return (shard, *ph.dump(), prints.tobytes(), n.tobytes(), twins.tobytes())


class Index:
    def __init__(self, bits, sizes, prints, counts, twins):
        self.ph = PerfectHash.load(bits, sizes)
        self.prints, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<i8")
        t = np.frombuffer(twins, "<u8").reshape(3, -1)
        self.twins = {(int(a), int(b)): int(n) for a, b, n in t.T}

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The count of each line, 0 of those that the index doesn't hold."""
        at = self.ph.index(hi)
        n = np.zeros(len(hi), np.int64)
        found = at >= 0
        found[found] = self.prints[at[found]] == lo[found]
        n[found] = self.counts[at[found]]
        if self.twins:
            for i in np.flatnonzero(~found):
                n[i] = self.twins.get((int(hi[i]), int(lo[i])), 0)
        return n


def _u64(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _hash_lines(texts: list[bytes], min_chars: int):
    """(document, line number, hi, lo) of the lines with a key of at least
    ``min_chars`` code points."""
    doc, line, raw = [], [], []
    for i, t in enumerate(texts):
        for j, key in enumerate(line_keys(t)):
            if len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
                doc.append(i)
                line.append(j)
                raw.append(xxhash.xxh3_128_digest(key))
    pairs = np.frombuffer(b"".join(raw), ">u8").astype(np.uint64).reshape(-1, 2)
    return np.array(doc, np.int64), np.array(line, np.int64), pairs[:, 0], pairs[:, 1]


def _own(text_col: str):
    """What tells the texts of equal doc_ids apart."""
    return F.xxhash64(text_of(text_col)).alias("own")


def distinct_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text hash, hi and lo: one row per document and distinct line.
    Rows equal in doc_id and text give equal rows."""
    def run(batches):
        for b in batches:
            texts = byte_values(b.column(1))
            doc, _, hi, lo = _hash_lines(texts, min_chars)
            if not len(doc):
                continue
            order = np.lexsort((lo, hi, doc))
            doc, hi, lo = doc[order], hi[order], lo[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            doc, hi, lo = doc[new], hi[new], lo[new]
            of = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(of), b.column(2).take(of), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64))],
                names=["doc_id", "own", "hi", "lo"])
    return docs.select("doc_id", "text", _own("text")).mapInArrow(run, "doc_id long, own long, hi long, lo long")


def line_index(lines: DataFrame, bits: int) -> DataFrame:
    """The index rows over ``lines`` (hi, lo, docs): 2**bits shards."""
    def run(key, table):
        row = build_index(_u64(table.column("hi")), _u64(table.column("lo")),
                          table.column("docs").to_numpy(), key[0].as_py())
        return pa.table([pa.array([x]) for x in row], names=["shard", "bits", "sizes", "prints", "counts", "twins"])
    return lines.withColumn("shard", _shard(bits)).groupBy("shard").applyInArrow(run, INDEX_SCHEMA)


def _shard(bits: int):
    return (F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0)).cast("long")


def shard_parts(lines: DataFrame, bits: int, part_probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards with more probes than ``part_probes``, and how many parts each
    has (at most one entry for that many line places)."""
    sums = lines.groupBy(_shard(bits).alias("shard")).agg(F.sum("docs").alias("n")).filter(F.col("n") > part_probes)
    found = sorted((r.shard, -(-r.n // part_probes)) for r in sums.collect())
    return np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], np.int64)


def _parts_of(shard: np.ndarray, parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    if not len(parts[0]):
        return np.ones(len(shard), np.int64)
    at = np.minimum(np.searchsorted(parts[0], shard), len(parts[0]) - 1)
    return np.where(parts[0][at] == shard, parts[1][at], 1)


def send_probes(probes: DataFrame, held: tuple, bits: int, parts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The probes of all but the heavy lines, with their shard and part."""
    def light(batches):
        own = Index(*held)
        for b in batches:
            b = b.filter(pa.array(own.probe(_u64(b.column(2)), _u64(b.column(3))) == 0))
            shard = (_u64(b.column(2)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(b.num_rows, np.int64)
            # null doc_ids are dealt by their text alone
            salt = _mix(_u64(b.column(1)) ^ _mix(_u64(b.column(0).fill_null(0)), 1), 2)
            part = (salt % _parts_of(shard, parts).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(part)], names=["doc_id", "own", "hi", "lo", "shard", "part"])
    return probes.mapInArrow(light, "doc_id long, own long, hi long, lo long, shard long, part long")


def repeat_index(index: DataFrame, parts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Each shard's row for each of its parts."""
    def run(batches):
        for b in batches:
            for i, n in enumerate(_parts_of(_u64(b.column(0)).view(np.int64), parts).tolist()):
                for k in range(n):
                    yield pa.RecordBatch.from_arrays([*b.slice(i, 1).columns, pa.array([k], pa.int64())], names=[*b.schema.names, "part"])
    return index.mapInArrow(run, f"{INDEX_SCHEMA}, part long")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                   shard_lines: int = SHARD_LINES, part_probes: int = PART_PROBES) -> tuple[DataFrame, bytes | None]:
    """What is to drop: (doc_id, own, hi, lo) rows answered by the shards, and
    the rows of the index of heavy lines, which every task probes itself."""
    probes = stage(distinct_lines(docs, min_chars), "line-probes")
    lines = stage(probes.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("docs")), "line-counts")
    sums = lines.agg(F.count(F.lit(1)).alias("n"), F.sum("docs").alias("places")).first()
    if not sums.n:
        return probes, None
    # fewer than HEAVY lines can pass this test, whatever the corpus
    heavy = lines.filter((F.col("docs") * HEAVY > sums.places) & (F.col("docs") >= min_docs)).collect()
    as_u64 = lambda xs: np.array(xs, np.int64).view(np.uint64)
    held = build_index(as_u64([r.hi for r in heavy]), as_u64([r.lo for r in heavy]),
                       np.array([r.docs for r in heavy], np.int64), 0)[1:]
    bits = (buckets_for(sums.n, shard_lines) - 1).bit_length()
    index = stage(line_index(lines, bits), "line-index")

    def answer(probed: pa.Table, arrays: pa.Table) -> pa.Table:
        if not probed.num_rows or not arrays.num_rows:
            return probed.select(["doc_id", "own", "hi", "lo"]).slice(0, 0)
        own = Index(*(arrays.column(c)[0].as_py() for c in ("bits", "sizes", "prints", "counts", "twins")))
        n = own.probe(_u64(probed.column("hi")), _u64(probed.column("lo")))
        return probed.select(["doc_id", "own", "hi", "lo"]).filter(pa.array(n >= min_docs))

    schema = "doc_id long, own long, hi long, lo long"
    light = lines.filter((F.col("docs") * HEAVY <= sums.places) | (F.col("docs") < min_docs))
    parts = shard_parts(light, bits, part_probes)
    sent, rows = send_probes(probes, held, bits, parts), repeat_index(index, parts)
    hits = sent.groupBy("shard", "part").cogroup(rows.groupBy("shard", "part")).applyInArrow(answer, schema)
    return hits, held


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with its text rebuilt without lines whose key is found in at
    least ``min_docs`` documents, and ``n_lines`` (before) and ``n_dropped``.

    A null or empty text is one empty line, which stays, and comes back as an
    empty text. A document counts once for a line that it repeats; repeated rows
    count as documents of their own. Other columns pass through unchanged,
    whatever their names, but input columns named ``n_lines`` or ``n_dropped``
    give way to the counts; without ``counts`` these are left out and such
    columns stay as well. An empty table gives no rows."""
    arrow_limits(docs.sparkSession, rows=1000, mb=8)  # nothing is shared by a batch's texts
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    hits, held = frequent_lines(slim, min_docs, min_chars)
    told = hits.groupBy("doc_id", "own").agg(F.collect_set(F.struct("hi", "lo")).alias("drop")).select(
        F.col("doc_id").alias("told_id"), F.col("own").alias("told_own"), "drop")
    rows = docs.select(F.col(text_col).alias("text"), as_row(docs, [text_col]).alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"), _own(text_col).alias("own"))
    joined = rows.join(told, F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("own") == F.col("told_own")), "left")
    joined = joined.select("text", "row", "drop")

    def rebuild(batches):
        own = Index(*held) if held else None
        for b in batches:
            texts, drops = byte_values(b.column(0)), b.column(2).to_pylist()
            doc, line, hi, lo = _hash_lines(texts, min_chars)
            gone = own.probe(hi, lo) >= min_docs if own is not None and len(doc) else np.zeros(len(doc), bool)
            starts = np.searchsorted(doc, np.arange(len(texts) + 1))
            out, n_lines, n_dropped = [], [], []
            for i, t in enumerate(texts):
                s = slice(starts[i], starts[i + 1])
                away = set(line[s][gone[s]].tolist())
                if drops[i]:
                    told_ = {(d["hi"], d["lo"]) for d in drops[i]}
                    pairs = zip(hi[s].view(np.int64).tolist(), lo[s].view(np.int64).tolist())
                    away |= {j for j, p in zip(line[s].tolist(), pairs) if p in told_}
                parts = t.split(b"\n")
                n_lines.append(len(parts))
                n_dropped.append(len(away))
                out.append(b"\n".join(x for j, x in enumerate(parts) if j not in away) if away else t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()).cast(pa.string()), b.column(1), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=["text", "row", "n_lines", "n_dropped"])

    schema = StructType([*joined.schema.fields[:2], StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    rebuilt = joined.mapInArrow(rebuild, schema)
    if not counts:
        return rebuilt.select(*from_row(docs, replace={text_col: F.col("text")}))
    own = ["n_lines", "n_dropped"]
    return rebuilt.select(*from_row(docs, replace={text_col: F.col("text")}, without=own), *own)
