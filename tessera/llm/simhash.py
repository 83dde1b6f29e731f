"""SimHash near-dedup over a Gray-order hierarchical index.

Distinct fingerprints are linked when they differ in at most ``max_bits`` bits
(2). The index is a tree of masked bit patterns. Its top nodes fix two of four
16-bit segments: of any two fingerprints within 2 bits, at least two segments
agree, so they meet under one of the six masks. Top nodes are what Spark deals
to tasks. Below one, the fingerprints are sorted by Gray rank, so that
neighbours share most bits; each node holds the bits that all below it share,
less those that its parent has. A search adds up the differences node by node
and drops a whole group once they exceed the limit, or once all of it already
belongs to the searcher's component.

A task returns at most one link per fingerprint, to the least of its local
component; components over all tasks follow by star contraction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import arrow_limits, as_row, buckets_for, byte_values, from_row, row_order, stage
from .components import components

#: Contract of this operator: words of a shingle, bits that may differ, seed.
SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: Fingerprints under the top nodes of one task, and under one top node before
#: it is refined by a third segment.
TASK_ROWS, NODE_ROWS = 65_536, 65_536
LEAF, FAN, PIECE = 8, 8, 1 << 18

_SEGMENTS = [0xFFFF << s for s in (48, 32, 16, 0)]
MASKS = [_SEGMENTS[i] | _SEGMENTS[j] for i in range(4) for j in range(i + 1, 4)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if over half the shingles' hashes have it set. Fewer
    words than a shingle are one shingle; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    a, b = starts[:n].tolist(), ends[shingle - 1:].tolist()
    for i in range(0, n, 1 << 16):
        raw = b"".join([digest(flat[x:y], SEED) for x, y in zip(a[i:i + (1 << 16)], b[i:i + (1 << 16)])])
        total += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of each row."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in byte_values(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class _Sets:
    """Union-find with labels kept flat between blocks of unions."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> bool:
        x, y = self.label[x], self.label[y]
        away = x != y
        if not away.any():
            return False
        pairs = np.unique(np.stack([np.minimum(x, y)[away], np.maximum(x, y)[away]], 1), axis=0)
        up: dict[int, int] = {}

        def root(v):
            while v in up:
                up[v] = up.get(up[v], up[v])
                v = up[v]
            return v
        for p, q in pairs.tolist():
            p, q = root(p), root(q)
            if p != q:
                up[max(p, q)] = min(p, q)
        to = np.arange(len(self.label))
        for v in up:
            to[v] = root(v)
        self.label = to[self.label]
        return True


class GrayIndex:
    """The tree below one top node, over fingerprints in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.levels = fps, []
        low = high = fps
        size = LEAF
        while True:
            at = np.arange(0, len(low), size)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append([low, ~(low ^ high), size])
            size = FAN
            if len(low) <= FAN:
                break
        # a node keeps the shared bits that its parent doesn't have
        for k in range(len(self.levels) - 1):
            parent = np.repeat(self.levels[k + 1][1], FAN)[:len(self.levels[k][1])]
            self.levels[k].append(self.levels[k][1] & ~parent)
        self.levels[-1].append(self.levels[-1][1])

    def link(self, max_bits: int, sets: _Sets, base: int) -> None:
        """Join all that are within ``max_bits`` of each other in ``sets``,
        where the fingerprints have the numbers from ``base`` on."""
        n, fps = len(self.fps), self.fps
        for gap in range(1, 5):  # neighbours in Gray order first: most links are here
            near = np.flatnonzero(np.bitwise_count(fps[gap:] ^ fps[:-gap]) <= max_bits)
            sets.join(base + near, base + near + gap)
        spans = [LEAF * FAN ** k for k in range(len(self.levels))]
        for lo in range(0, n, 2048):
            label = sets.label[base:base + n]
            one = []  # the component of a node whose fingerprints all are in it, else -1
            for span in spans:
                at = np.arange(0, n, span)
                least, most = np.minimum.reduceat(label, at), np.maximum.reduceat(label, at)
                one.append(np.where(least == most, least, -1))
            q = np.arange(lo, min(n, lo + 2048))
            top = len(self.levels) - 1
            roots = np.arange(len(self.levels[top][0]))
            todo = [(top, np.repeat(q, len(roots)), np.tile(roots, len(q)), np.zeros(len(q) * len(roots), np.int64))]
            while todo:
                k, q, node, sofar = todo.pop()
                if len(q) > PIECE:
                    todo += [(k, q[i:i + PIECE], node[i:i + PIECE], sofar[i:i + PIECE]) for i in range(0, len(q), PIECE)]
                    continue
                if k < 0:
                    later = node > q
                    q, node = q[later], node[later]
                    hit = np.bitwise_count(fps[q] ^ fps[node]) <= max_bits
                    sets.join(base + q[hit], base + node[hit])
                    continue
                pattern, _, _, own = self.levels[k]
                sofar = sofar + np.bitwise_count((fps[q] ^ pattern[node]) & own[node])
                go = (sofar <= max_bits) & ((node + 1) * spans[k] > q) & (one[k][node] != label[q])
                q, node, sofar = q[go], node[go], sofar[go]
                width = FAN if k else LEAF
                below = len(self.levels[k - 1][0]) if k else n
                child = (node[:, None] * width + np.arange(width)).ravel()
                inside = child < below
                todo.append((k - 1, np.repeat(q, width)[inside], child[inside], np.repeat(sofar, width)[inside]))


def link_table(table: pa.Table, max_bits: int) -> pa.Table:
    """Links of the fingerprints under the top nodes of one task: (a, b), b the
    least of a's local component."""
    fp = table.column("fp").to_numpy().view(np.uint64)
    top = np.stack([table.column(c).to_numpy().view(np.uint64) for c in ("band", "key", "part")], 1)
    order = np.lexsort((gray_rank(fp), top[:, 2], top[:, 1], top[:, 0]))
    fp, top = fp[order], top[order]
    new = np.ones(len(fp), bool)
    new[1:] = (top[1:] != top[:-1]).any(axis=1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(fp)))
    group = np.repeat(np.arange(len(start)), size)
    sets = _Sets(len(fp))
    small = size <= LEAF * FAN
    for gap in range(1, LEAF * FAN):  # groups of a few leaves need no tree
        i = np.flatnonzero(small[group[:-gap]] & (group[gap:] == group[:-gap])) if gap < len(fp) else []
        if not len(i):
            break
        near = i[np.bitwise_count(fp[i] ^ fp[i + gap]) <= max_bits]
        sets.join(near, near + gap)
    for g in np.flatnonzero(~small):
        s = slice(start[g], start[g] + size[g])
        GrayIndex(fp[s]).link(max_bits, sets, int(start[g]))
    away = sets.label != np.arange(len(fp))
    return pa.table({"a": fp[away].view(np.int64), "b": fp[sets.label[away]].view(np.int64)})


def links(distinct: DataFrame, max_bits: int = MAX_BITS, task_rows: int = TASK_ROWS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges that connect the fingerprints (``fp``) that are within
    ``max_bits`` (2 at most) of each other, through others or directly."""
    if not 0 <= max_bits <= 2:
        raise ValueError("six masks of two segments find links of at most 2 bits")
    n = distinct.count()
    signed = [m - (1 << 64) if m >> 63 else m for m in MASKS]
    bands = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                                for i, m in enumerate(signed)])).alias("t")
    rows = distinct.select("fp", bands).select("fp", "t.band", "t.key")
    sizes = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = stage(rows.join(sizes, ["band", "key"]), "gray-rows")
    light = rows.filter(F.col("n") <= node_rows).select("fp", "band", "key", F.lit(0).cast("long").alias("part"))
    # under a crowded top node at least one of three parts of the other 32 bits
    # agrees too: at most 2**22 fingerprints share a node then
    heavy = rows.filter(F.col("n") > node_rows)
    free = [~m & (1 << 64) - 1 for m in MASKS]
    parts = []
    for m in free:
        bits = [b for b in range(64) if m >> b & 1]
        parts.append([sum(1 << b for b in bits[i:j]) for i, j in ((0, 11), (11, 22), (22, 32))])
    signed_parts = [[x - (1 << 64) if x >> 63 else x for x in p] for p in parts]
    third = None
    for i, p in enumerate(signed_parts):
        each = F.array(*[F.struct(F.lit(i + 6 * (j + 1)).cast("long").alias("band"), F.col("fp").bitwiseAND(F.lit(x)).alias("part"))
                         for j, x in enumerate(p)])
        third = F.when(F.col("band") == i, each) if third is None else third.when(F.col("band") == i, each)
    heavy = heavy.select("fp", "key", F.explode(third).alias("t")).select("fp", "t.band", "key", "t.part")
    tasks = buckets_for(6 * n, task_rows)
    dealt = light.unionByName(heavy).withColumn("_task", F.pmod(F.xxhash64("band", "key", "part"), F.lit(tasks)))

    def run(table: pa.Table) -> pa.Table:
        return link_table(table, max_bits)
    return dealt.groupBy("_task").applyInArrow(run, "a long, b long")


def near_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable by links,
    its own included) of each row.

    Null, empty and blank texts have fingerprint 0, which links like any other.
    Repeated rows stay, in one component. Null doc_ids are kept; a component of
    nothing but those has a null id. Other columns are left out."""
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "gray-distinct")
    roots = components(links(distinct, max_bits))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = stage(classes, "gray-classes")
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(ids, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component, the row with the
    smallest doc_id (null is the largest), and of rows that share it one (those
    equal in doc_id and text: the least by their other columns). All columns
    pass through unchanged, whatever their names. Null, empty and blank texts
    have fingerprint 0; an empty table gives no rows."""
    # rows equal in doc_id and text are one here
    own = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    all_rows = docs.select(as_row(docs).alias("row"), F.col(id_col).cast("long").alias("doc_id"), own.alias("own"),
                           row_order(docs, [id_col, text_col]).alias("rest"))
    arrow_limits(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in byte_values(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp.view(np.int64))], names=["doc_id", "own", "fp"])
    rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), own.alias("own"))
                 .mapInArrow(run, "doc_id long, own long, fp long"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("first")
    distinct = stage(rows.groupBy("fp").agg(first), "gray-distinct")
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    stays = (distinct.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("s"))
             .select(F.col("s.doc_id").alias("stays_id"), F.col("s.own").alias("stays_own")))
    kept = all_rows.join(stays, F.col("doc_id").eqNullSafe(F.col("stays_id")) & (F.col("own") == F.col("stays_own")))
    return kept.groupBy("doc_id", "own").agg(F.min_by("row", "rest").alias("row")).select(*from_row(docs))
