"""Exact k-means over integer vectors with Hilbert-order zone maps.

Vectors are sorted along a Hilbert curve and cut into blocks, each stored as one
row with the box (least and largest component in every dimension) around its
vectors. In a round, the distances from each centroid to the nearest and to the
farthest point of a box tell which centroids can be the nearest of any vector in
it: one whose least distance is above another's largest can't. Only these
candidates are compared with the block's vectors, as one matrix product. All
arithmetic is exact on integers, so the bounds never change a result.

Spark sorts, deals out and sums; what passes through the driver is one row a
centroid and round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stage

#: Vectors of a block and bits a dimension of the curve's key.
BLOCK_ROWS, KEY_BITS = 128, 4


def largest(dims: int) -> int:
    """Components beyond this are set to it, so that squared distances fit 64
    bits (with 64 dimensions ``2**27``: values of half a million at scale 256)."""
    return min(math.isqrt((1 << 62) // max(1, dims)) // 2, (1 << 31) - 1)


# -- Hilbert order -----------------------------------------------------------


def hilbert_keys(x: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
    """Position of each row of ``x`` (rows x dimensions, 0 to ``2**bits - 1``)
    on the Hilbert curve, as bytes whose order is the curve's. Consecutive
    positions differ by one step in one dimension."""
    x = x.T.astype(np.uint32)  # a dimension a row
    dims = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of each level
        below = np.uint32((1 << b) - 1)
        for d in range(dims):
            high = (x[d] >> np.uint32(b) & np.uint32(1)).astype(bool)
            swap = np.where(high, np.uint32(0), (x[0] ^ x[d]) & below)
            x[0] ^= np.where(high, below, swap)
            x[d] ^= swap
    for d in range(1, dims):  # Gray code
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint32(b) & np.uint32(1), np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    levels = [x >> np.uint32(b) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(levels).astype(np.uint8).T, axis=1)


def quantise(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles, within :func:`largest`."""
    most = largest(values.shape[1])
    return np.clip(np.floor(values.astype(np.float64) * scale), -most, most).astype(np.int64)


# -- blocks --------------------------------------------------------------------


def usable(vector_col: str, dims: int) -> Column:
    """The vector has ``dims`` components, none null or non-finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector_col) == dims) & ~F.exists(F.col(vector_col), odd), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def blocks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 256,
           block_rows: int = BLOCK_ROWS, bits: int = KEY_BITS) -> DataFrame:
    """One row a block of at most ``block_rows`` vectors that are near each
    other on the curve: ids, vectors (32-bit integers, row after row), lo, hi.
    Written once; every round reads it.

    Vectors that :func:`usable` doesn't accept are left out. Repeated vectors
    and repeated or null ids are vectors like others; equal vectors are ordered
    by id, so a group of copies of any size is split over partitions."""
    kept = vectors.where(usable(vector_col, dims)).select(F.col(id_col).cast("long").alias("id"),
                                                          F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    most = largest(dims) / scale
    low, high = (0.0, 0.0) if low is None else (min(max(low, -most), most), max(min(high, most), -most))
    width = max(high - low, 1e-300)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column(1), dims)
                cells = np.clip((np.clip(v, low, high) - low) / width * (1 << bits), 0, (1 << bits) - 1).astype(np.uint32)
                ints = quantise(v, scale).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"id": b.column(0), "ints": pa.array([r.tobytes() for r in ints], pa.binary()),
                                                  "key": pa.array([r.tobytes() for r in hilbert_keys(cells, bits)], pa.binary())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            rows += b.column(1).to_pylist()
            while len(ids) >= block_rows:
                yield _block(ids[:block_rows], rows[:block_rows], dims)
                del ids[:block_rows], rows[:block_rows]
        if ids:
            yield _block(ids, rows, dims)

    order = [F.col("key"), F.col("id")]
    sorted_ = kept.mapInArrow(keyed, "id long, ints binary, key binary").repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(sorted_.select("id", "ints").mapInArrow(cut, "ids array<long>, vectors binary, lo binary, hi binary"), "zone-blocks")


def _block(ids: list, rows: list, dims: int) -> pa.RecordBatch:
    m = np.frombuffer(b"".join(rows), np.int32).reshape(-1, dims)
    return pa.RecordBatch.from_pydict({"ids": pa.array([ids], pa.list_(pa.int64())), "vectors": [m.tobytes()],
                                       "lo": [m.min(0).tobytes()], "hi": [m.max(0).tobytes()]})


# -- assignment ------------------------------------------------------------------


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box: the
    squared distance to the box is at most the least of the squared distances
    to a box's farthest corner."""
    below, above = lo - centroids, centroids - hi
    out = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((out * out).sum(1) <= (far * far).sum(1).min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, squared distance) of each vector's nearest centroid; of equal
    distances the first. Exact: doubles while every sum of products fits their
    53 bits, else 64-bit integers."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * most * most * vectors.shape[1] < 1 << 53:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        d = (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)
        best = d.argmin(1)
        return best, d[np.arange(len(d)), best].astype(np.int64)
    best, least = np.zeros(len(vectors), np.int64), None
    for i, one in enumerate(centroids):
        diff = vectors - one
        d = (diff * diff).sum(1)
        better = np.ones(len(d), bool) if least is None else d < least
        best[better] = i
        least = d if least is None else np.minimum(least, d)
    return best, least


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    """(ids, vectors, numbers, distances, candidates) of every block."""
    dims = centroids.shape[1]
    read = lambda x: np.frombuffer(x, np.int32).astype(np.int64)
    for b in batches:
        for ids, m, lo, hi in zip(b.column(0), *(b.column(i).to_pylist() for i in (1, 2, 3))):
            m = read(m).reshape(-1, dims)
            near = candidates(read(lo), read(hi), centroids)
            at, distance = nearest(m, centroids[near])
            yield ids.values, m, near[at], distance, len(near)


def assign(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance and ``compared`` (the centroids that the
    block's bounds left) of every vector; nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, at, distance, n in _assign(batches, centroids):
            yield pa.RecordBatch.from_pydict({"vec_id": ids, "cluster": pa.array(at, pa.int32()), "distance": pa.array(distance, pa.int64()),
                                              "compared": pa.array(np.full(len(at), n), pa.int32())})
    return zones.mapInArrow(run, "vec_id long, cluster int, distance long, compared int")


def cluster_sums(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, n, skipped and the componentwise sums of the vectors of each
    cluster. Tasks add up their blocks; one row a task and cluster is shuffled."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, skipped = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for _, m, at, _, compared in _assign(batches, centroids):
            order = np.argsort(at, kind="stable")
            found, first = np.unique(at[order], return_index=True)
            sums[found] += np.add.reduceat(m[order], first, axis=0)
            n += np.bincount(at, minlength=len(n))
            skipped += len(m) * (len(centroids) - compared)
        if n.any():
            held = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(held, pa.int32()), "n": n[held], "skipped": [skipped] + [0] * (len(held) - 1),
                                              "sums": pa.array(sums[held].tolist(), pa.list_(pa.int64()))})

    tasks = zones.mapInArrow(run, "cluster int, n long, skipped long, sums array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    return tasks.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("skipped").alias("skipped"),
                                        F.array(*[wide(F.col("sums")[i]) for i in range(dims)]).alias("sums"))


# -- k-means -----------------------------------------------------------------------


@dataclass
class Clusters:
    """``assigned``: vec_id, cluster, distance, compared. ``centroids``: the
    final ones. ``skipped``: for each round the share of comparisons of a vector
    with a centroid that the boxes spared."""
    assigned: DataFrame
    centroids: np.ndarray
    skipped: list[float] = field(default_factory=list)


def first_centroids(vectors: DataFrame, k: int, id_col: str, vector_col: str, dims: int, scale: int, seed: int) -> np.ndarray:
    """The ``k`` usable vectors with the smallest SHA-256 of ``<seed>:<id>``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))), 256)
    rows = (vectors.where(usable(vector_col, dims)).select(key.alias("h"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
            .orderBy("h", "v").limit(k).collect())  # k vectors
    return quantise(np.array([r["v"] for r in rows], np.float64).reshape(-1, dims), scale)


def kmeans(vectors: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
           scale: int = 256, seed: int = 2, block_rows: int = BLOCK_ROWS, start: Callable | None = None) -> Clusters:
    """Exact Lloyd rounds over ``floor(scale * x)`` of the usable vectors.

    Each round assigns every vector to its nearest centroid (squared Euclidean
    distance; of equal ones the smaller number) and replaces each centroid that
    has vectors by the floor of their exact mean; one without stays. A last
    assignment follows.

    Vectors with another number of components or with a null or non-finite one
    are left out. Repeated rows count as often as they occur; null ids are ids
    like others (their hash is that of the empty id); rows that share an id are
    ordered by their vectors when centroids are chosen. With fewer than ``k``
    usable vectors there are as many centroids; without any, no rows. Other
    columns are not read. Components beyond :func:`largest` are set to it."""
    c = (start or first_centroids)(vectors, k, id_col, vector_col, dims, scale, seed)
    zones = blocks(vectors, id_col, vector_col, dims, scale, block_rows)
    if not len(c):
        return Clusters(zones.limit(0).selectExpr("cast(null as long) as vec_id", "cast(null as int) as cluster",
                                                  "cast(null as long) as distance", "cast(null as int) as compared"), c)
    spared = []
    for _ in range(rounds):
        c, total, skipped = c.copy(), 0, 0
        for r in cluster_sums(zones, c).collect():  # at most k rows of dims numbers
            c[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
            total, skipped = total + r["n"] * len(c), skipped + r["skipped"]
        spared.append(skipped / total)
    return Clusters(stage(assign(zones, c), "zone-assigned"), c, spared)


def with_inertia(found: Clusters) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and
    compared of every vector; an inertia beyond 64 bits is null."""
    per = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    sums = {r["cluster"]: int(r["s"]) for r in per.collect()}  # a row a centroid
    fits = lambda x: x if x < 1 << 63 else None
    rows = [(i, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, found.centroids[i].tolist())).encode()).hexdigest())
            for i, s in sums.items()]
    spark = found.assigned.sparkSession
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")
