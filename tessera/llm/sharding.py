"""Sharding by Karmarkar-Karp differencing.

A partial partition is a row of ``k`` shard sums. Differencing takes the two
with the largest spread again and again and adds them oppositely ordered, until
one is left. Chunks of a bounded number of groups are differenced in one task
each; what remains of a chunk is itself a partial partition, so the chunks are
differenced by the same step, level by level, and the groups follow their
chunk's slots down to the shards.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import buckets_for, running_number, stage, text_of

SHARDS = 24
#: Partial partitions that one task differences.
CHUNK = 4096
#: Parts of one group of equal texts, when rows are given their shard.
SALTS = 64
#: Rows of a shard that one task numbers.
ROWS_PER_BUCKET = 5000


def difference(parts: list[list[int]]) -> list[list[int]]:
    """For each partial partition (``k`` sums in descending order) the places
    of its slots in the partition of them all, whose sums descend too."""
    k = len(parts[0])
    heap = [(p[-1] - p[0], i, p) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, list[int]]] = []
    n = len(parts)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        s = [p + q for p, q in zip(x, reversed(y))]
        order = sorted(range(k), key=lambda j: -s[j])
        s = [s[j] for j in order]
        low = s[-1]
        heapq.heappush(heap, (low - s[0], n + len(merges), [v - low for v in s]))
        merges.append((a, b, order))
    places: list[list[int] | None] = [None] * (n + len(merges))
    places[-1] = list(range(k))
    for m in range(len(merges) - 1, -1, -1):
        a, b, order = merges[m]
        own, pa_, pb = places[n + m], [0] * k, [0] * k
        for j, o in enumerate(order):
            pa_[o] = own[j]
            pb[k - 1 - o] = own[j]
        places[a], places[b], places[n + m] = pa_, pb, None
    return places[:n]


def _leaf(k: int):
    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("bytes").to_pylist()
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], table.column("digest")[i].as_py()))
        places = difference([[sizes[i]] + [0] * (k - 1) for i in order])
        slot = [0] * len(sizes)
        for i, p in zip(order, places):
            slot[i] = p[0]
        return table.append_column("slot", pa.array(slot, pa.int32()))
    return run


def _inner(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows: dict[int, list[int]] = {}
        for node, slot, total in zip(*(table.column(c).to_pylist() for c in ("node", "slot", "bytes"))):
            rows.setdefault(node, [0] * k)[slot] = total
        nodes = sorted(rows)
        parts, orders = [], []
        for n in nodes:
            order = sorted(range(k), key=lambda j: -rows[n][j])
            low = rows[n][order[-1]]
            parts.append([rows[n][j] - low for j in order])
            orders.append(order)
        out = {n: dict(zip(o, p)) for n, o, p in zip(nodes, orders, difference(parts))}
        up = [out[n][s] for n, s in zip(table.column("node").to_pylist(), table.column("slot").to_pylist())]
        return table.append_column("up_slot", pa.array(up, pa.int32()))
    return run


def assign(groups: DataFrame, k: int = SHARDS, chunk: int = CHUNK) -> DataFrame:
    """``groups`` (digest string, bytes long) with ``shard``. One task holds at
    most about ``chunk`` groups, or as many partial partitions of ``k`` sums."""
    nodes = buckets_for(groups.count(), chunk)
    dealt = groups.select("digest", "bytes", F.pmod(F.xxhash64("digest"), F.lit(nodes)).cast("long").alias("node"))
    leaf = stage(dealt.groupBy("node").applyInArrow(_leaf(k), "digest string, bytes long, node long, slot int"), "kk-leaf")
    placed = leaf
    sums = stage(leaf.groupBy("node", "slot").agg(F.sum("bytes").alias("bytes")), "kk-sums")
    while nodes > 1:
        nodes = buckets_for(nodes, chunk)
        up = sums.withColumn("up", F.pmod("node", F.lit(nodes)))
        level = stage(up.groupBy("up").applyInArrow(
            _inner(k), "node long, slot int, bytes long, up long, up_slot int"), "kk-level")
        placed = placed.join(level.select("node", "slot", "up", "up_slot"), ["node", "slot"]).select(
            "digest", "bytes", F.col("up").alias("node"), F.col("up_slot").alias("slot"))
        sums = level.groupBy(F.col("up").alias("node"), F.col("up_slot").alias("slot")).agg(F.sum("bytes").alias("bytes"))
    return placed.select("digest", "bytes", F.col("slot").alias("shard"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Law ``bytes``: shards of near equal size. Equal texts form a group, which no
    shard boundary cuts: a group above a k-th of all bytes makes its shard the
    largest. A null text counts as an empty one (size 8). Repeated rows are rows
    of their own, null doc_ids come first in their shard, other columns are left
    out, and an empty table gives no rows."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).cast("long").alias("text_crc32"), F.sha2(text, 256).alias("digest"))
    rows = stage(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), "shard-rows")
    # a group is summed and given its shard by its salted parts, so that a hot text spreads
    parts = rows.groupBy("digest", "salt").agg(F.sum("size").alias("bytes"))
    groups = stage(parts.groupBy("digest").agg(F.sum("bytes").alias("bytes")), "shard-groups")
    placed = assign(groups, k).select("digest", "shard")
    parts = parts.select("digest", "salt").join(placed, "digest")
    out = rows.join(parts, ["digest", "salt"]).select("doc_id", "size", "text_crc32", "shard")
    out = stage(out, "shard-placed")
    n = buckets_for(out.count(), k * ROWS_PER_BUCKET)
    out = running_number(out, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")],
                         F.xxhash64("doc_id", "text_crc32"), n, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
