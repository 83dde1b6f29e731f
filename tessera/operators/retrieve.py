"""Exact vector search and retrieval helpers.

Vectors stay where they are: a task reads its own, and only its k best per query
go on. Queries come to them in rounds of a bounded number of rows (one broadcast
a round). Inside a task, vectors are grouped around centres of their own; the
triangle inequality on a group's inner and outer radius discards it for queries
that already know k nearer vectors, the rest is one matrix product a group, and
what that leaves near the limit is measured again term by term, so distances and
ties are those of the plain formula.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import cut_lineage, drop_state

#: Queries of a round, groups of a batch of vectors at most, rows of a group at
#: least, and numbers of one step of the kernel.
ROUND_ROWS, GROUPS, GROUP_ROWS, _CELLS = 32_768, 64, 32, 4 << 20
#: Allowance for rounding of matrix products, relative to the squared lengths.
_SLACK = 1e-9


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product (rounded)."""
    return np.maximum(_squares(x)[:, None] - 2 * (x @ q.T) + _squares(q), 0)


def _rounds(rows: DataFrame, id_col: str, vec_col: str, size: int) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, matrix) of at most ``size`` rows at a time. Vectors that are null,
    hold a null or have another length than the first take no part."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    few = rows.limit(size + 1).collect()  # one round's rows
    held, rest = (None, few) if len(few) <= size else (cut_lineage(rows, "query-rounds"), None)
    ids, vs, dims = [], [], None
    for r in held.toLocalIterator() if held else rest:
        dims = len(r["v"]) if dims is None else dims
        if len(r["v"]) == dims:
            ids.append(r["id"])
            vs.append(r["v"])
        if len(ids) == size:
            yield ids, _matrix(vs)
            ids, vs = [], []
    if ids:
        yield ids, _matrix(vs)
    if held:
        drop_state(rows.sparkSession, held)


class _Best:
    """The k best (distance, id) of every query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.limit = k, np.full(n, np.inf)
        self.rows = pd.DataFrame({"q": np.zeros(0, np.int64), "d": np.zeros(0), "id": np.zeros(0, object)})

    def add(self, q: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        new = pd.DataFrame({"q": q, "d": d, "id": ids})
        touched = self.rows["q"].isin(np.unique(q))
        best = pd.concat([self.rows[touched], new], ignore_index=True) if touched.any() else new
        best = best.sort_values(["q", "d", "id"], kind="stable").groupby("q", sort=False).head(self.k)
        place = best.groupby("q", sort=False).cumcount()
        full = best[place == self.k - 1]
        self.limit[full["q"].to_numpy()] = full["d"].to_numpy()
        self.rows = pd.concat([self.rows[~touched], best], ignore_index=True)


def _compare(x: np.ndarray, ids: np.ndarray, q: np.ndarray, at: np.ndarray, best: _Best) -> None:
    """Hold the vectors ``x`` against the queries ``q[at]``."""
    step = max(1, _CELLS // max(1, len(x)))
    for s in range(0, len(at), step):
        some = at[s:s + step]
        near = _products(q[some], x)
        slack = _SLACK * (_squares(q[some]) + _squares(x).max())
        kth = np.partition(near, best.k - 1, axis=1)[:, best.k - 1] if near.shape[1] >= best.k else np.full(len(some), np.inf)
        i, j = np.nonzero(near <= (np.minimum(kth, best.limit[some]) + slack)[:, None])
        d = _squares(x[j] - q[some[i]])
        keep = d <= best.limit[some[i]]
        best.add(some[i[keep]], d[keep], ids[j[keep]])


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows far from each other: each next one is the farthest from those
    before, of at most a thousand spread over ``x`` (any centres are right)."""
    some = x[:: -(-len(x) // 1024)]
    chosen, far = [0], _products(some, some[:1])[:, 0]
    while len(chosen) < min(n, len(some)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _products(some, some[chosen[-1]:chosen[-1] + 1])[:, 0])
    return some[chosen]


def _search_batch(x: np.ndarray, ids: np.ndarray, q: np.ndarray, best: _Best) -> int:
    """Search one batch of vectors; the number of pairs compared."""
    groups = min(GROUPS, len(q) // 2, len(x) // GROUP_ROWS)
    if groups < 2:
        _compare(x, ids, q, np.arange(len(q)), best)
        return len(x) * len(q)
    centres = _centres(x, groups)
    to_centre = np.sqrt(_products(x, centres))
    group = to_centre.argmin(1)
    own = to_centre[np.arange(len(x)), group]
    from_centre = np.sqrt(_products(q, centres))
    slack = np.sqrt(_SLACK * (_squares(q).max() + _squares(x).max()))
    compared, nearest = 0, from_centre.argmin(1)
    held = [np.flatnonzero(group == g) for g in range(len(centres))]

    def hold(g: int, at: np.ndarray) -> int:
        _compare(x[held[g]], ids[held[g]], q, at, best)
        return len(at) * len(held[g])

    for g in range(len(centres)):  # every query's own group first: it sets the limit
        if len(held[g]):
            compared += hold(g, np.flatnonzero(nearest == g))
    for g in range(len(centres)):
        if len(held[g]):
            # least distance from a query to anything between the group's radii
            least = np.maximum(from_centre[:, g] - own[held[g]].max(), own[held[g]].min() - from_centre[:, g]) - slack
            least = np.maximum(least, 0)
            compared += hold(g, np.flatnonzero((nearest != g) & (least * least <= best.limit)))
    return compared


def _search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str, qid_col: str, qvec_col: str,
            round_rows: int) -> DataFrame:
    """(qid, id, distance, pairs, compared): every task's k best per query, and
    a row a task and round that has the numbers of pairs instead."""
    spark = vectors.sparkSession
    kinds = T.StructType([T.StructField("qid", queries.schema[qid_col].dataType), T.StructField("id", vectors.schema[id_col].dataType),
                          T.StructField("distance", T.DoubleType()), T.StructField("pairs", T.LongType()), T.StructField("compared", T.LongType())])
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    out = None
    for qids, matrix in _rounds(queries, qid_col, qvec_col, round_rows):
        sent = spark.sparkContext.broadcast((qids, matrix))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            qids, q = sent.value
            best, pairs, compared = _Best(len(q), k), 0, 0
            for b in batches:
                if len(b):
                    pairs += len(b) * len(q)
                    compared += _search_batch(_matrix(b["v"]), b["id"].to_numpy(object), q, best)
            rows = best.rows
            yield pd.DataFrame({"qid": pd.Series([qids[i] for i in rows["q"]], dtype=object), "id": rows["id"].astype(object), "distance": rows["d"],
                                "pairs": pd.Series([None] * len(rows), dtype=object), "compared": pd.Series([None] * len(rows), dtype=object)})
            if pairs:
                yield pd.DataFrame({"qid": [None], "id": [None], "distance": [None], "pairs": [pairs], "compared": [compared]}, dtype=object)

        whole = v.where((F.size("v") == matrix.shape[1]) & ~F.exists("v", lambda x: x.isNull()))
        part = cut_lineage(whole.mapInPandas(run, kinds), "knn-round")
        sent.destroy()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], kinds) if out is None else out


def knn_l2(vectors: DataFrame, queries: DataFrame, k: int = 3, id_col: str = "id", vec_col: str = "embedding",
           qid_col: str = "qid", qvec_col: str = "embedding", round_rows: int = ROUND_ROWS) -> DataFrame:
    """Top-k by squared L2 (float64) per query: (qid, id, distance, rank);
    ties go to the lower id. No queries or no vectors: no rows. Vectors that
    are null, hold a null or have another length than the queries are no
    candidates. Queries pass through the driver ``round_rows`` at a time."""
    found = _search(vectors, queries, k, id_col, vec_col, qid_col, qvec_col, round_rows)
    found = found.where("pairs IS NULL").select("qid", "id", "distance")
    w = Window.partitionBy("qid").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_work(vectors: DataFrame, queries: DataFrame, k: int = 3, id_col: str = "id", vec_col: str = "embedding",
             qid_col: str = "qid", qvec_col: str = "embedding", round_rows: int = ROUND_ROWS) -> DataFrame:
    """One row: pairs of a vector and a query, those compared, and the share
    that the bounds spared."""
    found = _search(vectors, queries, k, id_col, vec_col, qid_col, qvec_col, round_rows)
    n = found.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))
    return n.withColumn("spared", F.when(F.col("pairs") > 0, 1 - F.col("compared") / F.col("pairs")).otherwise(F.lit(0.0)))


def knn_filtered(vectors: DataFrame, queries: DataFrame, k: int, where, **kw) -> DataFrame:
    """Metadata filter applied to the vectors before any distance."""
    return knn_l2(vectors.where(where), queries, k, **kw)


def mean_pool(df: DataFrame, group: str, vec: str = "embedding") -> DataFrame:
    """Mean vector per group in long form (group, dim, value): a partial
    aggregate over (group, dim), so one hot group is pre-summed map-side."""
    ex = df.select(group, F.posexplode(vec).alias("dim", "x"))
    return ex.groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("value"))


def pooled_vectors(long: DataFrame, group: str) -> DataFrame:
    """Long form -> one array per group (bounded by the dimension)."""
    return long.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"]).alias("embedding"))


def embedding_upsert(old: DataFrame, new: DataFrame, id_col: str, version: str) -> DataFrame:
    """Latest version per id over old union new (``max_by`` aggregate,
    combined map-side)."""
    u = old.unionByName(new)
    cols = [c for c in u.columns if c != id_col]
    best = u.groupBy(id_col).agg(F.max_by(F.struct(*cols), F.col(version)).alias("_r"))
    return best.select(id_col, *[F.col("_r")[c].alias(c) for c in cols])


def l2(a, b):
    """Squared L2 of two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2), F.lit(0.0), lambda t, x: t + x)


def retrieve_graph_boost(vectors: DataFrame, queries: DataFrame, neighbors: DataFrame, k: int) -> DataFrame:
    """The k best vectors per query, those in the query's graph neighbourhood
    first, then by distance, then id. Exact: the k best of the neighbourhood
    (distances of its pairs alone) beside the k best of all."""
    near = (neighbors.select("qid", "id").distinct().join(vectors.select("id", F.col("embedding").alias("v")), "id")
            .join(queries.select("qid", F.col("embedding").alias("q")), "qid")
            .select("qid", "id", l2(F.col("v"), F.col("q")).alias("distance"), F.lit(True).alias("near")))
    w = Window.partitionBy("qid").orderBy("distance", "id")
    near = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")
    far = knn_l2(vectors, queries, k).drop("rank").join(
        neighbors.select("qid", "id").distinct(), ["qid", "id"], "left_anti").withColumn("near", F.lit(False))
    both = Window.partitionBy("qid").orderBy(F.col("near").desc(), "distance", "id")
    return near.unionByName(far).withColumn("boost_rank", F.row_number().over(both)).where(F.col("boost_rank") <= k)


def compose_prompt(question: DataFrame, hits: DataFrame, snippet: str, k: int) -> DataFrame:
    """Question, then the ranked snippets (at most k per question)."""
    top = hits.where(F.col("rank") <= k)
    lst = top.groupBy("qid").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", F.col(snippet).alias("s")))),
        lambda x: F.concat(F.lit("["), x["rank"].cast("string"), F.lit("] "), x["s"])), "\n").alias("context"))
    return question.join(lst, "qid", "left").select(
        "qid", F.concat(F.lit("Question: "), F.col("question"), F.lit("\nContext:\n"),
                        F.coalesce("context", F.lit(""))).alias("prompt"))


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``c``, squared distance) nearest to each row of ``x``, the first
    of equals: candidates from a matrix product, measured again."""
    at, least = np.zeros(len(x), np.int64), np.zeros(len(x))
    step = max(1, _CELLS // max(1, len(c)))
    for s in range(0, len(x), step):
        some = x[s:s + step]
        near = _products(some, c)
        slack = _SLACK * (_squares(some) + _squares(c).max())
        i, j = np.nonzero(near <= (near.min(1) + slack)[:, None])
        d = _squares(some[i] - c[j])
        order = np.lexsort((j, d, i))
        first = order[np.unique(i[order], return_index=True)[1]]
        at[s:s + step], least[s:s + step] = j[first], d[first]
    return at, least


def assign_nearest(vectors: DataFrame, centers: DataFrame, id_col: str = "id", vec_col: str = "embedding",
                   cid_col: str = "qid", cvec_col: str = "embedding", round_rows: int = ROUND_ROWS) -> DataFrame:
    """Nearest center per vector id (squared L2): (id, center, distance), ties
    to the lower center. Centers come in rounds as the queries of
    :func:`knn_l2`; with more than one round the least per id is the answer."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    kinds = T.StructType([T.StructField("id", v.schema["id"].dataType), T.StructField("center", centers.schema[cid_col].dataType),
                          T.StructField("distance", T.DoubleType())])
    out, rounds = None, 0
    for cids, matrix in _rounds(centers, cid_col, cvec_col, round_rows):
        order = np.argsort(np.array(cids, dtype=object), kind="stable")
        sent, rounds = spark.sparkContext.broadcast(([cids[i] for i in order], matrix[order])), rounds + 1

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cids, c = sent.value
            for b in batches:
                if len(b):
                    at, least = _nearest(_matrix(b["v"]), c)
                    yield pd.DataFrame({"id": b["id"].astype(object), "center": pd.Series([cids[i] for i in at], dtype=object, index=b.index), "distance": least})

        whole = v.where((F.size("v") == matrix.shape[1]) & ~F.exists("v", lambda x: x.isNull()))
        part = cut_lineage(whole.mapInPandas(run, kinds), "nearest-round")
        sent.destroy()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], kinds)
    if rounds == 1:
        return out
    return out.groupBy("id").agg(F.min(F.struct("distance", "center")).alias("b")).select("id", "b.center", "b.distance")
