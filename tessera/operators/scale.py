"""Scale helpers: distributed global ranks and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage


def _in_order(df: DataFrame, order: list[str], n_parts: int | None) -> DataFrame:
    """``df`` sorted over partitions and written once, with ``_pid`` (numbers
    in order) and ``_local`` (a row's place in its partition, from 0).

    ``monotonically_increasing_id`` counts the rows of a partition in order."""
    n_parts = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    return cut_lineage(s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)).drop("_mid"), "ranked")


def global_rank(df: DataFrame, order: list[str], n_parts: int | None = None, name: str = "rank") -> DataFrame:
    """Exact 1-based rank in ``order`` without a single-partition window.

    Range-partition + sort within partitions (Spark's distributed sort), the
    row's place inside its partition, per-partition counts (one row per
    partition), their prefix sums, then offset + local index. The order keys
    must be unique for the rank to be deterministic."""
    s = _in_order(df, order, n_parts)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    return (s.join(F.broadcast(offs), "_pid")
             .withColumn(name, F.col("_off") + F.col("_local") + 1)
             .drop("_pid", "_local", "_off"))


def running(df: DataFrame, order: list[str], sums: dict[str, str], maxima: dict[str, str] | None = None,
            n_parts: int | None = None, chunk_rows: int = 20_000) -> DataFrame:
    """``df`` with running totals in ``order``: of every row the sums and maxima
    (names -> columns) of all rows up to it, as by ``rows unbounded preceding``,
    but no task holds more than a chunk of the sorted rows.

    A prefix scan: running values inside chunks of ``chunk_rows`` rows, the
    chunks' totals, their prefixes inside a partition and over the partitions
    (a row each), and the prefix joined back to the chunk. The order keys must
    be unique; sums and maxima pass over nulls (null before the first value)."""
    maxima = maxima or {}
    s = _in_order(df, order, n_parts).withColumn("_chunk", F.expr(f"_local div {chunk_rows}"))
    fold = {**{n: (F.sum, c) for n, c in sums.items()}, **{n: (F.max, c) for n, c in maxima.items()}}
    inside = Window.partitionBy("_pid", "_chunk").orderBy("_local").rowsBetween(Window.unboundedPreceding, 0)
    rows = s.select("*", *[f(c).over(inside).alias(f"_in_{n}") for n, (f, c) in fold.items()])
    chunks = s.groupBy("_pid", "_chunk").agg(*[f(c).alias(n) for n, (f, c) in fold.items()])
    earlier = Window.partitionBy("_pid").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_pid", "_chunk", *[f(n).over(earlier).alias(f"_c_{n}") for n, (f, _) in fold.items()])
    parts = s.groupBy("_pid").agg(*[f(c).alias(n) for n, (f, c) in fold.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    parts = parts.select("_pid", *[f(n).over(before).alias(f"_p_{n}") for n, (f, _) in fold.items()])
    out = rows.join(chunks.join(F.broadcast(parts), "_pid"), ["_pid", "_chunk"])

    def combined(n):
        a = [F.col(f"_p_{n}"), F.col(f"_c_{n}"), F.col(f"_in_{n}")]
        if n in maxima:
            return F.greatest(*a)  # passes over nulls
        zero = F.lit(0)
        return F.when(F.coalesce(*a).isNotNull(), sum((F.coalesce(x, zero) for x in a[1:]), F.coalesce(a[0], zero)))
    return out.select(*df.columns, *[combined(n).alias(n) for n in fold])
