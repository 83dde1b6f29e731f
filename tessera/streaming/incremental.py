"""Incremental processing with Structured Streaming.

* ``incremental_enrich``: a file-source stream of new records; ids seen before
  are dropped by keyed state on disk (the RocksDB state store of the stream's
  checkpoint), so a micro-batch looks up its own ids and never reads the output
  again. A replayed batch overwrites its own output folder (idempotent), and a
  storage error fails the batch. With ``content`` the state knows the last
  content of each id, and changed ids are processed again.
* ``stream_call_stats``: running totals and mean latency of model calls as a
  streaming global aggregate (complete mode).
* ``changed_files``: new / changed / deleted / unchanged between two index
  snapshots (batch, full outer join on path).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def incremental_enrich(spark: SparkSession, source_dir: str, schema: T.StructType, output_dir: str,
                       checkpoint_dir: str, process=None, id_col: str = "id", fmt: str = "json",
                       max_files_per_trigger: int | None = None, content: str | None = None, order: str | None = None) -> None:
    """Process each id once over all runs that share ``checkpoint_dir``; runs
    until the currently available input is consumed (``availableNow``).

    With ``content``, an id is processed again whenever the text in that column
    is another than the last one seen; of several rows of an id in a batch the
    one with the greatest ``order`` counts (the greatest content, if not given).
    The state then holds a hash an id."""
    process = process or (lambda df: df)
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir)
    fresh = rows.dropDuplicates([id_col]) if content is None else (
        rows.groupBy(id_col).applyInPandasWithState(_changed(content, order or content, schema.names), schema, "sha string", "append",
                                                    GroupStateTimeout.NoTimeout))

    def run_batch(batch: DataFrame, epoch: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch={epoch}")

    q = (fresh.writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", checkpoint_dir)
              .trigger(availableNow=True).start())
    q.awaitTermination()


def _changed(content: str, order: str, names: list[str]):
    """The last row of an id in a batch, if its content isn't the one that the
    state knows."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            rows = b if last is None else pd.concat([last, b])
            # most ids have one row in a batch: nothing to sort
            last = rows if len(rows) == 1 else rows.sort_values(order, kind="stable", na_position="first").tail(1)
        sha = hashlib.sha256((last[content].iloc[0] or "").encode()).hexdigest()
        if not state.exists or state.get[0] != sha:
            state.update((sha,))
            yield last if list(last.columns) == names else last[names]
    return run


def read_output(spark: SparkSession, output_dir: str, latest: str | None = None) -> DataFrame:
    """All rows processed, with their ``batch``; of each ``latest`` id, if
    given, only those of the last batch that has it."""
    out = spark.read.option("basePath", output_dir).parquet(output_dir)
    if latest is None:
        return out
    rest = [c for c in out.columns if c != latest]
    return out.groupBy(latest).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(latest, *[F.col("_r")[c].alias(c) for c in rest])


def stream_call_stats(spark: SparkSession, source_dir: str, schema: T.StructType, checkpoint_dir: str,
                      prompts, tokens, latency: str, ts: str, query_name: str = "call_stats",
                      glob: str | None = None) -> DataFrame:
    """Streaming global aggregate (one row) in complete mode; the result is
    one row, kept in the memory sink and returned as a batch DataFrame."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    s = r.parquet(source_dir)
    agg = s.agg(F.count(F.lit(1)).alias("total_calls"), F.sum(prompts).cast("bigint").alias("total_prompts"),
                F.sum(tokens).cast("bigint").alias("total_tokens"),
                F.avg(latency).alias("average_latency_s"), F.max(ts).alias("last_update"))
    q = (agg.writeStream.outputMode("complete").format("memory").queryName(query_name)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(query_name)


def changed_files(old: DataFrame, new: DataFrame, path: str = "file_path", sha: str = "sha256") -> DataFrame:
    """(file_path, status) with status new / changed / deleted / unchanged."""
    o = old.select(F.col(path).alias("file_path"), F.col(sha).alias("old_sha"))
    n = new.select(F.col(path).alias("file_path"), F.col(sha).alias("new_sha"))
    j = o.join(n, "file_path", "full_outer")
    status = (F.when(F.col("old_sha").isNull(), "new").when(F.col("new_sha").isNull(), "deleted")
               .when(F.col("old_sha") != F.col("new_sha"), "changed").otherwise("unchanged"))
    return j.select("file_path", status.alias("status"))
