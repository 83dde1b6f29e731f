"""Exact dedup by a stateful stream.

The texts arrive as a file stream. Keyed state on disk (the RocksDB state
store), which never expires, holds for every digest the row that stays: its
stable identifier, its content locator (file and row in it) and how many rows
had the digest. A batch of arrivals updates that state; what changed is appended
to a table of the run. A digest hit is only a candidate: the bytes at the
locator are compared with the hit's, and rows whose bytes differ form groups by
their full text.

Spark expressions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import scratch_path

from .common import lower_ascii, stage, text_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text_col: str = "text") -> Column:
    """The text that must be identical: A-Z lower-cased, null as empty."""
    return lower_ascii(text_of(text_col))


def _glob(path: str) -> str:
    """``path`` as a pattern that matches it alone: a stream over a pattern
    takes a single file as well as a folder of them."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def _rows(frame: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = normalised(text_col)
    return frame.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), digest(text).alias("digest"),
                        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def update_state(spark: SparkSession, path: str, state: str, id_col: str = "doc_id", text_col: str = "text",
                 digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the files at ``path`` that ``state`` (a folder on
    shared storage) hasn't seen, and return the state so far: digest, ``stays``
    (doc_id, file, row) and ``rows``. Later calls with the same folder go on
    from it; a batch that is run again after a failure replaces its rows."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a store is closed with its task: else each partition's files stay open on
    # its executor until maintenance comes round
    spark.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = _rows(reader.parquet(_glob(path)), id_col, text_col, digest).drop("text")
    kept = arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("stays"),
                                          F.count(F.lit(1)).alias("rows"))

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/updates/batch={number}")

    query = (kept.writeStream.outputMode("update").foreachBatch(append)
             .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    told = spark.read.parquet(f"{state}/updates")
    if not files_per_batch and query.lastProgress and query.lastProgress["batchId"] == 0:
        return told.select("digest", "stays", "rows")  # one batch: a row per digest
    return told.groupBy("digest").agg(F.max_by(F.struct("stays", "rows"), "batch").alias("s")).select("digest", "s.*")


def dedup(spark: SparkSession, path: str, state: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and ``file``/``row`` (the locator) of
    every row of the Parquet files at ``path``.

    Rows are equal when their texts are identical but for the case of A-Z; null
    counts as empty, and empty texts are equal. The row with the largest doc_id
    stays; a null doc_id is the smallest, and of rows that share doc_id the one
    with the largest locator stays. Other columns are not read. An empty table
    gives no rows."""
    schema = spark.read.parquet(path).schema
    rows = _rows(spark.read.parquet(path), id_col, text_col, digest)
    if not schema or spark.read.parquet(path).isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), "digest", "file", "row")
    known = stage(update_state(spark, path, state or scratch_path(spark, "llm-dedup"), id_col, text_col, digest,
                               files_per_batch), "dedup-state")
    repeated = known.filter("rows > 1")
    # hits: the full bytes of each group's rows beside those at the locator that stays
    members = stage(rows.join(repeated, "digest"), "dedup-members")
    stays = members.filter("doc_id <=> stays.doc_id and file = stays.file and row = stays.row")
    checked = members.join(stays.select("digest", F.col("text").alias("kept_text")), "digest")
    differ = checked.filter("text <> kept_text")
    verdicts = checked.filter("text = kept_text").select("digest", "doc_id", "file", "row", "stays")
    other = stage(differ.select("digest", "doc_id", "file", "row", "text"), "dedup-collisions")
    if other.isEmpty():  # every hit is a true copy: the state's groups stand
        grouped = repeated.select("digest", "stays", F.col("rows").alias("group_size"))
        slim = rows.select("doc_id", "digest", "file", "row").join(grouped, "digest", "left")
        return _verdict(slim)
    # rows of one digest with other bytes: the digest's group is counted again
    # without them, and they are grouped by their text
    true = verdicts.groupBy("digest").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("group_size"))
    rest = other.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("stays"),
                                               F.count(F.lit(1)).alias("group_size"))
    odd = other.join(rest, ["digest", "text"]).select("doc_id", "digest", "file", "row", "stays", "group_size")
    slim = (rows.select("doc_id", "digest", "file", "row").join(other.select("file", "row"), ["file", "row"], "left_anti")
            .join(true, "digest", "left").select("doc_id", "digest", "file", "row", "stays", "group_size"))
    return _verdict(slim.unionByName(odd))


def _verdict(slim: DataFrame) -> DataFrame:
    alone = F.col("stays").isNull()
    own = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("file") == F.col("stays.file")) & (F.col("row") == F.col("stays.row"))
    return slim.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                       (alone | own).alias("kept"), "digest", "file", "row")
