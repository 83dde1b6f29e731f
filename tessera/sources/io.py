"""Sources and sinks: file trees, text decoding, JSON Lines, caches.

Trees are listed level by level as Spark jobs into a manifest of paths, and
files are read by that manifest. Unlike Spark's own listing this keeps names
that start with ``_`` or ``.``; only ``.git`` folders are pruned.
"""

from __future__ import annotations

import hashlib
import json
import os

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import metrics as M
from ..session import cut_lineage, drop_state
from .publish import publish, resolve, versions

_ENTRY = "path string, is_dir boolean, length long, modified double"


def _exts(extensions) -> list[str]:
    return sorted({(e if e.startswith(".") else "." + e).lower() for e in extensions})


def _uri(path: str) -> str:
    return path.rstrip("/") if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:"))


def _children(batches):
    """The entries of each folder of a batch."""
    for pdf in batches:
        rows = []
        for uri in pdf["path"]:
            fs, base = pafs.FileSystem.from_uri(uri)
            for x in fs.get_file_info(pafs.FileSelector(base)):
                rows.append((f"{uri}/{x.base_name}", x.type == pafs.FileType.Directory, x.size,
                             x.mtime.timestamp() if x.mtime else None))
        yield pd.DataFrame(rows, columns=["path", "is_dir", "length", "modified"])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of every file below ``root``: one job for each
    level of folders, whose listings stay on the executors."""
    level = spark.createDataFrame([(_uri(root),)], "path string")
    files = None
    while True:
        n = max(1, min(level.count(), spark.sparkContext.defaultParallelism * 4))
        found = cut_lineage(level.repartition(n).mapInPandas(_children, _ENTRY), "manifest")
        here = found.where(~F.col("is_dir")).drop("is_dir")
        files = here if files is None else files.unionByName(here)
        level = found.where("is_dir").where(M.file_name("path") != ".git").select("path")
        if level.isEmpty():
            return files


def _contents(batches):
    for pdf in batches:
        def read(uri):
            fs, path = pafs.FileSystem.from_uri(uri)
            with fs.open_input_stream(path) as f:
                return f.read()
        for i in range(len(pdf)):  # one file in memory at a time
            yield pdf.iloc[i:i + 1].assign(content=[read(pdf["path"].iloc[i])])


def scan_files(spark: SparkSession, root: str, extensions=None, with_content: bool = True) -> DataFrame:
    """Every file of a tree with a case-insensitive suffix filter.

    Columns: path (URI), file_path (local path, or the URI elsewhere),
    relative_path, length, modified and content (binary)."""
    base = _uri(root)
    df = (manifest(spark, root).withColumn("file_path", F.regexp_replace("path", "^file://", ""))
          .withColumn("relative_path", F.substring(F.col("path"), F.lit(len(base) + 2), F.length("path"))))
    if extensions:
        df = df.where(M.suffix("file_path").isin(*_exts(extensions)))
    if with_content:
        df = df.mapInPandas(_contents, T.StructType(df.schema.fields + [T.StructField("content", T.BinaryType())]))
    return df


def decode_text(content: Column) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1 (every byte maps)."""
    return F.when(F.is_valid_utf8(content), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def file_index(spark: SparkSession, root: str, extensions) -> DataFrame:
    """The file index record: name, path, size, mtime, extension, relative
    path, sha256 (content is hashed inside the scan task)."""
    f = scan_files(spark, root, extensions)
    return f.select(
        M.file_name("file_path").alias("file_name"), "file_path",
        F.col("length").alias("file_size"), F.timestamp_seconds("modified").alias("last_modified_time"),
        F.lit(None).cast("timestamp").alias("file_creation_time"),
        M.extension("file_path").alias("file_extension"), F.col("relative_path").alias("repo_relative_path"),
        M.content_sha256("content").alias("sha256"))


def read_source_files(spark: SparkSession, root: str, extensions) -> DataFrame:
    """(file_path, text) with UTF-8 / Latin-1 decoding."""
    f = scan_files(spark, root, extensions)
    return f.select("file_path", decode_text(F.col("content")).alias("text"))


def read_jsonl_lenient(spark: SparkSession, path: str, schema: T.StructType, count_bad: bool = False) -> DataFrame:
    """Blank and malformed lines are skipped (DROPMALFORMED); with
    ``count_bad`` they are kept in ``_corrupt_record`` instead. Of a published
    output (:func:`write_jsonl_atomic`) the current version is read."""
    path = resolve(spark, path)
    if count_bad:
        s = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        return (spark.read.schema(s).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_jsonl_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Any bad line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(resolve(spark, path))


def write_jsonl_atomic(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """JSON Lines, UTF-8 unescaped, as a new version of ``path`` that one step
    publishes (:mod:`.publish`): until then, and if the write fails, readers
    find the rows that were there before."""
    out = df if partitions is None else df.repartition(partitions)
    publish(df.sparkSession, path, lambda folder: out.write.option("ignoreNullFields", "false").json(folder))


def load_training_json(spark: SparkSession, path: str, schema: T.StructType, dry_run: bool = False):
    """Dataset load; ``dry_run`` returns only (rows, columns) statistics."""
    df = spark.read.schema(schema).json(resolve(spark, path))
    if dry_run:
        return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(schema.fields)))
    return df


def content_version(df: DataFrame) -> str:
    """A version of a table's rows, whatever their order."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return f"{r.n}-{r.s}"


def token_cache(spark: SparkSession, base: str, rows: DataFrame, text: str, params: dict, tokenize) -> DataFrame:
    """``rows`` (without ``text``) beside the cached windows of their texts.

    The cache under ``base`` is addressed by content: a row a window, keyed by
    the SHA-256 of the whole text, one cache for each set of ``params``. Texts
    that it lacks are found by an anti-join on the key alone; only these are
    tokenized, each once, and appended as a folder of their own that one step
    publishes. ``tokenize`` takes (key, text) and returns key, ``window`` and
    further columns. Null texts count as empty."""
    store = f"{base.rstrip('/')}/tokens-{hashlib.sha1(json.dumps(params, sort_keys=True).encode()).hexdigest()[:16]}"
    keyed = rows.withColumn("key", F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    parts = versions(spark, store)
    missing = keyed.select("key", F.coalesce(F.col(text), F.lit("")).alias("text"))
    if parts:
        missing = missing.join(spark.read.parquet(*parts).select("key"), "key", "left_anti")
    missing = cut_lineage(missing.dropDuplicates(["key"]), "token-misses")
    if not missing.isEmpty():
        publish(spark, store, lambda folder: tokenize(missing).write.parquet(folder), keep=None)
    drop_state(spark, missing)
    parts = versions(spark, store)
    if not parts:  # no rows: the columns are the tokenizer's
        none = spark.createDataFrame([], "key string, text string")
        return keyed.drop(text).join(tokenize(none), "key").drop("key")
    # two runs at a time may both have added a text; its windows are the same
    cache = spark.read.parquet(*parts).repartition("key").dropDuplicates(["key", "window"])
    return keyed.drop(text).join(cache, "key").drop("key")
