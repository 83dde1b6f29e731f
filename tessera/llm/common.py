"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tessera.session import cut_lineage, load

#: Fixed by the query contracts: the white space that parts words and pads lines.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def arrow_limits(spark: SparkSession, rows: int = 2000, mb: int = 10) -> None:
    """Bound one Arrow batch by rows and by bytes, so that a Python worker's
    memory follows the batch and not the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: a
    lost executor costs the tasks since this point and not the whole plan."""
    return cut_lineage(df, f"llm-{name}")


def lower_ascii(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character unchanged.
    ``lower`` agrees with that on texts of ASCII alone, and is faster."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
             .otherwise(F.translate(c, UPPER, UPPER.lower())))


def text_of(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def byte_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each value; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def buckets_for(n_rows: int, per_bucket: int) -> int:
    return max(1, -(-n_rows // per_bucket))


def running_number(df: DataFrame, groups: list[str], order: list[Column], spread: Column,
                   n_buckets: int, name: str) -> DataFrame:
    """Gapless numbers from 0 in each group. A group of any size is split by
    ``spread`` into ``n_buckets`` buckets; a bucket's first number is the
    prefix sum of the bucket counts, so no task holds a whole group."""
    df = df.withColumn("_b", F.pmod(spread, F.lit(n_buckets)).cast("int"))
    counts = df.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(*groups, "_b", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    keys = [*groups, "_b"]
    left = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    first = first.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first")
    on = [left[k].eqNullSafe(first[f"_k_{k}"]) for k in keys]
    joined = left
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (joined.join(first, cond)
            .withColumn(name, (F.col("_first") + F.col("_r") - 1).cast("long"))
            .drop("_b", "_r", "_first", *[f"_k_{k}" for k in keys]))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_row(docs: DataFrame, without: list[str] = ()) -> Column:
    """The columns of ``docs`` as one struct (its fields numbered), so that an
    operator's own columns beside it can't clash with them, whatever their
    names."""
    fields = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in without]
    return F.struct(F.lit(True).alias("here"), *fields)


def from_row(docs: DataFrame, row: str = "row", replace: dict[str, Column] | None = None, without: list[str] = ()) -> list[Column]:
    """The columns of ``docs`` again, in their order, some replaced."""
    replace = replace or {}
    return [(replace[c] if c in replace else F.col(row)[f"c{i}"]).alias(c) for i, c in enumerate(docs.columns) if c not in without]


def row_order(docs: DataFrame, without: list[str]) -> Column:
    """What orders rows that agree in the columns ``without``: their others as
    text, so a rerun orders them alike."""
    rest = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in without]
    return F.to_json(F.struct(*rest)) if rest else F.lit("")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")
