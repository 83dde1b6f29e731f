"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing, packing.

Each stage takes all rows that its predecessor kept. All but the last return the
columns of ``documents``: toxic documents go, frequent lines leave the texts, one
document of each near-duplicate group stays, and sources are taken up to their
targets (a document comes once for each time that the mix takes it). The last
returns the packed pieces. Null and repeated rows, empty texts, empty tables and
further columns are handled as the operators' docstrings say; further columns of
``documents`` pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import line_dedup, mixing, packing, queries, simhash, toxicity
from tessera.session import cut_lineage, load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.learn(docs, load(spark, sf_dir, "labels")))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(docs, queries.tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the fitted scores, the fingerprints' components and the
#: tokenizer; tests/llm compares the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = cut_lineage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
