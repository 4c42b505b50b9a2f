"""Preparing a corpus for training: rejected, repeated and leaked text goes, then the sources are mixed.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and works on all that the one before kept,
which is written as Parquet and read again. All but the last return the columns of ``documents``.

Defined cases are those of the operators that the stages call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, line_dedup, mixing, simhash, toxicity
from tidemark.llm.common import scratch

#: SQL can't express the toxicity model, the fingerprints' hash or the sampling; the tests use brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; n_chars follows the text, null texts stay null."""
    done = line_dedup.dedupe_lines(docs)
    return done.select(*[F.col("text") if c == "text" else F.char_length("text").cast(docs.schema[c].dataType).alias(c)
                         if c == "n_chars" else F.col(f"row.{c}") for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken for the target mix of sources."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
