"""Helpers shared by the document operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a maximal run of anything but ASCII blanks; the class of the blanks.
BLANKS = r"\x20\x09-\x0D"
#: Stands for a missing document id: such rows are one document that sorts after all others.
NO_ID = 2**63 - 1


def doc_key(id_col: Column) -> Column:
    """The id as long; rows without one sort last."""
    return F.coalesce(id_col.cast("long"), F.lit(NO_ID))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+")
    return F.filter(parts, lambda w: w != "")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-scratch/{tag}-{uuid.uuid4().hex}"


class Written:
    """A frame written once as Parquet in the shared folder: the plan below it is cut and it
    outlives any executor. ``drop()`` removes the files when the owner has no more use for it."""

    def __init__(self, df: DataFrame, tag: str, partition_by: str | None = None):
        self.spark, self.path = df.sparkSession, scratch(df.sparkSession, tag)
        out = df.write.option("compression", "zstd")
        (out.partitionBy(partition_by) if partition_by else out).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own through Spark's file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """Connected components of an undirected graph of longs.

    ``edges`` (a, b) -> (node, root): ``root`` is the smallest node reachable. Alternating
    large-star and small-star rounds; each is two joins and a map-side combined minimum, so a
    node of any degree is never gathered in one task. Every round is written to the shared
    folder, the one before it removed."""
    now = Written(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "edges")
    seen = None
    while True:
        both = now.df.union(now.df.selectExpr("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        star = Written(large, "large")
        low = star.df.groupBy("u").agg(F.min("v").alias("m"))
        small = (star.df.join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v")
                 .union(low.selectExpr("u", "m AS v"))
                 .selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct())
        after = Written(small, "small")
        star.drop()
        now.drop()
        now = after
        mark = now.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.df.selectExpr("u AS node", "v AS root")
    return roots.union(roots.selectExpr("root", "root").distinct())
