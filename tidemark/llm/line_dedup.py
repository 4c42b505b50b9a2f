"""Line de-duplication against levelled sorted runs of line hashes.

The index is a set of *runs*: tables of (key hash, owner document) bucketed and sorted by hash, one
file a bucket. The keys of a batch are written the same way and merge-anti-joined with the runs, bucket by
bucket: no run is shuffled or sorted again, whatever the number of batches. What is left becomes a
run of level 0, and when a level has ``fanout`` runs they are merged into one of the next level, bucket
by bucket too (the write puts each merged bucket in order), so each key is rewritten once per level. The first batch
that holds a key owns it; within a batch the smallest doc_id does. Batches cut by ascending doc_id therefore leave every
line with the smallest doc_id that holds it. Lines themselves are never dealt by the index: a line that a third of all documents
hold is one key there, and the join that marks its copies is split by size.

Key of a line: ASCII blanks stripped at both ends, A-Z lower-cased, 128-bit XXH3; keys under
``min_chars`` code points are not compared.

Defined cases: null and empty texts are one empty line; a null doc_id counts as one document after
all others; rows that repeat a doc_id are the same document (their lines never drop each other);
a line repeated inside its owner stays; an empty table gives no rows. Only the id and the text
are read; other columns pass through whatever their names."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, doc_key, remove, scratch

BLANK_BYTES = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The compared form of a line, or None if it is too short."""
    k = line.strip(BLANK_BYTES).lower()
    if len(k) < min_chars or len(k) < 4 * min_chars and len(k.decode()) < min_chars:
        return None
    return k


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, th, pos, hi, lo) per compared line of (d, th, text)."""
    schema = pa.schema([("d", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])

    def run(batches):
        for b in batches:
            d, th, pos, key = [], [], [], []
            for i, t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for p, line in enumerate((text or "").encode().split(b"\n")):
                    if (k := line_key(line, min_chars)) is not None:
                        d.append(i), th.append(t), pos.append(p), key.append(xxhash.xxh3_128_digest(k))
            h = np.frombuffer(b"".join(key), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((d, th, pos, h[:, 0], h[:, 1]), schema.types)],
                                             schema=schema)

    return docs.mapInArrow(run, "d long, th long, pos int, hi long, lo long")


@contextmanager
def _sorted_scans(spark: SparkSession):
    """Plans made inside read a bucket as one partition and trust its order where it is one file (Spark looks that up itself)."""
    conf = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class LineRuns:
    """The index: runs per level, as tables over files in a shared folder. ``add`` takes a batch of line hashes, returns
    the lines to drop and makes the batch part of the index; ``drop`` removes it."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 2, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path or scratch(spark, "line-runs"), fanout
        # the number that an aggregate by key deals into, so that its tasks write one file a bucket
        self.buckets = buckets or int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                                      or spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._tables: set[str] = set()

    def _write(self, keys: DataFrame) -> str:
        table = f"line_run_{uuid.uuid4().hex}"
        self._tables.add(table)
        with _sorted_scans(self.spark):
            (keys.write.format("parquet").option("compression", "zstd").option("path", f"{self.path}/{table}")
                 .bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").saveAsTable(table))
        return table

    def _remove(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(self.spark, f"{self.path}/{table}")
        self._tables.discard(table)

    def drop(self) -> None:
        for t in list(self._tables):
            self._remove(t)

    def runs(self) -> list[str]:
        """The tables of all runs; a key is in one of them."""
        return [t for level in self.levels for t in level]

    def _put(self, table: str, level: int) -> None:
        """Make a run part of a level; compact the level when it is full."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            while len(full) > 1:
                merged = self._write(self.merged(*full[:2]))
                for t in full[:2]:
                    self._remove(t)
                full = full[2:] + [merged]
            self._put(full[0], level + 1)

    def merged(self, one: str, two: str) -> DataFrame:
        """Two runs as one. They hold disjoint keys, so the full outer merge join only interleaves them."""
        b = self.spark.table(two).withColumnRenamed("owner", "other")
        return (self.spark.table(one).join(b.hint("merge"), ["hi", "lo"], "full")
                .select("hi", "lo", F.coalesce("owner", "other").alias("owner")))

    def unseen(self, keys: str) -> DataFrame:
        """The batch's keys (a table like a run) that no run holds."""
        out = self.spark.table(keys)
        for run in self.runs():
            out = out.join(self.spark.table(run).select("hi", "lo").hint("merge"), ["hi", "lo"], "left_anti")
        return out

    def contested(self, keys: str) -> DataFrame:
        """(hi, lo, owner) of the batch's keys that a document beside the owner holds; the batch is in the index."""
        out = None
        for run in self.runs():
            got = (self.spark.table(keys).join(self.spark.table(run).hint("merge"), ["hi", "lo"])
                   .where("first <> owner OR last <> owner").select("hi", "lo", "owner"))
            out = got if out is None else out.union(got)
        return out

    def add(self, lines: DataFrame) -> DataFrame:
        """(d, th, drop: positions) of the batch's lines owned by another document."""
        batch = self._write(lines.groupBy("hi", "lo").agg(F.min("d").alias("first"), F.max("d").alias("last")))
        self._put(self._write(self.unseen(batch).select("hi", "lo", F.col("first").alias("owner"))), 0)
        with _sorted_scans(self.spark):
            # sort-merge at every size: contested keys grow with the input, and the plan should not turn on their size
            drops = Written(lines.join(self.contested(batch).hint("merge"), ["hi", "lo"]).where("d <> owner")
                            .groupBy("d", "th", "pos").agg(F.lit(1).alias("one"))
                            .groupBy("d", "th").agg(F.collect_list("pos").alias("drop")), "line-drops").df
        self._remove(batch)
        return drops


def _without(text: pd.Series, drop: pd.Series) -> pd.Series:
    out = []
    for t, d in zip(text, drop):
        if t is None or d is None or not len(d):
            out.append(t)
            continue
        gone = set(d.tolist())
        out.append("\n".join([x for i, x in enumerate(t.split("\n")) if i not in gone]))
    return pd.Series(out, dtype=object)


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 batches: int = 4, fanout: int = 2) -> DataFrame:
    """(row: the input's columns, n_lines, n_dropped, text: what is left of it)."""
    spark = docs.sparkSession
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), doc_key(docs[id_col]).alias("d"),
                       F.xxhash64(docs[text_col]).alias("th"))
    cuts = sorted(set(docs.select(docs[id_col].cast("long").alias("d")).approxQuantile(
        "d", [i / batches for i in range(1, batches)], 0.02)))
    batch = F.lit(0)
    for c in cuts:
        batch = batch + (F.col("d") > int(c)).cast("int")
    text = F.col("row").getField(text_col)
    lines = Written(line_hashes(base.select("d", "th", text.alias("t")), min_chars).withColumn("batch", batch), "lines", "batch")
    index = LineRuns(spark, fanout=fanout)
    drops = None
    try:
        for i in range(len(cuts) + 1):
            got = index.add(lines.df.where(F.col("batch") == i))
            drops = got if drops is None else drops.union(got)
    finally:
        index.drop()
        lines.drop()
    out = base.join(drops.hint("merge"), ["d", "th"], "left").withColumn("t", text)  # the text travels once, in the row
    lost = F.coalesce(F.size("drop"), F.lit(0))
    n = F.size(F.split(F.coalesce("t", F.lit("")), "\n"))
    return out.select("row", n.cast("long").alias("n_lines"),
                      F.when(F.col("drop").isNull(), 0).otherwise(lost).cast("long").alias("n_dropped"),
                      F.pandas_udf(_without, "string")("t", "drop").alias("text"))
