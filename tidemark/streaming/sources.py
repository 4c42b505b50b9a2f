"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def rate_source(spark: SparkSession, rows_per_batch: int | None = None,
                rows_per_second: int | None = None) -> DataFrame:
    """S10 + P16: synthetic counter stream projected as ``value AS id``.

    ``rows_per_batch`` uses ``rate-micro-batch`` (deterministic batches, for tests);
    otherwise the wall-clock ``rate`` source."""
    if rows_per_batch is not None:
        sdf = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", rows_per_batch).load())
    else:
        r = spark.readStream.format("rate")
        if rows_per_second:
            r = r.option("rowsPerSecond", rows_per_second)
        sdf = r.load()
    return sdf.selectExpr("value as id")


def table_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stored table (a directory of files) as a stream. New files are picked up
    per micro-batch; ``glob`` restricts which files count."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
