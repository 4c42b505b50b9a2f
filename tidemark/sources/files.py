"""File and catalog readers."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EXTRACTS


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and projections are pushed into it by Catalyst)."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema every column is text (no inference
    pass over the data); with one the values are typed on read."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def _extract_schema(kind: str) -> T.StructType:
    if kind not in EXTRACTS:
        raise ValueError(f"unknown extract kind {kind!r}; one of {sorted(EXTRACTS)}")
    if EXTRACTS[kind] is None:              # company info: all fields text
        from ..plans.equities import info_schema
        return info_schema()
    return EXTRACTS[kind]


def read_extract(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> DataFrame:
    """Landed market extracts of one ``kind`` for all tickers/series in one scan.

    The reference calls a web API once per ticker on the driver; here the fetcher's files
    (JSON lines or parquet, any number, any layout under ``path``) are read as one
    distributed scan with the declared schema; ``source_file`` tells rows apart."""
    df = (spark.read.schema(_extract_schema(kind)).option("recursiveFileLookup", True)
          .format(fmt).load(path))
    return df.withColumn("source_file", F.col("_metadata.file_name"))


CORRUPT = "_corrupt_record"


def read_extract_checked(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """S9 with its rejects: ``(good, bad)`` of one scan's declaration.

    ``good`` has the columns of ``read_extract`` and only records that the declared schema reads in full. ``bad`` has
    (kind, source_file, reason, record): ``broken line`` for text that is no JSON, ``wrong type`` for a record with a value that
    its column can't hold. Parquet files carry their schema, so nothing is bad there."""
    if fmt != "json":
        good = read_extract(spark, kind, path, fmt)
        return good, good.select(F.lit(kind).alias("kind"), "source_file", F.lit("").alias("reason"), F.lit("").alias("record")).filter("false")
    schema = _extract_schema(kind)
    df = (spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
          .option("recursiveFileLookup", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
          .withColumn("source_file", F.col("_metadata.file_name")))
    # the record's columns are named beside it, as Spark reads the text of a bad record only together with them
    read = F.to_json(F.struct(*schema.names))
    reason = F.when(F.try_parse_json(CORRUPT).isNull(), F.lit("broken line")).otherwise(F.lit("wrong type"))
    bad = (df.filter(F.col(CORRUPT).isNotNull() & read.isNotNull())
           .select(F.lit(kind).alias("kind"), "source_file", reason.alias("reason"), F.col(CORRUPT).alias("record")))
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def read_extract_or_none(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> DataFrame | None:
    """``read_extract``, or None (logged) when Spark finds nothing at ``path``. The read itself decides, so any
    file system that Spark reaches works; every other error is raised."""
    return _if_found(read_extract, spark, kind, path, fmt)


def read_checked_or_none(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame] | None:
    """``read_extract_checked``, or None (logged) when Spark finds nothing at ``path``."""
    return _if_found(read_extract_checked, spark, kind, path, fmt)


def _if_found(read, spark, kind, path, fmt):
    try:
        return read(spark, kind, path, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        logging.getLogger(__name__).warning("no %s extract at %s", kind, path)
        return None
