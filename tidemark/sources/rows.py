"""Small in-memory inputs (fixtures, parameters, lookup maps).

Driver-side rows are for small inputs only; bulk data comes from files (``files.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | Sequence[str] | str | None = None) -> DataFrame:
    """Dicts, tuples + column names (types inferred) or a declared ``StructType``
    (non-null key fields are enforced by ``createDataFrame``)."""
    if schema is None or isinstance(schema, (T.StructType, str)):
        return spark.createDataFrame(list(rows), schema)
    return spark.createDataFrame(list(rows), list(schema))


def from_pandas(spark: SparkSession, pdf, schema: T.StructType | None = None) -> DataFrame:
    """S3: pandas frame -> DataFrame (Arrow transfer when enabled)."""
    return spark.createDataFrame(pdf, schema)
