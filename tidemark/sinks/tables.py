"""Keyed writes into stored parquet tables partitioned by month.

``replace_by_key_write`` is M5 at scale: only the month partitions the new rows touch
are read (a semi join on the partition column, so the scan is pruned), merged
(delete+insert by key), staged under the shared checkpoint folder and written back
with dynamic partition overwrite. Untouched months are never read or rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import table_or_none
from ..operators.mutate import replace_by_key
from ..session import materialize

MONTH = "mes"


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, F.trunc(F.col(date_col), "month"))


def replace_by_key_write(spark: SparkSession, new_rows: DataFrame, path: str, keys: Sequence[str],
                         date_col: str) -> None:
    new = with_month(new_rows, date_col)
    stored = table_or_none(spark, path)
    if stored is None:
        new.write.mode("overwrite").partitionBy(MONTH).parquet(path)
        return
    touched = new.select(MONTH).distinct()
    # null-safe: rows without a date share the null partition, which the overwrite replaces as a whole
    old = stored.join(touched.withColumnRenamed(MONTH, "__m"), F.col(MONTH).eqNullSafe(F.col("__m")), "left_semi")
    merged = materialize(replace_by_key(old, new.select(*old.columns), list(keys)), "merge-stage")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(MONTH).parquet(path))


def append_new_keys(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str],
                    date_col: str) -> bool:
    """Raw-layer append: rows must not collide with stored keys (primary key check T4,
    raising when they do); written only when there is at least one row (K11)."""
    from ..operators.quality import pk_conflicts
    from .files import append_if_any
    stored = table_or_none(spark, path)
    if stored is not None and not pk_conflicts(stored, rows, keys).isEmpty():
        raise ValueError(f"primary key conflict appending to {path}")
    return append_if_any(with_month(rows, date_col),
                         lambda d: d.write.mode("append").partitionBy(MONTH).parquet(path))


QUARANTINE = ["kind", "source_file", "reason", "record"]


def quarantine_write(spark: SparkSession, bad: DataFrame, path: str) -> int:
    """Append rejected rows (``QUARANTINE`` columns) that the quarantine table does not hold yet; how many rows
    this run rejected. A rerun over the same extract adds nothing, but rejects them again."""
    rows = materialize(bad.select(*QUARANTINE).distinct(), "rejected")
    n = rows.count()
    if n:
        stored = table_or_none(spark, path)
        if stored is not None:
            s = stored.select(*[F.col(c).alias(f"__{c}") for c in QUARANTINE])
            rows = materialize(rows.join(s, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in QUARANTINE], "left_anti"), "rejected-new")
        rows.withColumn("dt_ingestao", F.current_timestamp()).write.mode("append").partitionBy("kind").parquet(path)
    return n
