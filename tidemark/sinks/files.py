"""File and table writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """K1: parquet write; ``partition_by`` (e.g. month) enables partition pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """K3: managed table. ``bucket_by=(n, keys)`` stores the table bucketed on its key so
    later merges/upserts on that key join without a shuffle."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    w.saveAsTable(name)


def insert_rows(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K6: ``INSERT INTO table`` - by position, as SQL does; select the table's column
    order first when the frame's order may differ."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=overwrite)


def append_if_any(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Write only when there is at least one row. ``isEmpty`` stops at the first
    row instead of counting the whole input; the frame is cached so the write does not
    recompute the check's work."""
    d = df.persist()
    try:
        if d.isEmpty():
            return False
        write(d)
        return True
    finally:
        d.unpersist()
