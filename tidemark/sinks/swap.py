"""K3, C4, M4: whole fact tables replaced by moving a pointer.

A new state is written as a bucketed table beside the current one, tested by metrics observed
during that write, and taken over by ``ALTER TABLE ... SET LOCATION``. Nothing is deleted before
the new state stands, so a run that dies at any point leaves the current table readable; its
staged leftovers go with the next ``clean_leftovers``. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..operators.mutate import unique_source, upsert_changed
from ..operators.quality import observe_checks

STAGE = "__stage_"


@dataclass(frozen=True)
class Staged:
    """A state that is written but not yet the table: its own catalog name, its folder and the metrics of its write
    (``rows`` and one count of failing rows per check)."""

    table: str
    path: str
    metrics: Mapping[str, int]


def _text(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """``DESCRIBE FORMATTED`` as a dictionary (location, number of buckets and so on)."""
    return {r["col_name"].strip(): r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}


def stage_table(df: DataFrame, name: str, base: str, keys: Sequence[str], buckets: int,
                checks: Mapping[str, str | Column] | None = None) -> Staged:
    """Write ``df`` as table ``<name>__stage_<id>``, bucketed and sorted by ``keys``, in a fresh folder under ``base``.

    The rows must already be dealt into ``buckets`` partitions by the keys (``dealt``, or a join with a table of this
    bucketing): every task then writes one file. The checks are counted by the write itself, without another job."""
    tag = uuid.uuid4().hex
    table, path = f"{name}{STAGE}{tag}", f"{base.rstrip('/')}/{name.split('.')[-1]}/{tag}"
    seen = Observation(f"stage-{tag}")
    (observe_checks(df, seen, checks or {}).write.format("parquet").mode("errorifexists").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return Staged(table, path, seen.get)


def swap(spark: SparkSession, name: str, staged: Staged) -> None:
    """Make the staged state the table: one change in the catalog. The files of the state before stay for readers that
    have planned already, until ``clean_leftovers``."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_text(staged.path)}'")
        spark.sql(f"DROP TABLE {staged.table}")           # external: its files are the table's now
    else:
        spark.sql(f"ALTER TABLE {staged.table} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def discard(spark: SparkSession, staged: Staged) -> None:
    """Drop a staged state and its files; the table stays as it is."""
    spark.sql(f"DROP TABLE IF EXISTS {staged.table}")
    _delete(spark, staged.path)


def dealt(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows dealt as a table bucketed by ``keys`` deals them, so a join or a write with that table moves them once."""
    return df.repartition(buckets, *keys)


def upsert_plan(spark: SparkSession, name: str, rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The next state of table ``name``: M4 into the stored rows, or the rows alone when there is no table yet. Only ``rows``
    are exchanged; the stored side is read bucket by bucket."""
    if not spark.catalog.tableExists(name):
        return unique_source(dealt(rows, keys, buckets), keys, f"first load of {name}")
    stored = spark.table(name)
    types = {f.name: f.dataType for f in stored.schema.fields}
    rows = rows.select(*[rows[c].cast(types[c]).alias(c) for c in stored.columns])   # equal types hash alike
    return upsert_changed(stored, dealt(rows, keys, buckets), keys)


def upsert_table(spark: SparkSession, name: str, rows: DataFrame, keys: Sequence[str], base: str, buckets: int = 32,
                 checks: Mapping[str, str | Column] | None = None) -> dict[str, int]:
    """M4 into the stored table ``name`` (``database.table``): stage, test, swap. Returns the metrics of the write.

    A check that any row of the new state fails discards it and raises ``AssertionError``; the table stays as it was. The
    bucket count of a stored table is kept: ``buckets`` is for the first load."""
    if spark.catalog.tableExists(name):
        buckets = int(described(spark, name)["Num Buckets"])
    staged = stage_table(upsert_plan(spark, name, rows, keys, buckets), name, base, keys, buckets, checks)
    failed = {c: staged.metrics[c] for c in checks or {} if staged.metrics[c]}
    if failed:
        discard(spark, staged)
        raise AssertionError(f"data tests failed for {name}, rows: {failed}")
    swap(spark, name, staged)
    return dict(staged.metrics)


def clean_leftovers(spark: SparkSession, name: str, base: str) -> list[str]:
    """Drop the staged tables of ``name`` that no run took over, and delete every folder under the table's own that is not
    its current location. Returns the deleted folders. Call it when no reader or writer of the table is running."""
    db, short = name.split(".") if "." in name else (spark.catalog.currentDatabase(), name)
    for r in spark.sql(f"SHOW TABLES IN {db} LIKE '{short}{STAGE}*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {db}.{r['tableName']}")
    keep = described(spark, name)["Location"].rstrip("/").rsplit("/", 1)[-1] if spark.catalog.tableExists(name) else None
    fs, root = _fs(spark, f"{base.rstrip('/')}/{short}")
    if not fs.exists(root):
        return []
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() != keep]
    for p in old:
        fs.delete(p, True)
    return sorted(p.toString() for p in old)


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)
