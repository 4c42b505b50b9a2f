"""Databases, tables, views and column comments in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import RAW_SCHEMAS


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def ensure_database(spark: SparkSession, db: str, use: bool = False) -> list[str]:
    """Create if missing, optionally ``USE`` it; returns the database list."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(db)}")
    if use:
        spark.sql(f"USE {_q(db)}")
    return [r[0] for r in spark.sql("SHOW DATABASES").collect()]


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """``SHOW TABLES IN db``."""
    return [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {_q(db)}").collect()]


def describe(spark: SparkSession, table: str) -> DataFrame:
    """``DESCRIBE FORMATTED``."""
    return spark.sql(f"DESCRIBE FORMATTED {_q(table)}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                     for f in schema.fields)


def ensure_external(spark: SparkSession, name: str, schema: T.StructType, path: str,
                    fmt: str = "parquet", partitioned_by: tuple[str, ...] = ()) -> None:
    """External table with a declared schema at ``path`` (dropping it keeps the
    files)."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} ({_ddl(schema)}) USING {fmt}{part} LOCATION '{path}'")


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """C4: register an existing data directory; the schema comes from the files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} USING {fmt} LOCATION '{path}'")


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``."""
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def create_view(df: DataFrame, name: str) -> None:
    """Temp view, queryable by SQL."""
    df.createOrReplaceTempView(name)


# Raw table -> the job's kind of extract, whose folder below ``raw/`` it stands on.
RAW_TABLES = {"indices_sgs": "macro", "cotacao_moedas": "fx", "cotacoes_indices": "quotes"}
# The public SGS codes of the three macro series, each a view on the one macro table.
SERIES_VIEWS = {"cdi": 12, "ipca": 433, "igpm": 189}
MONTH = "mes"


def bootstrap_raw(spark: SparkSession, base_path: str, db: str = "raw") -> list[str]:
    """Idempotent raw layer: the database and its keyed tables, each skipped when present. The tables are external,
    ``PARTITIONED BY`` the month and stand on the folders below ``base_path/raw`` that the macro job writes, so
    ``bootstrap_raw``, ``macro.run_job(raw_db=...)`` and ``macro.publish`` work on the same rows. The three macro series share one
    table and are views of it. Keys are checked on append by ``quality.pk_conflicts``. Returns what the
    fetchers name: the series and the two quote tables."""
    ensure_database(spark, db)
    for t, kind in RAW_TABLES.items():
        schema = T.StructType(RAW_SCHEMAS[kind].fields + [T.StructField(MONTH, T.DateType())])
        ensure_external(spark, f"{db}.{t}", schema, f"{base_path.rstrip('/')}/raw/{kind}", partitioned_by=(MONTH,))
    cols = ", ".join(f"`{c}`" for c in RAW_SCHEMAS["macro"].names)
    for view, code in SERIES_VIEWS.items():
        spark.sql(f"CREATE VIEW IF NOT EXISTS {_q(f'{db}.{view}')} AS SELECT {cols} FROM {_q(f'{db}.indices_sgs')} WHERE cod_sgs = {code}")
    return sorted([*SERIES_VIEWS, *(t for t in RAW_TABLES if t != "indices_sgs")])


def add_months(spark: SparkSession, table: str, rows: DataFrame, date_col: str) -> int:
    """Make the months of ``rows`` partitions of ``table`` (``ALTER TABLE ... ADD PARTITION``), without listing the others. What
    reaches the driver is one value per calendar month."""
    months = [r[0] for r in rows.select(F.trunc(date_col, "month")).distinct().collect() if r[0] is not None]
    if months:
        parts = " ".join(f"PARTITION ({MONTH} = DATE'{m.isoformat()}')" for m in sorted(months))
        spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {parts}")
        spark.catalog.refreshTable(table)
    return len(months)


def comment_columns(spark: SparkSession, table: str, comments: Mapping[str, str]) -> None:
    """Column comments (the gold model's documentation)."""
    for col, text in comments.items():
        esc = text.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {_q(table)} ALTER COLUMN `{col}` COMMENT '{esc}'")
