"""A2 high-watermark and I2 incremental filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_watermark(df: DataFrame | None, column: str):
    """A2: ``max(column)`` as a Python value; ``None`` when the table is missing
    (``df is None``) or empty. Other errors propagate (Q12)."""
    if df is None:
        return None
    return df.agg(F.max(column)).first()[0]


def footer_watermark(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A2 on a stored Parquet table as one row (``high_watermark``): the scan takes the largest value from the file footers and
    reads no row group. The push-down belongs to the V2 file source, so the plan is made in a session of its own, with the
    caller's time zone. For dates and numbers; timestamps and text, whose
    footer statistics Spark does not trust, are aggregated from that one column."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(column).alias("high_watermark"))


def series_state(rows: DataFrame, series: str, date: str, value: str, kind: str) -> DataFrame:
    """What an increment needs of the stored rows: (kind, series, last_date, last_value), one row per series."""
    return rows.groupBy(F.col(series).cast("string").alias("series")).agg(
        F.max(date).alias("last_date"), F.max_by(F.col(value), F.col(date)).alias("last_value")).select(
        F.lit(kind).alias("kind"), "series", "last_date", "last_value")


def merge_state(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """The state after ``fresh`` (a state of newer rows) arrived: per series the later row of the two."""
    return (state.unionByName(fresh).groupBy("kind", "series")
            .agg(F.max("last_date").alias("last_date"), F.max_by("last_value", "last_date").alias("last_value")))


def newer_than_state(rows: DataFrame, state: DataFrame, series: str, date: str, kind: str, scope: str = "series",
                     watermark=None) -> DataFrame:
    """I2 by state: rows newer than the ``watermark`` (``scope="global"``: a literal, so it reaches the scan), or than their
    own series' last date (a small table joined by series); a series without a state loads everything."""
    if scope == "global":
        return rows if watermark is None else rows.filter(F.col(date) > F.lit(watermark))
    own = state.filter(F.col("kind") == kind).select(F.col("series").alias("__series"), F.col("last_date").alias("__wm"))
    return (rows.join(own, F.col(series).cast("string").eqNullSafe(F.col("__series")), "left")
            .filter(F.col("__wm").isNull() | (F.col(date) > F.col("__wm"))).drop("__series", "__wm"))


def table_or_none(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame | None:
    """A catalog table or a stored path, or None when it does not exist."""
    if spark.catalog.tableExists(name_or_path) if "/" not in name_or_path else False:
        return spark.table(name_or_path)
    try:
        return spark.read.format(fmt).load(name_or_path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def newer_than_target(src: DataFrame, tgt: DataFrame | None, column: str,
                      target_column: str | None = None, scope: str = "global",
                      series: Sequence[str] = (), target_series: Sequence[str] | None = None) -> DataFrame:
    """Source rows newer than the target's ``max`` date.

    ``scope="global"`` (the reference): one ``max`` over the whole target, as a scalar
    subquery that Catalyst pushes into the source scan. ``scope="series"``: one
    watermark per series key (a small grouped aggregate joined back). A missing or empty
    target loads everything (an empty target would load nothing in the reference, Q6)."""
    if tgt is None:
        return src
    tcol = target_column or column
    if scope == "global":
        m = tgt.select(F.max(tcol)).scalar()
        return src.filter(m.isNull() | (F.col(column) > m))
    if scope != "series":
        raise ValueError("scope must be 'global' or 'series'")
    series = list(series)
    tseries = list(target_series or series)
    wm = tgt.groupBy(*[F.col(a).alias(b) for a, b in zip(tseries, series)]).agg(F.max(tcol).alias("__wm"))
    return (src.join(wm, on=series, how="left")
            .filter(F.col("__wm").isNull() | (F.col(column) > F.col("__wm"))).drop("__wm"))
