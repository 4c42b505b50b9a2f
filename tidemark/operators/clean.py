"""Projection, filters and cleansing of landed extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import audit_date

# Fixed sentinel strings that the equities extract uses for "no value".
INFINITY_SENTINELS = ("Infinity", "-Infinity")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename; names absent from ``df`` are ignored (as ``withColumnRenamed``)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column whitelist in the given order (missing columns are skipped)."""
    return df.select(*[c for c in columns if c in df.columns])


def with_audit(df: DataFrame, run_ts=None, date_col: str | None = "dt_ptcao",
               ts_col: str | None = "dthr_igtao") -> DataFrame:
    """Audit columns: ``dt_ptcao`` (run date text) and ``dthr_igtao`` (run time).

    ``run_ts`` may be a Column, a ``datetime`` or ``'yyyy-MM-dd HH:mm:ss'`` text (taken as
    a local timestamp without zone); default ``current_timestamp()``."""
    if run_ts is None:
        ts = F.current_timestamp()
    elif isinstance(run_ts, Column):
        ts = run_ts
    else:
        text = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(run_ts, datetime) else str(run_ts)
        ts = F.lit(text).cast("timestamp_ntz")
    cols = {}
    if date_col:
        cols[date_col] = audit_date(ts)
    if ts_col:
        cols[ts_col] = ts
    return df.withColumns(cols)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Casts; ``safe=True`` uses ``try_cast`` so dirty text becomes null under ANSI."""
    def cv(c, t):
        return F.col(c).try_cast(t) if safe else F.col(c).cast(t)
    return df.withColumns({c: cv(c, t) for c, t in types.items()})


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P5: drop rows with a null in any key column."""
    return df.dropna(how="any", subset=list(keys))


def after(df: DataFrame, column: str, start, inclusive: bool = False) -> DataFrame:
    """Rows strictly after the ``start`` day (the start day excluded, Q5);
    ``inclusive=True`` keeps it.

    The bound is always a literal on the bare column, so Catalyst pushes it into the
    parquet scan. On a timestamp column "after day d" means ``>= d + 1 day 00:00``."""
    if isinstance(start, str):
        start = datetime.strptime(start[:10], "%Y-%m-%d").date()
    if isinstance(start, datetime):
        start = start.date()
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        first = start if inclusive else start + timedelta(days=1)
        bound = F.lit(first.isoformat() + " 00:00:00").cast(dtype.simpleString())
        return df.filter(c >= bound)
    return df.filter(c >= F.lit(start) if inclusive else c > F.lit(start))


def map_values(column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Small lookup as a CASE expression; values not in the map pass through (or
    take ``default``). Large maps belong in a join, not in a CASE."""
    c = F.col(column) if isinstance(column, str) else column
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    fallback = c if default is None else default
    return fallback if expr is None else expr.otherwise(fallback)


def cleanse_sentinel(df: DataFrame, defaults: Mapping[str, object],
                     types: Mapping[str, str] | None = None) -> DataFrame:
    """The text sentinels ``Infinity``/``-Infinity`` become the column default;
    null stays null (Q9). With ``types`` the text is ``try_cast`` before the default joins it, so
    one bad cell becomes null and never fails the job; whole numbers written with a point
    (``3000000000000.0``) reach integer types."""
    out = {}
    for c, d in defaults.items():
        text = F.col(c).cast("string")
        if types and c in types:
            value = text.try_cast(types[c])
            if types[c].lower() in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
                whole = text.try_cast("decimal(38,6)")
                value = F.coalesce(value, F.when(whole == F.floor(whole), whole.cast("string")
                                                 .substr(F.lit(1), F.length(whole.cast("string")) - 7).try_cast(types[c])))
            v = F.when(text.isin(*INFINITY_SENTINELS), F.lit(d).cast(types[c])).otherwise(value)
        else:
            v = F.when(text.isin(*INFINITY_SENTINELS), F.lit(d)).otherwise(F.col(c))
        out[c] = v
    return df.withColumns(out)


def first_present(df: DataFrame, candidates: Sequence[str], out: str) -> DataFrame:
    """``out`` = the first candidate column that exists (e.g. adjusted close,
    else close)."""
    for c in candidates:
        if c in df.columns:
            return df.withColumn(out, F.col(c))
    raise ValueError(f"none of {list(candidates)} present")


def convert_or_quarantine(df: DataFrame, casts: Mapping[str, str]):
    """Convert columns with ``try_cast``; a row whose non-null input fails to
    convert goes to the quarantine frame instead of failing the job.

    Returns ``(good, bad)``; ``bad`` keeps the original text plus ``bad_columns``
    (comma-separated names of the columns that failed)."""
    converted = {c: F.col(c).try_cast(t) for c, t in casts.items()}
    failed = [F.when(F.col(c).isNotNull() & converted[c].isNull(), F.lit(c)) for c in casts]
    flagged = df.withColumn("__bad", F.array_compact(F.array(*failed)))
    good = (flagged.filter(F.size("__bad") == 0).drop("__bad").withColumns(converted))
    bad = (flagged.filter(F.size("__bad") > 0)
           .withColumn("bad_columns", F.array_join("__bad", ",")).drop("__bad"))
    return good, bad


def rejected(bad: DataFrame, kind: str, reason: Column, source: Column | None = None,
             record: Sequence[str] | None = None) -> DataFrame:
    """Rows as the quarantine keeps them: (kind, source_file, reason, record: the ``record`` columns, by default all, as JSON)."""
    return bad.select(F.lit(kind).alias("kind"), (F.lit(None) if source is None else source).cast("string").alias("source_file"),
                      reason.alias("reason"), F.to_json(F.struct(*(record or bad.columns))).alias("record"))


def stringify_time(df, type_names: Sequence[str] = ("time",)):
    """Time-of-day columns to text.

    A Spark frame: columns found by walking the schema (the TIME type needs
    ``spark.sql.timeType.enabled``). A pandas frame (a small decoded extract, before
    ``createDataFrame``): object columns holding ``datetime.time`` values."""
    if isinstance(df, DataFrame):
        targets = [f.name for f in df.schema.fields if f.dataType.typeName() in type_names]
        return df.withColumns({c: F.col(c).cast("string") for c in targets}) if targets else df
    import datetime as _dt
    out = df.copy()
    for c in out.columns:
        if out[c].dtype == object and out[c].map(lambda v: isinstance(v, _dt.time)).any():
            out[c] = out[c].map(lambda v: v.isoformat() if isinstance(v, _dt.time) else v)
    return out
