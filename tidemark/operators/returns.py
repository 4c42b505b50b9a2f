"""Previous value, absolute/percent returns and null-safe variation per series.

Without ``bucketed``/``bucket_width`` there is one window per series key: right for
calendar-bounded series (one row per ticker per day or month). For tick-level input use
``bucketed=True`` (1-day buckets), a width (``"1 hour"``), ``Rows(n)`` or ``"auto"`` (buckets by
row count, see ``_time``): the lag then runs per ``(key, bucket)`` and the first row of each
bucket takes the last value of the previous non-empty bucket from a partially aggregated
per-bucket summary, so a hot ticker, or a burst of it, is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import pct_return, price_diff, variation
from ._time import RowCuts, bucket_of, dtype_of, resolve_width, row_target

_B, _S, _LAST, _X = "__b", "__s", "__last", "__x"
_FIRST = -2**63   # bucket of the rows without a time


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def with_previous(df: DataFrame, key, time: str, value: str, out: str = "previous_close",
                  order: Sequence[str] = (), bucket_width=None, bucketed: bool = False) -> DataFrame:
    """``lag(value)`` per series ordered by ``(time, *order)``.

    Rows with a null ``time`` sort first. In the bucketed form they are the first bucket, so both
    forms give the same answer."""
    keys = _keys(key)
    order_cols = [F.col(time)] + [F.col(o) for o in order]
    if not bucketed and bucket_width is None:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(out, F.lag(value).over(w))

    cols, target = df.columns, row_target(bucket_width)
    if target is not None:
        d = df.withColumn(_X, F.struct(time, *order))
        cuts = RowCuts(d, keys, _X, target)
        d = cuts.assign(d, _B).drop(_X)
        if cuts.cuts is None:      # no key has more rows than a bucket holds: nothing to carry
            w = Window.partitionBy(*keys, _B).orderBy(*order_cols)
            return d.withColumn(out, F.lag(value).over(w)).drop(_B)
    else:
        t_type = dtype_of(df, time)
        width = resolve_width(bucket_width, df, keys, time, t_type)
        d = df.withColumn(_B, F.coalesce(bucket_of(F.col(time), t_type, width), F.lit(_FIRST)))
    summary = (d.groupBy(*keys, _B)
               .agg(F.max_by(F.col(value), F.struct(time, *order)).alias(_LAST)))
    wb = Window.partitionBy(*keys).orderBy(_B)
    carry = (summary.withColumn(value, F.lag(_LAST).over(wb))
             .select(*keys, _B, value, F.lit(0).alias(_S)))
    u = d.withColumn(_S, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, _B)
         .orderBy(F.col(_S), F.col(time).asc_nulls_first(), *[F.col(o) for o in order]))
    return (u.withColumn(out, F.lag(value).over(w))
            .filter(F.col(_S) == 1)
            .select(*cols, out))


def with_returns(df: DataFrame, key, time: str, value: str = "fechamento",
                 previous: str = "fechamento_mes_anterior", diff: str = "valor_retorno",
                 pct: str = "porcentagem_retorno", order: Sequence[str] = (),
                 bucket_width=None, bucketed: bool = False) -> DataFrame:
    """Previous close, ``close - previous`` and ``diff / previous * 100``
    (null on the first row of a series and when the previous close is 0)."""
    d = with_previous(df, key, time, value, previous, order, bucket_width, bucketed)
    return d.withColumns({diff: price_diff(value, previous), pct: pct_return(value, previous)})


def with_variation(df: DataFrame, key, time: str, value: str, out: str = "variacao_diaria",
                   order: Sequence[str] = (), bucket_width=None, bucketed: bool = False) -> DataFrame:
    """``COALESCE(value / NULLIF(LAG(value), 0) - 1, 0)`` per series."""
    tmp = "__prev"
    d = with_previous(df, key, time, value, tmp, order, bucket_width, bucketed)
    return d.withColumn(out, variation(value, tmp)).drop(tmp)
