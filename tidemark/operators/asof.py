"""As-of left join.

For every left row, attach the payload of the latest right row whose time is ``<=`` the
left time (and whose ``by`` keys are equal); unmatched rows keep nulls. This is the
reference's ``LEFT JOIN LATERAL (... WHERE u.t <= b.t ORDER BY u.t DESC LIMIT 1)``,
which Spark would plan as a nested-loop join.

Plan (all DataFrame operators, no Python in the data path):

1. Tag probes (left) and right rows, put the right payload into one struct column.
2. Window over ``(by, bucket)`` ordered by ``(time, side)`` and take
   ``last(payload, ignorenulls)``: right rows sort before probes at equal time, which
   gives the ``<=`` semantics.
3. A probe whose bucket holds no earlier right row needs the last right row of an
   earlier bucket: a per-``(by, bucket)`` summary (``max_by``, partially aggregated
   before the shuffle) is as-of'ed at bucket level and injected as one synthetic
   "carry" row at the head of each probe bucket.

So a hot key is split across its buckets and never lands whole in one task. Buckets by row count
(``"auto"``, ``Rows(n)``) cut both sides at the same points of (time, side, order): bursts are cut up, right rows of one
instant by their first order column if it is a whole number, probes of one instant by a hash of the
row; if no key has more rows than a bucket holds, steps 2 and 3 need no carry rows. With
``distinct_probes`` the as-of is resolved on the *distinct* left times and joined back by
equality (AQE turns that join into a broadcast only when the runtime size is under the
threshold); that pays off when many left rows share a time (dates), not for ticks.

Calendar path: for a global series on a DATE column, the distinct left dates and the
last right row per date are both bounded by the calendar (at most 366 rows a year,
whatever the data volume), so one ordered window over their union is safe and needs
three stages instead of six.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._time import RowCuts, bucket_of, dtype_of, resolve_width, row_target

_T, _S, _B, _P, _LAST, _CARRY, _M, _X = "__t", "__s", "__b", "__p", "__last", "__carry", "__m", "__x"
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
_CARRY_SIDE, _RIGHT_SIDE, _PROBE_SIDE = 0, 1, 2


def asof_left(left: DataFrame, right: DataFrame, on: str, *, right_on: str | None = None,
              by: Sequence[str] = (), right_by: Sequence[str] | None = None,
              payload: Sequence[str] | None = None, right_order: Sequence[str] = (),
              bucket_width=None, distinct_probes: bool | None = None) -> DataFrame:
    """Left rows plus the payload columns of their as-of right row.

    ``right_order`` breaks ties among right rows with equal time (larger wins; the
    payload itself breaks any tie left, so the match is always deterministic).
    ``distinct_probes`` (default: a global series on a DATE column) resolves on the
    distinct left ``(by, on)`` values and joins back by equality. ``bucket_width``:
    native units, a text interval (``"1 hour"``), ``Rows(n)`` or ``"auto"`` (see ``_time``).
    """
    by = list(by)
    right_by = list(right_by) if right_by is not None else list(by)
    right_on = right_on or on
    if len(by) != len(right_by):
        raise ValueError("by and right_by must have the same length")
    if payload is None:
        payload = [c for c in right.columns if c not in set(right_by) | {right_on} | set(right_order)]
    payload = list(payload)
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"payload columns {sorted(clash)} already exist on the left; rename them")
    t_type = dtype_of(left, on)
    if distinct_probes is None:
        # dates repeat across many rows (one per ticker per day): resolve once per date;
        # tick timestamps are nearly unique, so resolving on the rows saves a shuffle
        distinct_probes = not by and isinstance(t_type, T.DateType)
    keys = [f"__k{i}" for i in range(len(by))]
    orders = [f"__o{j}" for j in range(len(right_order))]

    r = right.select(*[F.col(c).alias(k) for c, k in zip(right_by, keys)],
                     F.col(right_on).cast(t_type).alias(_T),
                     *[F.col(c).alias(o) for c, o in zip(right_order, orders)],
                     F.struct(*payload).alias(_P))
    r = r.filter(F.col(_T).isNotNull())
    for k in keys:
        r = r.filter(F.col(k).isNotNull())
    if distinct_probes and not by and isinstance(t_type, T.DateType):
        return _calendar_asof(left, r, on, payload, orders)
    p_type = r.schema[_P].dataType
    if distinct_probes:
        probes = left.select(*[F.col(c).alias(k) for c, k in zip(by, keys)],
                             F.col(on).alias(_T)).distinct()
    else:
        probes = left.select("*", *[F.col(c).alias(k) for c, k in zip(by, keys)],
                             F.col(on).alias(_T))
    target, carried = row_target(bucket_width), True
    if target is not None:
        def position(side, salt):
            return F.struct(F.col(_T).alias("t"), F.lit(side).alias("s"), salt.cast("bigint").alias("o"))

        first = F.col(orders[0]) if orders and isinstance(r.schema[orders[0]].dataType, T.IntegralType) else F.lit(0)
        r = r.withColumn(_X, position(_RIGHT_SIDE, first))
        probes = probes.withColumn(_X, position(_PROBE_SIDE, F.lit(0) if distinct_probes else F.xxhash64(*left.columns)))
        cuts = RowCuts(r.select(*keys, _X).unionByName(probes.select(*keys, _X)), keys, _X, target)
        carried = cuts.cuts is not None
        r, probes = cuts.assign(r, _B).drop(_X), cuts.assign(probes, _B).drop(_X)
    else:
        width = resolve_width(bucket_width, left, by, on, t_type)
        r = r.withColumn(_B, bucket_of(F.col(_T), t_type, width))
        probes = probes.withColumn(_B, bucket_of(F.col(_T), t_type, width))

    # Bucket level: last right row per (by, bucket), carried to later probe buckets.
    summary = (r.groupBy(*keys, _B)
                .agg(F.max_by(_P, F.struct(_T, *orders, _P)).alias(_LAST))
                .withColumn(_S, F.lit(_RIGHT_SIDE)))
    probe_buckets = (probes.select(*keys, _B).filter(F.col(_B).isNotNull()).distinct()
                     .withColumn(_LAST, F.lit(None).cast(p_type))
                     .withColumn(_S, F.lit(_PROBE_SIDE)))
    wb = Window.partitionBy(*keys).orderBy(_B).rangeBetween(Window.unboundedPreceding, -1)
    carry = (summary.unionByName(probe_buckets)
             .withColumn(_CARRY, F.last(_LAST, ignorenulls=True).over(wb))
             .filter((F.col(_S) == _PROBE_SIDE) & F.col(_CARRY).isNotNull())
             .select(*keys, _B, F.lit(None).cast(t_type).alias(_T),
                     F.col(_CARRY).alias(_P), F.lit(_CARRY_SIDE).alias(_S)))

    rows = r.select(*keys, _B, _T, *orders, _P, F.lit(_RIGHT_SIDE).alias(_S))
    u = (probes.withColumn(_S, F.lit(_PROBE_SIDE))
         .unionByName(rows, allowMissingColumns=True))
    if carried:
        u = u.unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, _B)
         .orderBy(F.col(_T).asc_nulls_first(), F.col(_S), *[F.col(o) for o in orders], F.col(_P))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matched = (u.withColumn(_M, F.last(_P, ignorenulls=True).over(w))
               .filter(F.col(_S) == _PROBE_SIDE))

    if distinct_probes:
        resolved = matched.select(*keys, _T, *[F.col(f"{_M}.{c}").alias(c) for c in payload])
        cond = [left[c] == resolved[k] for c, k in zip(by, keys)] + [left[on] == resolved[_T]]
        return (left.join(resolved, on=cond, how="left")
                .select(*[left[c] for c in left.columns], *[resolved[c] for c in payload]))
    return matched.select(*left.columns, *[F.col(f"{_M}.{c}").alias(c) for c in payload])


def _calendar_asof(left: DataFrame, r: DataFrame, on: str, payload, orders) -> DataFrame:
    """Global as-of on a date column: both sides reduced to one row per date first."""
    per_day = r.groupBy(_T).agg(F.max_by(_P, F.struct(*orders, _P)).alias(_P))
    probes = left.select(F.col(on).alias(_T)).distinct()
    u = (probes.withColumn(_S, F.lit(_PROBE_SIDE))
         .unionByName(per_day.withColumn(_S, F.lit(_RIGHT_SIDE)), allowMissingColumns=True))
    w = (Window.orderBy(F.col(_T).asc_nulls_first(), F.col(_S))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    resolved = (u.withColumn(_M, F.last(_P, ignorenulls=True).over(w))
                .filter((F.col(_S) == _PROBE_SIDE) & F.col(_T).isNotNull())
                .select(_T, *[F.col(f"{_M}.{c}").alias(c) for c in payload]))
    # at most one row per calendar day (3.7 million from year 1 to 9999): a bounded table while its columns are
    if all(isinstance(resolved.schema[c].dataType, _FIXED_WIDTH) for c in payload):
        resolved = F.broadcast(resolved)
    return (left.join(resolved, on=left[on] == resolved[_T], how="left")
            .select(*[left[c] for c in left.columns], *[resolved[c] for c in payload]))
