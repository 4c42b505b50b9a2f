"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, computed from its wall-clock
    fields only. (``timestamp_diff``/``unix_micros`` would cast it to a session-zone
    instant first, which shifts DST-period values and is not monotone in a DST gap.)"""
    c = _c(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = days * F.lit(86400) + F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60)
    frac = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint")
    return secs * F.lit(1_000_000) + frac


def to_day(ts) -> Column:
    """calendar day of a timestamp (``to_date``)."""
    return F.to_date(_c(ts))


def audit_date(ts) -> Column:
    """``yyyy-MM-dd`` text of a timestamp (the ``dt_ptcao`` audit column)."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def epoch_to_text(seconds, zone: str | None = None) -> Column:
    """Unix seconds -> ``yyyy-MM-dd HH:mm:ss`` text.

    ``zone=None`` keeps ``from_unixtime`` semantics (session time zone). With a zone the
    text is rendered in that zone whatever the session zone is.
    """
    s = _c(seconds).cast("bigint")
    if zone is None:
        return F.from_unixtime(s)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc_wall = F.timestamp_add("SECOND", s, epoch)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)
    return F.date_format(local, "yyyy-MM-dd HH:mm:ss")


def round_price(x, scale: int = 2) -> Column:
    """``round(x, scale)`` (HALF_UP, as Spark's ``round``)."""
    return F.round(_c(x), scale)


def distinct_from(a, b) -> Column:
    """null-safe inequality, SQL ``a IS DISTINCT FROM b``."""
    return ~_c(a).eqNullSafe(_c(b))


def variation(x, prev) -> Column:
    """``COALESCE(x / NULLIF(prev, 0) - 1, 0)`` - fractional change, 0 when undefined."""
    return F.coalesce(_c(x) / F.nullif(_c(prev), F.lit(0)) - F.lit(1), F.lit(0.0))


def price_diff(x, prev) -> Column:
    """Absolute return ``x - prev``."""
    return _c(x) - _c(prev)


def pct_return(x, prev) -> Column:
    """``((x - prev) / prev) * 100``; a zero previous value gives null instead of a
    division error (Q10)."""
    return ((_c(x) - _c(prev)) / F.nullif(_c(prev), F.lit(0))) * F.lit(100)


def brl_compound(r, d) -> Column:
    """compound a foreign return with the currency variation, ``r + d + r*d``
    (operand order kept so doubles are bit-identical to the SQL form)."""
    return _c(r) + _c(d) + (_c(r) * _c(d))
