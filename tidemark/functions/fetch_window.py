"""Plan what to fetch next.

``fetch_window`` is plain date arithmetic on one watermark, for one extract; ``fetch_plan`` plans
every series at once from the stored dates, holes included, as one DataFrame.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour: default look-back of
# 364*10 days for the macro/FX/index extracts and 10*365 days for the equities job;
# custom start without end extends 364*10 days for macro series and 5 days for
# FX bulletins and index quotes.
DEFAULT_LOOKBACK_DAYS = {"macro": 364 * 10, "fx": 364 * 10, "index": 364 * 10, "equities": 10 * 365}
CUSTOM_SPAN_DAYS = {"macro": 364 * 10, "fx": 5, "index": 5, "equities": 10 * 365}


def _as_date(x) -> date | None:
    if x is None:
        return None
    if isinstance(x, datetime):
        return x.date()
    if isinstance(x, date):
        return x
    return datetime.strptime(str(x)[:10], "%Y-%m-%d").date()


def fetch_window(kind: str, last_ref=None, today=None, start=None, end=None):
    """Return ``(start, end)`` dates for the next extract of ``kind``.

    * no custom start: start = stored max (``last_ref``) or today minus the default
      look-back; end = yesterday; for ``fx`` a weekend end moves back to Friday.
    * custom start: end = given end, else start + the kind's custom span.

    The start day itself is later excluded by the strict ``>`` filter
    (``operators.clean.after``), as in the reference; pass ``inclusive=True`` there to
    keep it.
    """
    if kind not in DEFAULT_LOOKBACK_DAYS:
        raise ValueError(f"unknown extract kind {kind!r}")
    today = _as_date(today) or date.today()
    if start is None:
        last = _as_date(last_ref)
        s = last if last is not None else today - timedelta(days=DEFAULT_LOOKBACK_DAYS[kind])
        e = today - timedelta(days=1)
        if kind == "fx":
            if e.weekday() == 5:
                e -= timedelta(days=1)
            elif e.weekday() == 6:
                e -= timedelta(days=2)
        return s, e
    s = _as_date(start)
    e = _as_date(end) if end is not None else s + timedelta(days=CUSTOM_SPAN_DAYS[kind])
    return s, e


# Kinds that are published on weekdays only: a weekend without a row is no hole.
WEEKDAY_KINDS = ("fx", "index", "equities")
_MONDAY = date(1970, 1, 5)


def _weekdays_before(day: Column) -> Column:
    """Weekdays from 1970-01-05 (a Monday) up to, not including, ``day``; negative before."""
    n = F.date_diff(day, F.lit(_MONDAY))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def expected_days(kind: Column, after: Column, until: Column, weekday_kinds: Collection[str] = WEEKDAY_KINDS) -> Column:
    """Days on which a series of ``kind`` is published, after one day up to and with another."""
    every = F.date_diff(until, after)
    weekdays = _weekdays_before(F.date_add(until, 1)) - _weekdays_before(F.date_add(after, 1))
    return F.when(kind.isin(*weekday_kinds), weekdays).otherwise(every).cast("long")


def fetch_plan(wanted: DataFrame, stored: DataFrame, today=None, weekday_kinds: Collection[str] = WEEKDAY_KINDS) -> DataFrame:
    """I1 per series: every window that still has to be fetched.

    ``wanted`` (kind, series) and ``stored`` (kind, series, day) -> (kind, series, reason, start, end, days). The start day is
    stored already (strict, as in ``fetch_window``), ``days`` counts the published days of the window.

    * ``first``: a wanted series without a stored day: the kind's default look-back;
    * ``gap``: between two stored days with at least one published day missing between them;
    * ``next``: from the last stored day to the kind's usual end, when a day lies between.

    Distinct days are combined map-side, so a series has at most one row a calendar day in the window; wanted series
    ride along as rows without a day, so there is no join. Stored series that are not wanted are planned as well. Rows
    without a kind, a series or a stored day count for nothing; a kind that has no rule is an error."""
    today = _as_date(today) or date.today()
    rules = {k: fetch_window(k, today=today) for k in DEFAULT_LOOKBACK_DAYS}

    def by_kind(at):
        out = F.when(F.lit(False), F.lit(today))
        for k, rule in rules.items():
            out = out.when(F.col("kind") == k, F.lit(rule[at]))
        return out.otherwise(F.raise_error(F.concat(F.lit("unknown extract kind "), F.col("kind"))).cast("date"))

    known = F.col("kind").isNotNull() & F.col("series").isNotNull()
    days = stored.filter(known & F.col("day").isNotNull()).select("kind", "series", F.col("day").cast("date").alias("day"))
    asked = wanted.filter(known).select("kind", "series", F.lit(None).cast("date").alias("day"))
    rows = days.unionByName(asked).distinct()
    rows = rows.withColumn("nxt", F.lead("day").over(Window.partitionBy("kind", "series").orderBy("day")))  # no day: first
    reason = (F.when(F.col("day").isNull() & F.col("nxt").isNull(), F.lit("first"))
              .when(F.col("day").isNotNull(), F.when(F.col("nxt").isNull(), F.lit("next")).otherwise(F.lit("gap"))))
    plan = rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "kind", "series", "reason", F.coalesce("day", by_kind(0)).alias("start"),
        F.coalesce(F.date_sub("nxt", 1), by_kind(1)).alias("end"))
    plan = plan.withColumn("days", expected_days(F.col("kind"), F.col("start"), F.col("end"), weekday_kinds))
    return plan.filter((F.col("days") > 0) | (F.col("reason") == "first"))
