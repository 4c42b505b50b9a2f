"""Fetch windows of every series against the driver's date arithmetic, day by day."""

import random
from datetime import date, timedelta

import pytest

from tidemark.functions.fetch_window import WEEKDAY_KINDS, expected_days, fetch_plan, fetch_window

DAY = timedelta(days=1)


def _days(kind, start, end):
    return sum(1 for i in range((end - start).days) if kind not in WEEKDAY_KINDS or (start + (i + 1) * DAY).weekday() < 5)


def _plan(wanted, stored, today):
    out = set()
    for kind, series in wanted | {(k, s) for k, s, _ in stored}:
        days = sorted({d for k, s, d in stored if (k, s) == (kind, series)})
        if not days:
            start, end = fetch_window(kind, today=today)
            out.add((kind, series, "first", start, end, _days(kind, start, end)))
            continue
        for a, b in zip(days, days[1:]):
            if (n := _days(kind, a, b - DAY)):
                out.add((kind, series, "gap", a, b - DAY, n))
        start, end = fetch_window(kind, days[-1], today)
        if start < end and (n := _days(kind, start, end)):
            out.add((kind, series, "next", start, end, n))
    return out


@pytest.mark.parametrize("today", [date(2025, 9, d) for d in range(5, 10)])        # Friday to Tuesday
def test_every_series_against_day_by_day(spark, today):
    rng = random.Random(today.toordinal())
    kinds = ["macro", "fx", "index", "equities"]
    stored = [(k, f"{k}{i}", today - rng.randrange(-2, 40) * DAY) for k in kinds for i in range(4) for _ in range(rng.randrange(1, 25))]
    wanted = {(k, f"{k}{i}") for k in kinds for i in range(6)}
    got = fetch_plan(spark.createDataFrame(sorted(wanted) * 2 + [(None, "x"), ("fx", None)], "kind string, series string"),
                     spark.createDataFrame(stored * 2 + [("fx", "fx0", None), (None, "x", today)], "kind string, series string, day date"), today)
    assert got.columns == ["kind", "series", "reason", "start", "end", "days"]
    assert sorted(map(tuple, got.collect())) == sorted(_plan(wanted, set(stored), today))


def test_empty_tables_and_unknown_kinds(spark):
    w, s = "kind string, series string", "kind string, series string, day date"
    assert fetch_plan(spark.createDataFrame([], w), spark.createDataFrame([], s), "2025-09-08").isEmpty()
    with pytest.raises(Exception, match="unknown extract kind"):
        fetch_plan(spark.createDataFrame([("bonds", "a")], w), spark.createDataFrame([], s), "2025-09-08").collect()


def test_one_shuffle_by_series(spark):
    s = spark.createDataFrame([("fx", "USD", date(2025, 1, 1))], "kind string, series string, day date")
    p = fetch_plan(s.select("kind", "series"), s, "2025-09-08")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and p.count("Exchange hashpartitioning(kind") == 2 and "Window" in p   # distinct, then the window


def test_expected_days_before_the_epoch(spark):
    from pyspark.sql import functions as F
    rows = [(date(1969, 12, 1) + i * DAY, date(1969, 12, 1) + (i + j) * DAY) for i in range(0, 60, 3) for j in range(0, 20, 2)]
    df = spark.createDataFrame(rows, "a date, b date").select("a", "b", expected_days(F.lit("fx"), F.col("a"), F.col("b")).alias("n"))
    assert all(r.n == _days("fx", r.a, r.b) for r in df.collect())
