"""Buckets by row count: sizes on bursts and hot keys, and the same results as brute force for any row target."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_asof_and_windows import brute_asof

from tidemark.operators._time import RowCuts, Rows, row_target
from tidemark.operators.asof import asof_left
from tidemark.operators.returns import with_previous

BASE = datetime(2024, 1, 1)


def burst(n, seed=5, keys=(0, 1, None), seconds=1000, apart=200):
    """99.5% of the rows within ``seconds``, the others over a year; three in four rows have the first key."""
    rng = random.Random(seed)
    return [(rng.choice(keys) if rng.random() < .25 else keys[0],
             BASE + (timedelta(days=100, seconds=rng.randrange(seconds)) if i % apart else timedelta(seconds=rng.randrange(86400 * 365))), i)
            for i in range(n)]


def _sizes(df, target):
    d = df.withColumn("x", F.struct("t", "id"))
    return {(r.k, r.b): r["count"] for r in RowCuts(d, ["k"], "x", target).assign(d, "b").groupBy("k", "b").count().collect()}


@pytest.mark.parametrize("seconds", [1000, 1])      # 1: nearly all rows at one instant
def test_burst_is_cut_by_row_count(spark, seconds):
    df = spark.createDataFrame(burst(6000, seconds=seconds), "k long, t timestamp_ntz, id long")
    sizes = _sizes(df, 100)
    assert max(sizes.values()) <= 200 and sum(sizes.values()) == 6000
    assert sum(k == 0 for k, _ in sizes) >= 20 and sum(k is None for k, _ in sizes) >= 4


def test_sampled_cuts_hold_the_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 10).alias("k"), F.col("id"), F.timestamp_seconds(
        F.when(F.col("id") % 200 == 0, F.col("id") * 300).otherwise(F.col("id") * 7919 % 1000)).cast("timestamp_ntz").alias("t"))
    df = df.withColumn("k", F.when(F.col("k") < 8, F.lit(0)).otherwise(F.col("k")))
    sizes = _sizes(df, 1500)
    assert max(sizes.values()) <= 3000 and sum(sizes.values()) == 200_000 and sum(k == 0 for k, _ in sizes) > 60


def test_tree_of_cuts(spark, monkeypatch):
    """More cuts than a group holds: every row finds the number of cuts at or before it, over several levels."""
    from tidemark.operators import _time
    monkeypatch.setattr(_time, "FAN", 5)
    df = spark.createDataFrame(burst(900, seconds=50), "k long, t timestamp_ntz, id long").withColumn("x", F.struct("t", "id"))
    cuts = RowCuts(df, ["k"], "x", 7)
    assert cuts.levels >= 3
    of = {}
    for r in cuts.cuts.filter("__level = 0").collect():
        of.setdefault(r["__h_k"], []).extend(map(tuple, r["__cuts"]))
    for r in cuts.assign(df, "b").collect():
        assert r.b == sum(c <= (r.t, r.id) for c in of[r.k])
    monkeypatch.setattr(_time, "BROADCAST_CUTS", 0)
    sizes = [r["count"] for r in cuts.assign(df, "b").groupBy("k", "b").count().collect()]
    assert max(sizes) <= 14 and sum(sizes) == 900


def test_small_tables_have_no_cuts(spark):
    df = spark.createDataFrame(burst(50), "k long, t timestamp_ntz, id long")
    d = df.withColumn("x", F.struct("t", "id"))
    cuts = RowCuts(d, ["k"], "x", 50)
    assert cuts.cuts is None and cuts.assign(d, "b").where("b <> 0").isEmpty()
    assert (row_target("auto"), row_target(Rows(7)), row_target("1 day"), row_target(None), row_target(7)) == (2_000_000, 7, None, None, None)


@pytest.mark.parametrize("target", [1, 3, 40, 10_000])
@pytest.mark.parametrize("seconds", [1, 20, 1000])
def test_keyed_asof_on_bursts(spark, target, seconds):
    rng = random.Random(target + seconds)
    rows = burst(400, seed=seconds, seconds=seconds, apart=20)
    left = [(i, k, t) for k, t, i in rows[:280]] + [(1000, 0, None), (1001, None, BASE)]
    right = [(k, t, j, float(j)) for j, (k, t, _) in enumerate(rows[280:] + rng.sample(rows[:280], 40))] + [(0, None, 999, 9.0)]
    ldf = spark.createDataFrame(left, "id long, k long, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "rk long, rt timestamp_ntz, seq long, val double")
    got = asof_left(ldf, rdf, on="t", right_on="rt", by=["k"], right_by=["rk"], payload=["val"], right_order=["seq"],
                    bucket_width=Rows(target)).collect()
    assert len(got) == len(left) and {r.id: r.val for r in got} == brute_asof(left, right)
    got = asof_left(ldf.drop("k"), rdf.drop("rk"), on="t", right_on="rt", payload=["val"], right_order=["seq"], bucket_width=Rows(target))
    assert {r.id: r.val for r in got.collect()} == brute_asof([(i, 0, t) for i, _, t in left], [(0, *r[1:]) for r in right])


@pytest.mark.parametrize("target", [1, 2, 9, 50])
def test_lag_on_bursts_equals_plain_lag(spark, target):
    rows = [(k, t, i, None if i % 7 == 0 else float(i)) for k, t, i in burst(500, seconds=5, apart=25)] + [(0, None, 9000 + i, 1.0 * i) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, id long, v double")
    plain = {r.id: r.p for r in with_previous(df, "k", "t", "v", "p", order=["id"]).collect()}
    got = with_previous(df, "k", "t", "v", "p", order=["id"], bucket_width=Rows(target))
    assert got.columns == [*df.columns, "p"] and {r.id: r.p for r in got.collect()} == plain


def test_date_asof_moves_only_the_calendar(spark):
    """The big side of the date form is not exchanged: the per-day table is broadcast."""
    left = spark.range(2000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"))
    right = spark.range(30).select(F.date_add(F.lit("2024-01-03").cast("date"), (F.col("id") * 2).cast("int")).alias("rd"), F.col("id").cast("double").alias("v"))
    got = asof_left(left, right, on="d", right_on="rd", payload=["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.id: r.v for r in got.collect()} == {i: (min((i % 90 - 2) // 2, 29) if i % 90 >= 2 else None) for i in range(2000)}


def test_registered_bursts_have_many_buckets(spark):
    """The registered rows on crowded ticks cut every key at least 20 times, none above twice its share."""
    from conftest import SF_MID
    from tidemark.plans import registry as R
    ev = R._burst(spark, SF_MID)
    d = ev.withColumn("x", F.struct("ts", "event_id"))
    for key in ("event_type", "desk"):
        share = R._share(ev, 5)
        sizes = RowCuts(d, [key], "x", share).assign(d, "b").groupBy(key, "b").count().collect()
        held = {}
        for r in sizes:
            held[r[key]] = held.get(r[key], 0) + 1
        big = {r[key] for r in d.groupBy(key).count().collect() if r["count"] >= 0.9 * ev.count() / 5}
        assert max(r["count"] for r in sizes) <= 2 * share and big and all(held[k] >= 20 for k in big)
