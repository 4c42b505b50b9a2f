"""Plan properties that matter at scale, checked on the physical plans."""

import re

import pytest

from conftest import SF_SMALL
from tidemark.plans.registry import QUERIES

IO = {"roundtrip_parquet", "roundtrip_csv_typed", "stream_table_copy", "stream_restart_no_dup"}


def _plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - IO))
def test_no_nested_loop_cartesian_or_python(spark, name):
    p = _plan(spark, name)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_date_filter_pushed_into_scan(spark):
    p = _plan(spark, "after_date")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-08-03T00:00)]" in p


def test_numeric_filter_pushed_into_scan(spark):
    assert "GreaterThanOrEqual(o_totalprice,150000.0)" in _plan(spark, "filter_ge")


def test_projection_pruned(spark):
    p = _plan(spark, "cast_keys")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p \
        or "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz,o_totalprice:double>" in p


def test_watermark_is_a_scalar_subquery_in_the_scan(spark):
    p = _plan(spark, "incremental_filter")
    assert "Subquery" in p and "BroadcastNestedLoopJoin" not in p


def test_keyed_asof_windows_are_bucketed(spark):
    p = _plan(spark, "asof_by_user")
    assert re.search(r"hashpartitioning\(__k0#\d+L, __b#\d+L", p)


def test_merge_check_reuses_join_shuffle(spark):
    p = _plan(spark, "upsert_changed")
    # one exchange per side: the duplicate-key window feeds the sort-merge join directly
    assert p.count("Exchange hashpartitioning(o_orderkey") == 2


def test_bucketed_tables_upsert_without_shuffle(spark):
    """Both sides stored bucketed on the key: the upsert (with its duplicate-key check)
    plans no exchange at all."""
    from pyspark.sql import functions as F

    from tidemark.operators.mutate import upsert_changed
    from tidemark.sinks.files import save_table
    base = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"),
                                       F.lit("d0").alias("dt_ptcao"),
                                       F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("dthr_igtao"))
    save_table(base, "fact_b", bucket_by=(8, ["k"]))
    save_table(base.withColumn("v", F.col("v") + 1), "stage_b", bucket_by=(8, ["k"]))
    out = upsert_changed(spark.table("fact_b"), spark.table("stage_b"), ["k"])
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p
    assert out.count() == 2000


def test_auto_width_splits_a_hot_key(spark):
    import random
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from tidemark.operators._time import auto_width, bucket_of
    rng = random.Random(5)
    base = datetime(2024, 1, 1)
    rows = [(0 if rng.random() < 0.8 else rng.randrange(1, 20), base + timedelta(seconds=rng.randrange(86400 * 30)))
            for _ in range(5000)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz")
    dtype = df.schema["t"].dataType
    w = auto_width(df, ["k"], "t", dtype, target=100)
    sizes = df.groupBy("k", bucket_of(F.col("t"), dtype, w).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200          # the hot key (80 % of rows) is cut up
    assert sizes.filter(F.col("k") == 0).count() >= 4000 // 200


def test_keyed_write_reads_only_touched_months(spark, tmp):
    """M5 at scale: the stored table is read through dynamic partition pruning."""
    from pyspark.sql import functions as F

    from tidemark.operators.incremental import table_or_none
    from tidemark.sinks.tables import MONTH, with_month
    df = spark.range(0, 3000).select(F.col("id").alias("k"),
                                     F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"))
    with_month(df, "d").write.partitionBy(MONTH).parquet(f"{tmp}/t")
    new = with_month(df.filter("id < 50"), "d")
    old = table_or_none(spark, f"{tmp}/t").join(new.select(MONTH).distinct(), on=MONTH, how="left_semi")
    old.collect()
    assert "dynamicpruningexpression(mes" in old._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_before_the_shuffle(spark):
    p = _plan(spark, "dedupe_latest")
    assert p.count("WindowGroupLimit") == 2 and p.count("Exchange") == 1 and "SortAggregate" not in p
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")   # the first limit lies below the exchange
