"""Fact tables replaced by a pointer: staged, tested while written, swapped; the company split in one pass."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.plans import equities as EQ
from tidemark.plans import landing as L
from tidemark.sinks import swap as SW

COLS = "k string, v long, dt_ptcao string, dthr_igtao string"


@pytest.fixture()
def db(spark):
    import uuid
    name = f"swap_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _frame(spark, rows, day="d0"):
    return spark.createDataFrame([(k, v, day, f"{day}h") for k, v in rows], COLS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_keeps_first_seen_and_counts_while_writing(spark, db, tmp):
    t = f"{db}.fact"
    assert SW.upsert_table(spark, t, _frame(spark, [("a", 1), ("b", 2)]), ["k"], tmp, 4) == {"rows": 2}
    first = SW.described(spark, t)["Location"]
    assert SW.upsert_table(spark, t, _frame(spark, [("a", 1), ("b", 3), ("c", 4)], "d1"), ["k"], tmp, 16) == {"rows": 3}
    assert _rows(spark.table(t)) == [("a", 1, "d0", "d0h"), ("b", 3, "d0", "d1h"), ("c", 4, "d1", "d1h")]
    d = SW.described(spark, t)
    assert d["Location"] != first and d["Num Buckets"] == "4" and "k" in d["Bucket Columns"]   # the stored bucketing stays
    assert len(spark.read.parquet(first).collect()) == 2                                       # nothing was deleted
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["fact"]
    assert len(SW.clean_leftovers(spark, t, tmp)) == 1 and spark.table(t).count() == 3


def test_a_run_that_dies_between_stage_and_swap_leaves_the_table(spark, db, tmp, monkeypatch):
    t = f"{db}.fact"
    SW.upsert_table(spark, t, _frame(spark, [("a", 1)]), ["k"], tmp, 4)
    with monkeypatch.context() as m:
        m.setattr(SW, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            SW.upsert_table(spark, t, _frame(spark, [("a", 2)], "d1"), ["k"], tmp, 4)
    assert _rows(spark.table(t)) == [("a", 1, "d0", "d0h")]
    assert len(spark.sql(f"SHOW TABLES IN {db}").collect()) == 2                               # the staged one is left behind
    SW.clean_leftovers(spark, t, tmp)
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["fact"]
    SW.upsert_table(spark, t, _frame(spark, [("a", 2)], "d1"), ["k"], tmp, 4)
    assert _rows(spark.table(t)) == [("a", 2, "d0", "d1h")]


def test_a_failing_row_discards_the_state(spark, db, tmp):
    import os
    t = f"{db}.fact"
    checks = {"no_key": "k IS NULL", "negative": F.col("v") < 0}
    SW.upsert_table(spark, t, _frame(spark, [("a", 1)]), ["k"], tmp, 4, checks)
    with pytest.raises(AssertionError, match="'no_key': 1, 'negative': 2"):
        SW.upsert_table(spark, t, _frame(spark, [("b", -1), (None, -2)], "d1"), ["k"], tmp, 4, checks)
    assert _rows(spark.table(t)) == [("a", 1, "d0", "d0h")] and len(os.listdir(f"{tmp}/fact")) == 1
    with pytest.raises(Exception, match="more than one source row"):
        SW.upsert_table(spark, f"{db}.other", _frame(spark, [("a", 1), ("a", 2)]), ["k"], tmp, 4)
    assert not spark.catalog.tableExists(f"{db}.other")


def test_empty_tables_null_keys_and_reordered_columns(spark, db, tmp):
    t = f"{db}.fact"
    assert SW.upsert_table(spark, t, _frame(spark, []), ["k"], tmp, 4) == {"rows": 0}
    src = _frame(spark, [(None, 1), (None, 2), ("a", 3)]).select("v", "dthr_igtao", "k", "dt_ptcao").withColumn("v", F.col("v").cast("int"))
    assert SW.upsert_table(spark, t, src, ["k"], tmp, 4) == {"rows": 3}
    assert SW.upsert_table(spark, t, src, ["k"], tmp, 4) == {"rows": 5}                        # Q3: a null key never matches
    assert SW.upsert_table(spark, t, _frame(spark, []), ["k"], tmp, 4) == {"rows": 5}


def test_the_stored_side_is_not_exchanged_and_a_bucket_is_one_file(spark, db, tmp):
    import glob
    t = f"{db}.fact"
    wide = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("d0").alias("dt_ptcao"),
                                    F.lit("h0").alias("dthr_igtao"))
    SW.upsert_table(spark, t, wide, ["k"], tmp, 16)
    plan = SW.upsert_plan(spark, t, wide.withColumn("v", F.col("v") + 1), ["k"], 16)
    p = _plan(plan)
    assert p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p and "SortMergeJoin" in p
    assert "Exchange" not in p[p.index("FileScan parquet") - 200:p.index("FileScan parquet")]
    SW.upsert_table(spark, t, wide.withColumn("v", F.col("v") + 1), ["k"], tmp, 16)
    assert len(glob.glob(f"{SW.described(spark, t)['Location'].removeprefix('file:')}/*.parquet")) == 16
    assert spark.table(t).filter("v = cast(k AS long) + 1").count() == 5000


def test_company_tables_take_one_scan_and_equal_the_projections(spark):
    info = L.landed_company_info(L.table(spark, SF_SMALL, "customer"), L.table(spark, SF_SMALL, "nation"))
    rows = EQ.company_rows(info, "2025-09-08 03:00:00", "UTC")
    assert len(re.findall(r"FileScan parquet[^\n]*customer", _plan(rows))) == 1
    split = EQ.split_company_info(info, "2025-09-08 03:00:00", "UTC")
    for name, got in EQ.company_tables(rows).items():
        assert got.columns == split[name].columns and _rows(got) == _rows(split[name])
    assert {r.tabela for r in rows.select("tabela").distinct().collect()} == set(EQ.COMPANY_TABLES)


def test_stored_company_tables_read_their_own_partition(spark):
    from tidemark.session import materialize
    info = L.landed_company_info(L.table(spark, SF_SMALL, "customer"), L.table(spark, SF_SMALL, "nation"))
    stored = EQ.company_tables(materialize(EQ.company_rows(info, "2025-09-08 03:00:00", "UTC"), "company-rows", ["tabela"]))
    p = _plan(stored["valuation"])
    assert re.search(r"PartitionFilters: \[[^\]]*tabela[^\]]*valuation", p)
    assert re.search(r"ReadSchema: struct<[^>]*pl_futuro", p) and "resumo_negocios" not in p[p.index("ReadSchema"):]


def test_equities_job_into_tables_equals_the_folder_job(spark, db, tmp):
    info = L.landed_company_info(L.table(spark, SF_SMALL, "customer"), L.table(spark, SF_SMALL, "nation"))
    quotes = L.landed_active_quotes(L.table(spark, SF_SMALL, "orders"))
    runs = [({"quotes": quotes, "info": info}, "2025-09-01 03:00:00"),
            ({"quotes": quotes.withColumn("marketCap", F.col("marketCap") + 1.0), "info": info.withColumn("beta", F.lit("1.5"))},
             "2025-09-08 03:00:00")]
    for x, ts in runs:
        a = EQ.run_job(spark, x, f"{tmp}/folders", ts)
        b = EQ.run_job_tables(spark, x, f"{tmp}/tables", db, ts, buckets=4)
        assert a == b
    for name in a:
        t = spark.table(f"{db}.{name}")
        assert _rows(t) == _rows(spark.read.parquet(f"{tmp}/folders/{name}").select(*t.columns))
    assert spark.table(f"{db}.mercado").filter("beta <> 1.5").isEmpty()
