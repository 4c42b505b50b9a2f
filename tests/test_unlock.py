"""L1 after bad input: rejected rows are kept apart, and corrections, later days and backfills get through."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from test_jobs import _extracts, _rows

from tidemark.operators import incremental as I
from tidemark.plans import macro as M
from tidemark.sources.rows import from_rows

SCHEMA = "dataCotacao date, ticker string, codigoTicker string, tickerNome string, fechamento double"


def quotes(spark, *rows):
    return {"quotes": from_rows(spark, [(dt.date(2024, 1, d), t, t, t, v) for d, t, v in rows], SCHEMA)}


def stored(spark, base, layer="gold"):
    return {(r.dataCotacao.day, r.ticker): (r.fechamento, r.variacao_diaria) for r in spark.read.parquet(f"{base}/{layer}").collect()}


def expected(*rows):
    out, last = {}, {}
    for d, t, v in rows:
        out[d, t] = (v, v / last[t] - 1 if t in last else 0.0)
        last[t] = v
    return out


@pytest.mark.parametrize("scope", ["series", "global"])
def test_a_bad_raw_row_locks_nothing(spark, tmp, scope):
    """A bad day, its correction, a new day and a backfill."""
    M.run_job(spark, quotes(spark, (2, "VT", 10.0), (2, "X", 5.0)), tmp, scope=scope)
    with pytest.raises(M.RejectedRows):
        M.run_job(spark, quotes(spark, (3, "VT", None), (3, "X", 6.0)), tmp, scope="series")
    assert stored(spark, tmp) == expected((2, "VT", 10.0), (2, "X", 5.0), (3, "X", 6.0))       # the good row is stored
    held = spark.read.parquet(f"{tmp}/quarantine").collect()
    assert [(r.kind, r.reason, json.loads(r.record)["ticker"]) for r in held] == [("quotes", "missing fechamento", "VT")]
    M.run_job(spark, quotes(spark, (3, "VT", 12.0), (3, "X", 6.0)), tmp, scope="series")
    M.run_job(spark, quotes(spark, (4, "VT", 9.0)), tmp, scope=scope)
    want = [(2, "VT", 10.0), (2, "X", 5.0), (3, "VT", 12.0), (3, "X", 6.0), (4, "VT", 9.0)]
    assert stored(spark, tmp) == expected(*want)
    M.run_backfill(spark, quotes(spark, (3, "VT", 15.0)), tmp, "2024-01-02", "2024-01-03")         # a past day restated
    want[2] = (3, "VT", 15.0)
    assert stored(spark, tmp) == expected(*want) and stored(spark, tmp, "silver") == expected(*want)
    M.run_job(spark, quotes(spark, (5, "VT", 18.0)), tmp, scope=scope)
    assert stored(spark, tmp) == expected(*want, (5, "VT", 18.0))


def test_a_correction_after_a_later_day_needs_the_backfill(spark, tmp):
    M.run_job(spark, quotes(spark, (2, "VT", 10.0)), tmp)
    with pytest.raises(M.RejectedRows):
        M.run_job(spark, quotes(spark, (3, "VT", None), (4, "VT", 11.0)), tmp)
    with pytest.raises(M.RejectedRows):                                                        # met again, kept once
        M.run_job(spark, quotes(spark, (3, "VT", None)), tmp)
    assert spark.read.parquet(f"{tmp}/quarantine").count() == 1
    M.run_backfill(spark, quotes(spark, (3, "VT", 20.0)), tmp, "2024-01-01", "2024-01-10")
    assert stored(spark, tmp) == expected((2, "VT", 10.0), (3, "VT", 20.0), (4, "VT", 11.0))


def test_a_run_cut_off_after_silver_is_made_up(spark, tmp):
    """The state is older than silver: the next run replaces the same keys."""
    M.run_job(spark, quotes(spark, (2, "VT", 10.0)), tmp)
    state = spark.read.parquet(f"{tmp}/state").collect()
    M.run_job(spark, quotes(spark, (3, "VT", 11.0)), tmp)
    spark.createDataFrame(state).write.mode("overwrite").parquet(f"{tmp}/state")
    M.run_job(spark, quotes(spark, (4, "VT", 22.0)), tmp)
    assert stored(spark, tmp, "silver") == expected((2, "VT", 10.0), (3, "VT", 11.0), (4, "VT", 22.0))


def test_state_holds_the_last_row_of_every_series(spark, tmp):
    x = _extracts(spark)
    M.run_job(spark, _extracts(spark, "2024-01-15"), tmp)
    M.run_job(spark, x, tmp)
    assert _rows(spark.read.parquet(f"{tmp}/state")) == _rows(M.raw_state(x["macro"], x["quotes"], x["fx"]))


@pytest.mark.parametrize("lookback", ["none", "last"])
@pytest.mark.parametrize("scope", ["global", "series"])
def test_increment_from_state_equals_the_one_from_history(spark, lookback, scope):
    cut, x = _extracts(spark, "2024-01-12"), _extracts(spark)
    raw = (x["macro"], x["quotes"], x["fx"])
    silver = M.silver_variation(cut["macro"], cut["quotes"], cut["fx"])
    state = M.raw_state(cut["macro"], cut["quotes"], cut["fx"])
    a = M.silver_increment(silver, *raw, lookback=lookback, scope=scope)
    b = M.silver_increment(silver, *raw, lookback=lookback, scope=scope, state=state)
    assert _rows(a) == _rows(b)


def test_new_rows_scan_every_extract_once(spark, tmp):
    x = _extracts(spark)
    for k, v in x.items():
        v.write.parquet(f"{tmp}/{k}")
    raw = [spark.read.parquet(f"{tmp}/{k}") for k in ("macro", "quotes", "fx")]
    M.raw_state(*raw).write.parquet(f"{tmp}/state")
    new = M.silver_new_rows(spark.read.parquet(f"{tmp}/state"), *raw, scope="global")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(f"{tmp}/{k}]") for k in ("macro", "quotes", "fx")] == [1, 1, 1]
    assert plan.count("GreaterThan(dataCotacao,") == 2 and "GreaterThan(data," in plan     # the watermark reaches the scans


def test_watermark_from_footers(spark, tmp):
    days = spark.range(5000).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 777).cast("int")).alias("d"),
                                    F.col("id").cast("timestamp").cast("timestamp_ntz").alias("t"))
    days.write.parquet(f"{tmp}/t")
    for c in ("d", "t"):
        got = I.footer_watermark(spark, f"{tmp}/t", c)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert c == "t" or f"PushedAggregation: [MAX({c})]" in plan     # Spark trusts no footer for timestamps
        assert got.first()[0] == days.agg(F.max(c)).first()[0]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")                   # the caller's session is as it was


def test_broken_lines_and_failed_casts_are_quarantined(spark, tmp):
    src = f"{tmp}/landed"
    for k, lines in {"macro/cdi": ['{"data":"2025-09-01","valor":"0.05"}', '{"data":"2025-09-02","valor":"n/a"}', '{"data":"2025-09-03"'],
                     "fx": ['{"moeda":"USD","cotacaoVenda":5.1,"tipoBoletim":"Fechamento","dataHoraCotacao":"2025-09-01T13:00:00"}',
                            '{"moeda":"USD","cotacaoVenda":"five","tipoBoletim":"Fechamento","dataHoraCotacao":"2025-09-02T13:00:00"}']}.items():
        os.makedirs(f"{src}/{k}")
        with open(f"{src}/{k}/day.json", "w") as fh:
            fh.write("\n".join(lines))
    with pytest.raises(M.RejectedRows):
        M.run_job_from_extracts(spark, src, f"{tmp}/lake")
    held = sorted((r.kind, r.source_file, r.reason, r.record) for r in spark.read.parquet(f"{tmp}/lake/quarantine").collect())
    assert held == [("fx", "day.json", "wrong type", '{"moeda":"USD","cotacaoVenda":"five","tipoBoletim":"Fechamento","dataHoraCotacao":"2025-09-02T13:00:00"}'),
                    ("macro", "day.json", "broken line", '{"data":"2025-09-03"'),
                    ("macro", "day.json", "cast of valor", '{"data":"2025-09-02","valor":"n/a"}')]
    assert {(r.dataCotacao.day, r.ticker) for r in spark.read.parquet(f"{tmp}/lake/silver").collect()} == {(1, "12"), (1, "USD")}
