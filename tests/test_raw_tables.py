"""The bootstrapped raw tables are the ones that the job writes; a backfill touches its own series only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_jobs import _extracts, _rows
from test_unlock import expected, quotes, stored

from tidemark import catalog as CAT
from tidemark.plans import macro as M
from tidemark.schemas import RAW_SCHEMAS
from tidemark.sinks.tables import MONTH
from tidemark.sources.rows import from_rows


def _months(spark, table):
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def test_bootstrap_run_job_and_publish_work_on_the_same_tables(spark, tmp):
    CAT.bootstrap_raw(spark, tmp, db="raw_same")
    assert spark.table("raw_same.indices_sgs").count() == 0 and spark.table("raw_same.cdi").count() == 0
    full = _extracts(spark)
    M.run_job(spark, _extracts(spark, "2024-01-15"), tmp, raw_db="raw_same")
    M.run_job(spark, full, tmp, raw_db="raw_same")
    for table, kind in CAT.RAW_TABLES.items():
        got, held = spark.table(f"raw_same.{table}"), spark.read.parquet(f"{tmp}/raw/{kind}")
        assert got.columns == RAW_SCHEMAS[kind].names + [MONTH]
        assert got.count() == held.count() == full[kind].count()
        assert len(_months(spark, f"raw_same.{table}")) == held.select(MONTH).distinct().count()
    for view, code in CAT.SERIES_VIEWS.items():
        assert spark.table(f"raw_same.{view}").count() == full["macro"].filter(F.col("cod_sgs") == code).count() > 0
    assert M.publish(spark, tmp, db="gold_same", raw_db="raw_same")[2:] == [f"raw_same.{t}" for t in CAT.RAW_TABLES]
    assert spark.table("raw_same.cotacao_moedas").count() == full["fx"].count()
    silver = M.silver_variation(*[full[k] for k in ("macro", "quotes", "fx")])
    assert _rows(spark.table("gold_same.variacao_indices").drop(MONTH)) == _rows(silver)
    spark.sql("DROP DATABASE raw_same CASCADE")
    assert spark.read.parquet(f"{tmp}/raw/fx").count() == full["fx"].count()          # external: the files stay


def test_a_month_that_a_run_left_out_becomes_a_partition_on_the_next(spark, tmp):
    """A run that ended between the append and ALTER TABLE: the rerun adds the partition, though no row is new."""
    M.run_job(spark, quotes(spark, (2, "VT", 10.0)), tmp, raw_db="raw_late")
    spark.sql("ALTER TABLE raw_late.cotacoes_indices DROP PARTITION (mes = DATE'2024-01-01')")
    assert spark.table("raw_late.cotacoes_indices").count() == 0
    assert M.run_job(spark, quotes(spark, (2, "VT", 10.0)), tmp, raw_db="raw_late")["raw_quotes"] is False
    assert spark.table("raw_late.cotacoes_indices").count() == 1
    M.run_backfill(spark, {"quotes": from_rows(spark, [(dt.date(2023, 12, 29), "VT", "VT", "VT", 8.0)],
                                               "dataCotacao date, ticker string, codigoTicker string, tickerNome string, fechamento double")},
                   tmp, "2023-12-01", "2023-12-31", raw_db="raw_late")
    assert _months(spark, "raw_late.cotacoes_indices") == ["mes=2023-12-01", "mes=2024-01-01"]
    spark.sql("DROP DATABASE raw_late CASCADE")


def _usd(spark, *rows):
    return from_rows(spark, [(dt.date(2024, 1, d), "USD", v) for d, v in rows], "dataCotacao date, moeda string, cotacaoVenda double")


def test_backfill_of_a_currency_changes_every_later_gold_row_and_no_earlier(spark, tmp):
    q = [(d, "VT", 10.0 + d) for d in (2, 3, 8, 9)]
    M.run_job(spark, quotes(spark, *q) | {"fx": _usd(spark, (2, 5.0), (9, 5.5))}, tmp)
    n = M.run_backfill(spark, {"fx": _usd(spark, (5, 5.2))}, tmp, "2024-01-04", "2024-01-06")
    assert n == {"raw_fx": True, "silver_changed": 2, "gold_changed": 4}              # 5 and 9 of USD; VT on 8 and 9
    fx, qs = _usd(spark, (2, 5.0), (5, 5.2), (9, 5.5)), quotes(spark, *q)["quotes"]
    silver = M.silver_variation(None, qs, fx)
    assert _rows(spark.read.parquet(f"{tmp}/silver").drop(MONTH)) == _rows(silver)
    assert _rows(spark.read.parquet(f"{tmp}/gold").drop(MONTH)) == _rows(M.gold_returns(silver))


@pytest.mark.parametrize("lost", ["silver", "gold"])
def test_backfill_makes_up_for_a_run_that_ended_before_a_layer(spark, tmp, lost, monkeypatch):
    want = [(2, "VT", 10.0), (3, "VT", 12.0), (4, "VT", 9.0)]
    M.run_job(spark, quotes(spark, *want), tmp)
    real, seen = M.staged, []

    def ends(df, checks):
        seen.append(checks)
        if len(seen) == (1 if lost == "silver" else 2):
            raise RuntimeError("lost")
        return real(df, checks)
    monkeypatch.setattr(M, "staged", ends)
    with pytest.raises(RuntimeError):
        M.run_backfill(spark, quotes(spark, (3, "VT", 15.0)), tmp, "2024-01-02", "2024-01-03")
    monkeypatch.setattr(M, "staged", real)
    M.run_backfill(spark, quotes(spark, (3, "VT", 15.0)), tmp, "2024-01-02", "2024-01-03")
    want[1] = (3, "VT", 15.0)
    assert stored(spark, tmp) == expected(*want) == stored(spark, tmp, "silver")


def test_other_series_are_not_computed_again(spark, tmp):
    """A series outside the window's extract keeps its rows even where a recompute would give others."""
    M.run_job(spark, quotes(spark, (2, "VT", 10.0), (3, "VT", 11.0), (2, "X", 5.0), (3, "X", 6.0)), tmp, lookback="none")
    M.run_job(spark, quotes(spark, (4, "VT", 9.0), (4, "X", 9.0)), tmp, lookback="none")            # first new rows: 0
    n = M.run_backfill(spark, quotes(spark, (3, "VT", 20.0)), tmp, "2024-01-02", "2024-01-03")
    got = stored(spark, tmp)
    assert n["silver_changed"] == 2 and got[4, "VT"] == (9.0, 9.0 / 20.0 - 1) and got[4, "X"] == (9.0, 0.0)
    assert {(r.series, r.last_value) for r in spark.read.parquet(f"{tmp}/state").collect()} == {("VT", 9.0), ("X", 9.0)}
