"""The user-visible jobs: L1 incremental equals a full recompute and is idempotent;
L2 upserts keep first-seen dates."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans import equities as EQ
from tidemark.plans import landing as L
from tidemark.plans import macro as M


def _extracts(spark, cut=None):
    ev, o = L.table(spark, SF_SMALL, "events"), L.table(spark, SF_SMALL, "orders")
    x = {"macro": L.landed_macro(o), "quotes": L.landed_quotes(ev), "fx": L.landed_fx(ev)}
    if cut:
        c = F.lit(cut).cast("date")
        x = {k: v.filter(F.col("data" if k == "macro" else "dataCotacao") <= c) for k, v in x.items()}
    return x


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("scope", ["global", "series"])
def test_macro_job_incremental_equals_full(spark, tmp, scope):
    c1 = M.run_job(spark, _extracts(spark, "2024-01-15"), tmp, scope=scope)
    assert c1["silver_new"] > 0 and c1["gold_new"] > 0
    c2 = M.run_job(spark, _extracts(spark), tmp, scope=scope)
    assert c2["silver_new"] > 0
    silver = spark.read.parquet(f"{tmp}/silver").drop("mes")
    gold = spark.read.parquet(f"{tmp}/gold").drop("mes")
    full_silver = M.silver_variation(*[_extracts(spark)[k] for k in ("macro", "quotes", "fx")])
    assert _rows(silver) == _rows(full_silver)
    assert _rows(gold) == _rows(M.gold_returns(full_silver))
    c3 = M.run_job(spark, _extracts(spark), tmp, scope=scope)   # rerun: nothing new anywhere
    assert c3 == {"raw_macro": False, "raw_quotes": False, "raw_fx": False, "silver_new": 0, "gold_new": 0}


def test_equities_job_upserts(spark, tmp):
    o = L.table(spark, SF_SMALL, "orders")
    li = L.table(spark, SF_SMALL, "lineitem")
    info = L.landed_company_info(L.table(spark, SF_SMALL, "customer"), L.table(spark, SF_SMALL, "nation"))
    bars = L.landed_monthly_bars(li).withColumnsRenamed({"ticker": "symbol", "data": "Date", "fechamento": "Close"})
    x = {"quotes": L.landed_active_quotes(o), "history": bars, "info": info}
    n1 = EQ.run_job(spark, x, tmp, run_ts="2025-09-01 03:00:00")
    assert set(n1) == {"captacao_mercado", "retorno_mensal", "cadastro", "financas", "mercado", "dividendos",
                       "valuation"}
    changed = x["quotes"].withColumn("marketCap", F.col("marketCap") + F.lit(1.0))
    n2 = EQ.run_job(spark, {"quotes": changed}, tmp, run_ts="2025-09-08 03:00:00")
    assert n2["captacao_mercado"] == n1["captacao_mercado"]
    fact = spark.read.parquet(f"{tmp}/captacao_mercado")
    assert fact.filter(F.col("dt_ptcao") != "2025-09-01").count() == 0      # first-seen date kept
    assert fact.filter(F.col("dthr_igtao") == F.lit("2025-09-08 03:00:00").cast("timestamp_ntz")).count() \
        == n1["captacao_mercado"]                                             # all touched
    n3 = EQ.run_job(spark, {"quotes": changed}, tmp, run_ts="2025-09-09 03:00:00")
    fact = spark.read.parquet(f"{tmp}/captacao_mercado")
    assert n3 == n2 and fact.filter(F.col("dthr_igtao") > F.lit("2025-09-08 03:00:00").cast("timestamp_ntz")).count() == 0


def test_notebook_jobs(spark, tmp):
    import datetime as dt

    import pandas as pd

    from tidemark.plans import notebooks as NB
    from tidemark.sources.rows import from_rows
    people = from_rows(spark, [("Alice", 30), ("Bob", 25), ("Carol", 40), ("David", 22)], ["nome", "idade"])
    assert sorted(r.nome for r in NB.adults(people).collect()) == ["Alice", "Carol"]
    pdf = pd.DataFrame({"id": [1, 2, 3], "hora": [dt.time(8, 0), dt.time(9, 15), None]})
    assert NB.extract_to_table(spark, pdf, "extrato_nb") == 3
    w = NB.versioned_walkthrough(spark)
    assert w["latest"] == list(range(20)) and w["v0"] == [0, 1, 2, 3, 4] and w["v3"] == [5, 7, 9]
    assert w["history"] == {0: "WRITE", 1: "WRITE", 2: "UPDATE", 3: "DELETE", 4: "MERGE"}


def test_extract_files_to_raw(spark, tmp):
    import json

    from tidemark.plans.raw import fx_to_raw, index_to_raw, macro_to_raw
    from tidemark.sources.files import read_extract
    rows = {
        "fx": [{"moeda": "USD", "cotacaoVenda": 5.1, "dataHoraCotacao": "2025-09-04T13:00:00", "tipoBoletim": "Fechamento"},
               {"moeda": "USD", "cotacaoVenda": 5.0, "dataHoraCotacao": "2025-09-04T10:00:00", "tipoBoletim": "Abertura"},
               {"moeda": "USD", "cotacaoVenda": 5.2, "dataHoraCotacao": "2025-09-05T13:00:00", "tipoBoletim": "Fechamento"}],
        "index_daily": [{"Date": "2025-09-05T00:00:00", "Ticker": "^BVSP", "Close": 140000.456, "Repaired?": False},
                        {"Date": "2025-09-05T00:00:00", "Ticker": "VT", "Close": 130.005, "Repaired?": True}],
        "macro": [{"data": "2025-09-04", "valor": "0.0551"}, {"data": "2025-09-05", "valor": "0.0551"}],
    }
    for kind, rs in rows.items():
        with open(f"{tmp}/{kind}.json", "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rs))
    fx = fx_to_raw(read_extract(spark, "fx", f"{tmp}/fx.json"), start="2025-09-04").collect()
    assert [(str(r.dataCotacao), r.cotacaoVenda) for r in fx] == [("2025-09-05", 5.2)]     # start day excluded
    ix = {r.ticker: r for r in index_to_raw(read_extract(spark, "index_daily", f"{tmp}/index_daily.json")).collect()}
    assert ix["^BVSP"].codigoTicker == "IBOV" and ix["^BVSP"].fechamento == 140000.46
    assert ix["VT"].tickerNome == "Vanguard Total World" and ix["VT"].fechamento == 130.01   # HALF_UP on the decimal text
    mc = macro_to_raw(read_extract(spark, "macro", f"{tmp}/macro.json"), 12, "cdi").collect()
    assert sorted((str(r.data), r.valor, r.cod_sgs) for r in mc) == [("2025-09-04", 0.0551, 12), ("2025-09-05", 0.0551, 12)]


def test_macro_job_from_extract_files(spark, tmp):
    import json
    import os

    src = f"{tmp}/landed"
    os.makedirs(f"{src}/macro/cdi")
    os.makedirs(f"{src}/fx")
    os.makedirs(f"{src}/index_daily")
    with open(f"{src}/macro/cdi/part.json", "w") as fh:
        fh.write("\n".join(json.dumps({"data": f"2025-09-0{d}", "valor": "0.05"}) for d in (1, 2, 3)))
    with open(f"{src}/fx/part.json", "w") as fh:
        fh.write("\n".join(json.dumps({"moeda": "USD", "cotacaoVenda": 5.0 + d / 10, "tipoBoletim": "Fechamento",
                                       "dataHoraCotacao": f"2025-09-0{d}T13:00:00"}) for d in (1, 2)))
    with open(f"{src}/index_daily/part.json", "w") as fh:
        fh.write("\n".join(json.dumps({"Date": f"2025-09-0{d}T00:00:00", "Ticker": "VT", "Close": 100.0 + d,
                                       "Repaired?": False}) for d in (1, 2, 3)))
    counts = M.run_job_from_extracts(spark, src, f"{tmp}/lake", run_ts="2025-09-08 03:00:00")
    assert counts["silver_new"] == 3 + 2 + 3
    gold = {(str(r.dataCotacao), r.ticker): r for r in spark.read.parquet(f"{tmp}/lake/gold").collect()}
    vt3 = gold[("2025-09-03", "VT")]
    assert vt3.dolar_fechamento == 5.2                         # as of 09-02: no bulletin on 09-03
    assert vt3.retorno_em_reais == vt3.variacao_diaria + vt3.dolar_variacao + vt3.variacao_diaria * vt3.dolar_variacao
    assert M.run_job_from_extracts(spark, src, f"{tmp}/lake")["silver_new"] == 0


def test_equities_job_from_extract_files_and_cli(spark, tmp):
    import json
    import os

    from tidemark import cli
    src = f"{tmp}/landed"
    for k in ("quotes", "index_daily", "info"):
        os.makedirs(f"{src}/{k}")
    with open(f"{src}/quotes/p.json", "w") as fh:
        fh.write("\n".join(json.dumps({"symbol": s, "shortName": s, "marketCap": c}) for s, c in (("AAA", 10), ("BBB", 20))))
    with open(f"{src}/index_daily/p.json", "w") as fh:
        rows = [{"Ticker": "^BVSP", "Date": f"2025-09-0{d}T00:00:00", "Open": 1.0, "High": 2.0, "Low": 0.5,
                 "Close": 100.0 + d, "Volume": 1000.0} for d in (1, 2)]
        rows.append({"Ticker": "XYZ", "Date": "2025-09-01T00:00:00", "Close": 1.0})          # not a tracked index
        fh.write("\n".join(json.dumps(r) for r in rows))
    with open(f"{src}/info/p.json", "w") as fh:
        fh.write(json.dumps({"symbol": "AAA", "beta": "Infinity", "marketCap": "123", "exDividendDate": "1700000000"}))
    out = cli.main(["equities", "--extracts", src, "--lake", f"{tmp}/lake"])
    assert out["captacao_mercado"] == 2 and out["indices"] == 2 and out["mercado"] == 1
    idx = sorted(spark.read.parquet(f"{tmp}/lake/indices").collect(), key=lambda r: r.data)
    assert idx[0].nome_indice == "Ibovespa" and idx[0].fechamento_ajustado == 101.0 and idx[1].previous_close == 101.0
    m = spark.read.parquet(f"{tmp}/lake/mercado").first()
    assert m.beta == 0.0 and m.preco_atual is None                                         # sentinel -> default; absent -> null


def test_publish_registers_and_documents(spark, tmp):
    M.run_job(spark, _extracts(spark, "2024-01-05"), tmp)
    silver, gold, *raw = M.publish(spark, tmp, db="gold_t", raw_db="raw_pub")
    assert raw == ["raw_pub.indices_sgs", "raw_pub.cotacao_moedas", "raw_pub.cotacoes_indices"]
    assert spark.table("raw_pub.cotacao_moedas").count() == spark.read.parquet(f"{tmp}/raw/fx").count()
    assert spark.table(gold).count() == spark.read.parquet(f"{tmp}/gold").count()
    desc = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {gold}").collect()}
    assert desc["dolar_fechamento"] == "Fechamento do dólar no dia"
    assert spark.table(silver).filter("ticker = 'USD'").count() > 0


def test_silver_increment_scopes_slow_series(spark):
    """Q6: a slow series whose new rows are older than the newest stored row is skipped
    by the global watermark and kept by the per-series one."""
    from datetime import date

    from tidemark.sources.rows import from_rows
    q_schema = "dataCotacao date, ticker string, codigoTicker string, tickerNome string, fechamento double"
    quotes = from_rows(spark, [(date(2024, 1, d), "A", "A", "A", 10.0 + d) for d in (1, 5, 10, 11)] +
                       [(date(2024, 1, d), "B", "B", "B", 20.0 + d) for d in (1, 5, 7)], q_schema)
    stored = M.silver_variation(None, quotes.filter("dataCotacao <= '2024-01-05' OR ticker = 'A' AND dataCotacao <= '2024-01-10'"))
    glob = M.silver_increment(stored, None, quotes, None, lookback="last")
    per = M.silver_increment(stored, None, quotes, None, lookback="last", scope="series")
    g = {(r.ticker, r.dataCotacao.day) for r in glob.collect()}
    p = {(r.ticker, r.dataCotacao.day): r.variacao_diaria for r in per.collect()}
    assert ("B", 7) not in g and ("A", 11) in g
    assert p[("B", 7)] == 27.0 / 25.0 - 1 and p[("A", 11)] == 21.0 / 20.0 - 1


def test_gold_increment_series_scope(spark):
    from datetime import date

    from tidemark.sources.rows import from_rows
    schema = "dataCotacao date, indicador string, ticker string, tickernome string, fechamento double, variacao_diaria double"
    silver = from_rows(spark, [(date(2024, 1, d), "USD", "USD", "USD", 5.0, 0.01) for d in (1, 2, 3)] +
                       [(date(2024, 1, d), "VT", "VT", "VT", 10.0, 0.02) for d in (1, 2)], schema)
    gold = M.gold_returns(silver.filter("dataCotacao <= '2024-01-03' AND ticker = 'USD' OR dataCotacao = '2024-01-01'"))
    glob = {(r.ticker, r.dataCotacao.day) for r in M.gold_increment(gold, silver, "last").collect()}
    per = {(r.ticker, r.dataCotacao.day): r for r in M.gold_increment(gold, silver, "last", scope="series").collect()}
    assert ("VT", 2) not in glob
    assert per[("VT", 2)].retorno_em_reais == 0.02 + 0.01 + 0.02 * 0.01


def test_bad_row_is_not_stored_and_fails_the_retry(spark, tmp):
    import datetime as dt

    from tidemark.operators.incremental import table_or_none
    from tidemark.plans.macro import run_job
    quotes = spark.createDataFrame([("VT", "VT", dt.date(2024, 1, 2), None)],
                                   "ticker string, tickerNome string, dataCotacao date, fechamento double")
    for _ in range(2):
        with pytest.raises(Exception):
            run_job(spark, {"quotes": quotes}, tmp)
        assert table_or_none(spark, f"{tmp}/silver") is None


def test_null_month_survives_a_keyed_write(spark, tmp):
    from tidemark.sinks.tables import replace_by_key_write
    path = f"{tmp}/t"
    rows = lambda *r: spark.createDataFrame(list(r), "k long, day date")
    replace_by_key_write(spark, rows((1, None)), path, ["k"], "day")
    replace_by_key_write(spark, rows((9, None)), path, ["k"], "day")
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_sentinel_text_never_fails_the_job(spark):
    from tidemark.operators.clean import cleanse_sentinel
    df = spark.createDataFrame([("3000000000000.0", "oops"), ("Infinity", "1.5"), ("1.5", None)], "cap string, x string")
    got = cleanse_sentinel(df, {"cap": 0, "x": 0.0}, {"cap": "bigint", "x": "double"}).collect()
    assert [tuple(r) for r in got] == [(3000000000000, None), (0, 1.5), (None, None)]


def test_upsert_keeps_a_column_that_the_source_lacks(spark):
    from tidemark.operators.mutate import upsert_changed
    tgt = spark.createDataFrame([(1, "a", "b", "d0", "h0")], "k long, x string, y string, dt_ptcao string, dthr_igtao string")
    src = spark.createDataFrame([(1, "z", "d1", "h1")], "k long, x string, dt_ptcao string, dthr_igtao string")
    assert [tuple(r) for r in upsert_changed(tgt, src, ["k"]).collect()] == [(1, "z", "b", "d0", "h1")]


def test_backfill_equals_full_and_is_idempotent(spark, tmp):
    """A window older than the watermark is filled: silver and gold equal a full recompute, and a second run
    changes nothing."""
    full = _extracts(spark)

    def held(kind, df):
        c = "data" if kind == "macro" else "dataCotacao"
        return df.filter(~F.col(c).between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-12").cast("date")))
    M.run_job(spark, {k: held(k, v) for k, v in full.items()}, tmp)
    assert M.run_job(spark, full, tmp)["silver_new"] == 0             # the increment cannot see them
    n = M.run_backfill(spark, full, tmp, "2024-01-07", "2024-01-12")
    assert n["silver_changed"] > 0 and n["gold_changed"] > 0
    silver = M.silver_variation(*[full[k] for k in ("macro", "quotes", "fx")])
    assert _rows(spark.read.parquet(f"{tmp}/silver").drop("mes")) == _rows(silver)
    assert _rows(spark.read.parquet(f"{tmp}/gold").drop("mes")) == _rows(M.gold_returns(silver))
    again = M.run_backfill(spark, full, tmp, "2024-01-07", "2024-01-12")
    assert not any(again.values())


def test_extracts_are_found_by_uri_and_none_is_an_error(spark, tmp):
    import json
    import os

    os.makedirs(f"{tmp}/in/index_daily")
    with open(f"{tmp}/in/index_daily/p.json", "w") as fh:
        fh.write(json.dumps({"Ticker": "^BVSP", "Date": "2025-09-01T00:00:00", "Close": 100.0, "Adj Close": 90.0}))
    assert EQ.run_job_from_extracts(spark, f"file://{tmp}/in", f"{tmp}/lake") == {"indices": 1}
    assert spark.read.parquet(f"{tmp}/lake/indices").first().fechamento_ajustado == 90.0
    assert M.run_job_from_extracts(spark, f"file://{tmp}/in", f"{tmp}/macro")["silver_new"] == 1
    for job in (EQ, M):
        with pytest.raises(FileNotFoundError):
            job.run_job_from_extracts(spark, f"file://{tmp}/nowhere", f"{tmp}/lake2")


def test_rows_without_a_time_give_the_same_answer_in_both_forms(spark):
    from tidemark.operators.returns import with_previous
    df = spark.createDataFrame([("a", None, 1, 1.0), ("a", None, 2, 2.0), ("a", 10, 3, 3.0), ("a", 25, 4, 4.0), ("b", 3, 5, 5.0)],
                               "k string, t int, o int, v double")
    plain = with_previous(df, "k", "t", "v", order=["o"])
    assert _rows(with_previous(df, "k", "t", "v", order=["o"], bucket_width=10)) == _rows(plain)
