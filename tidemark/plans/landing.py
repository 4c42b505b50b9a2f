"""Landed extracts derived from the driver's test tables.

The reference fetches its raw tables from web APIs; here the same shapes are derived,
distributed, from the given tables so every job reads data that grows with the input:

* index quotes (``raw.cotacoes_indices``): daily bars of ``events`` per event type, the
  event type playing the ticker (click -> VT, view -> ^GSPC, signup -> ^BVSP,
  error -> IDIV.SA);
* FX bulletins (``raw.cotacao_moedas``): the last ``purchase`` event of each business
  day as the USD closing bulletin (bulletins exist on weekdays only, so the as-of join
  has real gaps to bridge);
* macro series (``raw.cdi/ipca/igpm``): the daily maximum ``o_totalprice`` per order
  status (F -> CDI 12, O -> IPCA 433, P -> IGP-M 189);
* monthly equity bars: ``lineitem`` prices per supplier and ship month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import map_values, with_audit

# Fixed values of the reference's index extract: ticker -> display name and
# ticker -> code (anything else passes through unchanged).
TICKER_NAMES = {"VT": "Vanguard Total World", "^BVSP": "Ibovespa", "^GSPC": "S&P 500", "IDIV.SA": "IDIV"}
TICKER_CODES = {"VT": "VT", "^BVSP": "IBOV", "^GSPC": "S&P500", "IDIV.SA": "IDIV",
                "DIVO11.SA": "IDIV - DIVO11 IT ETF"}
# The macro series the reference loads (SGS code, name).
MACRO_SERIES = {"cdi": 12, "ipca": 433, "igpm": 189}

# Test-data roles (ours): which event type plays which ticker / currency, and which
# order status plays which macro series.
EVENT_TICKERS = {"click": "VT", "view": "^GSPC", "signup": "^BVSP", "error": "IDIV.SA"}
FX_EVENT, FX_CURRENCY = "purchase", "USD"
STATUS_SERIES = {"F": "cdi", "O": "ipca", "P": "igpm"}

RUN_TS = "2025-09-08 03:00:00"  # injected run time for reproducible audit columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tick_order():
    return F.struct("ts", "event_id")


def landed_quotes(events: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """Daily index bars in the ``raw.cotacoes_indices`` shape (one partial aggregate)."""
    ev = events.filter(F.col("event_type").isin(*EVENT_TICKERS))
    bars = (ev.groupBy(F.to_date("ts").alias("dataCotacao"), "event_type")
              .agg(F.max_by("value", _tick_order()).alias("fechamento"),
                   F.max("value").alias("maiorAlta"),
                   F.min_by("value", _tick_order()).alias("abertura"),
                   F.count(F.lit(1)).cast("double").alias("volume"),
                   F.max("ts").alias("dataHoraCotacao")))
    ticker = map_values("event_type", EVENT_TICKERS)
    out = (bars.withColumn("ticker", ticker)
           .withColumns({"codigoTicker": map_values("ticker", TICKER_CODES),
                         "tickerNome": map_values("ticker", TICKER_NAMES),
                         "corrigiuDividendos": F.lit(False)}))
    out = with_audit(out, run_ts, date_col=None, ts_col="dt_ingestao")
    return out.select("dataCotacao", "ticker", "codigoTicker", "tickerNome", "fechamento", "maiorAlta",
                      "abertura", "corrigiuDividendos", "volume", "dataHoraCotacao", "dt_ingestao")


def landed_fx(events: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """Closing USD bulletins in the ``raw.cotacao_moedas`` shape, weekdays only."""
    ev = (events.filter(F.col("event_type") == FX_EVENT)
                .withColumn("dataCotacao", F.to_date("ts"))
                .filter(F.weekday("dataCotacao") < 5))
    # the currency comes from the data (event type -> currency), as a real bulletin
    # feed carries it per row, rather than a constant the optimizer would fold away
    day = (ev.groupBy("dataCotacao", map_values("event_type", {FX_EVENT: FX_CURRENCY}).alias("moeda"))
             .agg(F.max_by("value", _tick_order()).alias("cotacaoVenda"),
                  F.min("value").alias("cotacaoCompra"),
                  F.max("ts").alias("dataHoraCotacao")))
    out = day.withColumns({"paridadeCompra": F.lit(1.0),
                           "paridadeVenda": F.lit(1.0), "tipoBoletim": F.lit("Fechamento")})
    out = with_audit(out, run_ts, date_col=None, ts_col="dt_ingestao")
    return out.select("dataCotacao", "moeda", "cotacaoCompra", "cotacaoVenda", "paridadeCompra",
                      "paridadeVenda", "dataHoraCotacao", "tipoBoletim", "dt_ingestao")


def landed_macro(orders: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """Daily macro series in the ``raw.cdi/ipca/igpm`` shape (all three in one frame,
    keyed ``(cod_sgs, data)``)."""
    name = map_values("o_orderstatus", STATUS_SERIES, default=F.lit(None).cast("string"))
    code = map_values(name, {k: str(v) for k, v in MACRO_SERIES.items()},
                      default=F.lit(None).cast("string")).cast("bigint")
    daily = (orders.groupBy(F.col("o_orderstatus"), F.to_date("o_orderdate").alias("data"))
                   .agg(F.max("o_totalprice").alias("valor")))
    out = (daily.withColumns({"cod_sgs": code, "nm_indice": name})
                .filter(F.col("cod_sgs").isNotNull()))
    out = with_audit(out, run_ts, date_col=None, ts_col="dt_ingestao")
    return out.select("cod_sgs", "nm_indice", "data", "valor", "dt_ingestao")


def _line_order():
    return F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")


def landed_monthly_bars(lineitem: DataFrame) -> DataFrame:
    """Monthly OHLCV bars per supplier (the equities history extract): one partial
    aggregate over all lines, no per-ticker loop."""
    month = F.trunc(F.to_date("l_shipdate"), "month")
    return (lineitem.groupBy(F.col("l_suppkey").cast("string").alias("ticker"), month.alias("data"))
                    .agg(F.min_by("l_extendedprice", _line_order()).alias("abertura"),
                         F.max("l_extendedprice").alias("alta"),
                         F.min("l_extendedprice").alias("baixa"),
                         F.max_by("l_extendedprice", _line_order()).alias("fechamento"),
                         F.sum("l_quantity").alias("volume")))


def landed_active_quotes(orders: DataFrame) -> DataFrame:
    """Screener extract with the API field names (plus one field the job drops): an
    order plays a listed company, its total price the market cap."""
    return orders.select(
        F.col("o_orderkey").alias("symbol"),
        F.col("o_orderpriority").alias("shortName"),
        F.col("o_orderstatus").alias("displayName"),
        F.col("o_totalprice").alias("regularMarketPrice"),
        F.col("o_custkey").alias("regularMarketVolume"),
        F.col("o_totalprice").alias("marketCap"),
        F.col("o_orderpriority").alias("fullExchangeName"),
        F.col("o_orderstatus").alias("quoteSourceName"),
        F.col("o_orderdate").alias("firstTradeDate"))


def landed_company_info(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Company-info extract, every field as text like the API's mixed JSON: a customer
    plays a company. A negative balance arrives as the ``-Infinity`` sentinel; of the other numbers one key in five arrives as
    ``Infinity``, one as ``-Infinity``, one is missing and one total debt is no number; whole numbers may be written with a
    point. City and the texts are absent (null). ``nation`` is TPC-H's fixed 25-row dimension;
    the join is left to AQE (broadcast when the runtime size allows)."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name"))
    c = customer.join(n, on="c_nationkey", how="left")
    bal, key = F.col("c_acctbal"), F.col("c_custkey")
    price = F.when(bal < 0, F.lit("-Infinity")).otherwise(bal.cast("string"))
    fifth = key % 5

    def sometimes(value):
        return (F.when(fifth == 0, F.lit("Infinity")).when(fifth == 1, F.lit("-Infinity"))
                .when(fifth == 2, F.lit(None).cast("string")).otherwise(value.cast("string")))
    return c.select(
        F.col("c_name").alias("symbol"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("string").alias("fullTimeEmployees"),
        F.col("n_name").alias("country"),
        F.upper("n_name").alias("state"),
        F.concat(F.lit("X-"), F.col("c_mktsegment")).alias("exchange"),
        key.cast("string").alias("marketCap"),
        F.concat((key * 3).cast("string"), F.lit(".0")).alias("enterpriseValue"),
        sometimes(key * 1000).alias("revenue"),
        sometimes(key * 100).alias("grossProfits"),
        (key - 500).cast("string").alias("netIncome"),
        sometimes(key - 700).alias("ebitda"),
        F.when(fifth == 3, F.lit("n/a")).otherwise(sometimes(key * 7)).alias("totalDebt"),
        sometimes(F.concat(key.cast("string"), F.lit(".0"))).alias("totalCash"),
        sometimes(bal / 100).alias("dividendYield"),
        price.alias("currentPrice"),
        price.alias("previousClose"),
        sometimes(bal + 1).alias("open"),
        sometimes(bal - 1).alias("dayLow"),
        sometimes(bal + 2).alias("dayHigh"),
        (bal - 50).cast("string").alias("fiftyTwoWeekLow"),
        (bal + 50).cast("string").alias("fiftyTwoWeekHigh"),
        key.cast("string").alias("volume"),
        F.col("c_nationkey").cast("string").alias("averageVolume"),
        sometimes(bal / 1000).alias("beta"),
        sometimes(bal / 10).alias("dividendRate"),
        (key * F.lit(86400) + F.lit(1700000000)).cast("string").alias("exDividendDate"),
        sometimes(bal / 3).alias("payoutRatio"),
        sometimes(bal / 5).alias("forwardPE"),
        sometimes(bal / 6).alias("trailingPE"),
        (bal / 7).cast("string").alias("priceToBook"),
        sometimes(bal / 9).alias("pegRatio"))
