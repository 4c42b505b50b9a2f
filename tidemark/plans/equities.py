"""L2: the equities job - active companies, monthly returns, company dimensions, index
returns, then change-aware upserts into the fact tables.

The reference loops over tickers on the driver (one request, one DataFrame and one
window per ticker, then an N-way union). Here every step is one plan over all tickers:
one scan, one ``Window.partitionBy(ticker)``, one upsert join per table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import epoch_to_text
from ..operators.clean import cleanse_sentinel, drop_null_keys, keep, rename, with_audit
from ..operators.mutate import upsert_changed
from ..operators.returns import with_returns

# Quote fields kept from the most-active screener and their names in the
# fact table, in the reference's order.
QUOTE_FIELDS = {
    "symbol": "ticker",
    "shortName": "nome_curto",
    "displayName": "nome_exibicao",
    "regularMarketPrice": "preco_mercado_regular",
    "regularMarketChange": "mudanca_mercado_regular",
    "regularMarketChangePercent": "mudanca_percentual_mercado_regular",
    "regularMarketVolume": "volume_mercado_regular",
    "marketCap": "capitalizacao_mercado",
    "fullExchangeName": "nome_exchange_completa",
    "quoteSourceName": "nome_fonte_cotacao",
}

# Monthly history fields and their fact-table names.
HISTORY_FIELDS = {"symbol": "ticker", "Date": "data", "Open": "abertura", "High": "alta", "Low": "baixa",
                  "Close": "fechamento", "Volume": "volume", "Dividends": "dividendos",
                  "Stock Splits": "desdobramentos"}

# The five company dimensions - (info field, column, type, default used
# when the field holds an Infinity sentinel; None = no default).
COMPANY_TABLES = {
    "cadastro": [
        ("sector", "setor", "string", None), ("industry", "industria", "string", None),
        ("fullTimeEmployees", "funcionarios", "int", None), ("city", "cidade", "string", None),
        ("state", "estado", "string", None), ("country", "pais", "string", None),
        ("website", "website", "string", None), ("longBusinessSummary", "resumo_negocios", "string", None),
        ("exchange", "exchange", "string", None),
    ],
    "financas": [
        ("marketCap", "capitalizacao_mercado", "bigint", 0), ("enterpriseValue", "valor_empresa", "bigint", 0),
        ("revenue", "receita", "bigint", 0), ("grossProfits", "lucros_brutos", "bigint", 0),
        ("netIncome", "lucro_liquido", "bigint", 0), ("ebitda", "ebitda", "bigint", 0),
        ("totalDebt", "divida_total", "bigint", 0), ("totalCash", "caixa_total", "bigint", 0),
        ("dividendYield", "dividend_yield", "double", 0.0),
    ],
    "mercado": [
        ("currentPrice", "preco_atual", "double", 0.0), ("previousClose", "fechamento_anterior", "double", 0.0),
        ("open", "abertura", "double", 0.0), ("dayLow", "minimo_dia", "double", 0.0),
        ("dayHigh", "maximo_dia", "double", 0.0), ("fiftyTwoWeekLow", "minimo_52_semanas", "double", 0.0),
        ("fiftyTwoWeekHigh", "maximo_52_semanas", "double", 0.0), ("volume", "volume", "bigint", 0),
        ("averageVolume", "volume_medio", "bigint", 0), ("beta", "beta", "double", 0.0),
    ],
    "dividendos": [
        ("dividendRate", "taxa_dividendo", "double", 0.0), ("exDividendDate", "data_exdividendo", "bigint", None),
        ("payoutRatio", "indice_distribuicao", "double", 0.0),
    ],
    "valuation": [
        ("forwardPE", "pl_futuro", "double", 0.0), ("trailingPE", "pl_retroativo", "double", 0.0),
        ("priceToBook", "preco_booking", "double", 0.0), ("pegRatio", "indice_preco_lucro_cresc", "double", 0.0),
    ],
}

# The world indices of the equities job and their display names.
WORLD_INDICES = {
    "^BVSP": "Ibovespa",
    "BOVA11.SA": "BOVA11",
    "^GSPC": "S&P 500",
    "^DJI": "Dow Jones",
    "^IXIC": "NASDAQ",
    "^FTSE": "FTSE 100",
    "^GDAXI": "DAX 30",
    "^N225": "Nikkei 225",
}

# Upsert keys of the fact tables.
UPSERT_KEYS = {
    "retorno_mensal": ["ticker", "data"], "cadastro": ["ticker"], "captacao_mercado": ["ticker"],
    "financas": ["ticker"], "mercado": ["ticker"], "dividendos": ["ticker", "data_exdividendo"],
    "valuation": ["ticker"], "indices": ["indice", "data"],
}


def active_companies(quotes: DataFrame, run_ts=None, order: bool = False) -> DataFrame:
    """Screener quotes -> ``captacao_mercado`` rows."""
    d = keep(quotes, list(QUOTE_FIELDS))
    d = rename(d, QUOTE_FIELDS)
    d = with_audit(d, run_ts)
    d = d.withColumn("ticker", F.col("ticker").cast("string"))
    d = drop_null_keys(d, ["ticker"])
    return d.orderBy(F.col("capitalizacao_mercado").desc()) if order else d


def monthly_returns(history: DataFrame, run_ts=None) -> DataFrame:
    """W1-W3 per ticker by month over all tickers at once (``retorno_mensal``)."""
    d = rename(history, HISTORY_FIELDS)
    d = with_returns(d, "ticker", "data", "fechamento", "fechamento_mes_anterior",
                     "valor_retorno", "porcentagem_retorno")
    d = with_audit(d, run_ts)
    cols = ["ticker", "data", "abertura", "alta", "baixa", "fechamento", "volume", "dividendos",
            "desdobramentos", "fechamento_mes_anterior", "valor_retorno", "porcentagem_retorno",
            "dt_ptcao", "dthr_igtao"]
    return d.select(*[c for c in cols if c in d.columns])


def _company_fields(info: DataFrame, zone: str | None) -> DataFrame:
    """``ticker`` and every dimension's fields, typed, over one scan. Sentinel strings take the field default, absent values
    stay null (Q9); values are ``try_cast`` (Q15). The ex-dividend epoch becomes text (F3)."""
    fields = [f for table in COMPANY_TABLES.values() for f in table]
    cols = [(F.col(src) if src in info.columns else F.lit(None).cast("string")).alias(dst) for src, dst, _, _ in fields]
    t = info.select(F.col("symbol").cast("string").alias("ticker"), *cols)
    t = cleanse_sentinel(t, {dst: dflt for _, dst, _, dflt in fields if dflt is not None},
                         {dst: typ for _, dst, typ, _ in fields})           # P11 + try_cast
    t = t.withColumns({dst: F.col(dst).try_cast(typ) for _, dst, typ, dflt in fields if dflt is None})
    return drop_null_keys(t.withColumn("data_exdividendo", epoch_to_text("data_exdividendo", zone)), ["ticker"])


def split_company_info(info: DataFrame, run_ts=None, zone: str | None = None) -> dict[str, DataFrame]:
    """One wide info record per ticker -> five typed dimension tables, each a projection over ``info``. To write all
    five, ``company_rows`` reads ``info`` once."""
    wide = _company_fields(info, zone)
    return {name: with_audit(wide.select("ticker", *[dst for _, dst, _, _ in fields]), run_ts)
            for name, fields in COMPANY_TABLES.items()}


def company_rows(info: DataFrame, run_ts=None, zone: str | None = None) -> DataFrame:
    """P12 in one pass: every record exploded into one row per dimension (``tabela``), with that dimension's fields and
    null in the others. Written partitioned by ``tabela``, one scan of the extract makes all five tables."""
    wide = _company_fields(info, zone).withColumn("tabela", F.explode(F.array(*[F.lit(n) for n in COMPANY_TABLES])))
    own = [F.when(F.col("tabela") == name, F.col(dst)).alias(dst)
           for name, fields in COMPANY_TABLES.items() for _, dst, _, _ in fields]
    return with_audit(wide.select("tabela", "ticker", *own), run_ts)


def company_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The five tables of stored ``company_rows``: each reads its own partition and its own columns."""
    audit = [c for c in ("dt_ptcao", "dthr_igtao") if c in rows.columns]
    return {name: rows.filter(F.col("tabela") == name).select("ticker", *[dst for _, dst, _, _ in fields], *audit)
            for name, fields in COMPANY_TABLES.items()}


def index_prices_from_extract(extract: DataFrame, names=WORLD_INDICES) -> DataFrame:
    """Daily index extract (``Ticker``, ``Date``, OHLC, optional ``Adj Close``, ``Volume``)
    -> the typed index table: adjusted close when present, else close (P13); known
    indices only, with their display names; volume as bigint (F12, ``try_cast``)."""
    from ..operators.clean import map_values
    closes = [F.col(f"`{c}`").try_cast("double") for c in ("Adj Close", "Close") if c in extract.columns]
    d = extract.withColumn("__adj", F.coalesce(*closes))   # a declared column that the file lacks is null
    d = d.filter(F.col("Ticker").isin(*names))
    return d.select(F.col("Ticker").alias("indice"),
                    F.col("Open").try_cast("double").alias("abertura"),
                    F.col("High").try_cast("double").alias("alta"),
                    F.col("Low").try_cast("double").alias("baixa"),
                    F.col("Close").try_cast("double").alias("fechamento"),
                    F.col("__adj").alias("fechamento_ajustado"),
                    F.col("Volume").try_cast("bigint").alias("volume"),
                    map_values("Ticker", names).alias("nome_indice"),
                    F.to_date("Date").alias("data"))


def index_returns(prices: DataFrame, run_ts=None) -> DataFrame:
    """Daily index table: previous close, absolute and percent return per index. The
    previous value is the previous *trading day*, so it is named ``previous_close``
    (Q13), not "previous month"."""
    d = with_returns(prices, "indice", "data", "fechamento", "previous_close",
                     "valor_retorno", "porcentagem_retorno")
    return with_audit(d, run_ts)


def run_job_from_extracts(spark, extract_dir: str, base: str, run_ts=None, db: str | None = None) -> dict[str, int]:
    """L2 from landed files under ``extract_dir``: ``quotes``, ``history``, ``info`` and
    ``index_daily`` (each optional, at least one; JSON lines or parquet; one scan per kind).
    With ``db`` the facts are catalog tables (``run_job_tables``), else folders under ``base``."""
    from ..sources.files import read_extract_or_none
    d = extract_dir.rstrip("/")
    x: dict[str, DataFrame] = {}
    for kind in ("quotes", "history", "info"):
        if (got := read_extract_or_none(spark, kind, f"{d}/{kind}")) is not None:
            x[kind] = got.drop("source_file")
    if (got := read_extract_or_none(spark, "index_daily", f"{d}/index_daily")) is not None:
        x["index"] = index_prices_from_extract(got)
    if not x:
        raise FileNotFoundError(f"no extract under {d}")
    return run_job(spark, x, base, run_ts) if db is None else run_job_tables(spark, x, base, db, run_ts)


def info_schema() -> T.StructType:
    """Declared text schema of a landed company-info extract (every field text, as
    the API returns mixed types)."""
    names = ["symbol"] + [src for fields in COMPANY_TABLES.values() for src, *_ in fields]
    return T.StructType([T.StructField(n, T.StringType(), n != "symbol") for n in names])


def _stages(extracts: Mapping[str, DataFrame], run_ts) -> dict[str, DataFrame]:
    """Every fact table's arriving rows. The company dimensions are written once, by table, and read back from there."""
    from ..session import materialize
    stages: dict[str, DataFrame] = {}
    if "quotes" in extracts:
        stages["captacao_mercado"] = active_companies(extracts["quotes"], run_ts)
    if "history" in extracts:
        stages["retorno_mensal"] = monthly_returns(extracts["history"], run_ts)
    if "info" in extracts:
        stages.update(company_tables(materialize(company_rows(extracts["info"], run_ts), "company-rows", ["tabela"])))
    if "index" in extracts:
        stages["indices"] = index_returns(extracts["index"], run_ts)
    return stages


def run_job(spark, extracts: Mapping[str, DataFrame], base: str, run_ts=None) -> dict[str, int]:
    """L2 end to end: stage every table from the extracts (``quotes``, ``history``,
    ``info``, ``index``) and upsert each into its stored fact table under ``base``
    (M4: first-seen date kept, touched time only on change). Returns fact row counts.
    Folders have no pointer to move, so each is overwritten; ``run_job_tables`` swaps."""
    from ..operators.incremental import table_or_none
    from ..session import materialize

    counts = {}
    for name, stage in _stages(extracts, run_ts).items():
        path = f"{base.rstrip('/')}/{name}"
        tgt = table_or_none(spark, path)
        out = stage if tgt is None else upsert_changed(tgt, stage.select(*tgt.columns), UPSERT_KEYS[name])
        out = materialize(out, f"fact-{name}")   # the next write replaces the table being read
        out.write.mode("overwrite").parquet(path)
        counts[name] = spark.read.parquet(path).count()
    return counts


# Tests of each fact table, counted while its new state is written: (name, predicate of the rows that fail). The
# ex-dividend date is a key that a company without dividends lacks, so only tickers and days are tested.
FACT_CHECKS = {"retorno_mensal": {"no_ticker": "ticker IS NULL", "no_day": "data IS NULL"},
               "indices": {"no_index": "indice IS NULL", "no_day": "data IS NULL"}}


def run_job_tables(spark, extracts: Mapping[str, DataFrame], base: str, db: str, run_ts=None,
                   buckets: int = 32) -> dict[str, int]:
    """L2 into catalog tables ``db.<fact>``, bucketed by their keys, with files under ``base``: each is upserted into a staged
    table, tested and swapped in (``sinks.swap``). A failed run leaves every table as some whole run left it, and is
    run again as it is: rows that are stored already change nothing. Returns fact row counts."""
    from ..catalog import ensure_database
    from ..sinks.swap import upsert_table

    ensure_database(spark, db)
    return {name: upsert_table(spark, f"{db}.{name}", stage, UPSERT_KEYS[name], base, buckets,
                               FACT_CHECKS.get(name, {"no_ticker": "ticker IS NULL"}))["rows"]
            for name, stage in _stages(extracts, run_ts).items()}
