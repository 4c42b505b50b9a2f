"""Declared schemas (S2/C7): raw tables, silver/gold and the landed extracts.

Declared at the boundary so nothing is inferred at scale. Length limits of the source
DDL (``VARCHAR(n)``) are not enforced.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, TS, DT, B, I = (T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(),
                         T.DateType(), T.BooleanType(), T.IntegerType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# raw macro series (one table per series in the source: cdi, ipca, igpm); key (cod_sgs, data)
RAW_MACRO = _st(("cod_sgs", L, False), ("nm_indice", S, False), ("data", DT, False), ("valor", D, True),
                ("dt_ingestao", TS, True))
# raw FX bulletins; key (dataCotacao, moeda)
RAW_FX = _st(("dataCotacao", DT, False), ("moeda", S, False), ("cotacaoCompra", D, True),
             ("cotacaoVenda", D, True), ("paridadeCompra", D, True), ("paridadeVenda", D, True),
             ("dataHoraCotacao", TS, True), ("tipoBoletim", S, True), ("dt_ingestao", TS, True))
# raw index quotes; key (dataCotacao, ticker)
RAW_QUOTES = _st(("dataCotacao", DT, True), ("ticker", S, True), ("codigoTicker", S, True),
                 ("tickerNome", S, True), ("fechamento", D, True), ("maiorAlta", D, True), ("abertura", D, True),
                 ("corrigiuDividendos", B, True), ("volume", D, True), ("dataHoraCotacao", TS, True),
                 ("dt_ingestao", TS, False))
RAW_KEYS = {"macro": ["cod_sgs", "data"], "fx": ["dataCotacao", "moeda"], "quotes": ["dataCotacao", "ticker"]}
RAW_SCHEMAS = {"macro": RAW_MACRO, "fx": RAW_FX, "quotes": RAW_QUOTES}

SILVER = _st(("dataCotacao", DT, True), ("indicador", S, True), ("ticker", S, True), ("tickernome", S, True),
             ("fechamento", D, True), ("variacao_diaria", D, True))
GOLD = T.StructType(SILVER.fields + [T.StructField("retorno_em_reais", D), T.StructField("dolar_fechamento", D),
                                     T.StructField("dolar_variacao", D)])

# landed extracts (S9): what the fetchers write, read back with a declared schema
EXTRACTS = {
    "macro": _st(("data", DT, True), ("valor", S, True)),
    "fx": _st(("moeda", S, True), ("cotacaoCompra", D, True), ("cotacaoVenda", D, True),
              ("paridadeCompra", D, True), ("paridadeVenda", D, True), ("dataHoraCotacao", TS, True),
              ("tipoBoletim", S, True)),
    "index_daily": _st(("Date", TS, True), ("Ticker", S, True), ("Open", D, True), ("High", D, True),
                       ("Low", D, True), ("Close", D, True), ("Adj Close", D, True), ("Volume", D, True),
                       ("Repaired?", B, True)),
    "quotes": _st(("symbol", S, True), ("shortName", S, True), ("displayName", S, True),
                  ("regularMarketPrice", D, True), ("regularMarketChange", D, True),
                  ("regularMarketChangePercent", D, True), ("regularMarketVolume", L, True),
                  ("marketCap", L, True), ("fullExchangeName", S, True), ("quoteSourceName", S, True)),
    "info": None,  # filled below: every company-info field as text
    "history": _st(("symbol", S, True), ("Date", TS, True), ("Open", D, True), ("High", D, True),
                   ("Low", D, True), ("Close", D, True), ("Volume", L, True), ("Dividends", D, True),
                   ("Stock Splits", D, True)),
}
