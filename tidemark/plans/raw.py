"""L1 raw layer: landed extracts -> raw tables (S9 -> P* -> D1).

One function per extract kind, each a single plan over every series in the extract:
the closing-bulletin filter, calendar day of the quote time, rounding, code/name
lookups, the strict start filter (Q5) and a deterministic dedupe on the table key (Q7:
the latest quote of the key survives, instead of whichever row a sort left first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import round_price
from ..operators.clean import after, map_values, with_audit
from ..operators.reshape import dedupe
from .landing import TICKER_CODES, TICKER_NAMES

# Fixed value: the closing bulletin type of the FX extract.
CLOSING_BULLETIN = "Fechamento"


def macro_to_raw(extract: DataFrame, code: int, name: str, start=None, run_ts=None) -> DataFrame:
    """Macro series extract ``(data, valor)`` -> ``raw.<name>`` rows keyed
    ``(cod_sgs, data)``."""
    d = extract.select(F.col("data").cast("date").alias("data"), F.col("valor").try_cast("double").alias("valor"))
    d = d.withColumns({"cod_sgs": F.lit(code).cast("bigint"), "nm_indice": F.lit(name)})
    d = with_audit(d, run_ts, date_col=None, ts_col="dt_ingestao")
    if start is not None:
        d = after(d, "data", start)
    d = d.select("cod_sgs", "nm_indice", "data", "valor", "dt_ingestao")
    return dedupe(d, ["cod_sgs", "data"], [("valor", "desc")])


def fx_to_raw(extract: DataFrame, start=None, run_ts=None) -> DataFrame:
    """FX bulletins -> ``raw.cotacao_moedas``: closing bulletins only, one per (day,
    currency) - the latest."""
    d = (extract.filter(F.col("tipoBoletim") == CLOSING_BULLETIN)
                .withColumn("dataCotacao", F.to_date("dataHoraCotacao")))
    d = with_audit(d, run_ts, date_col=None, ts_col="dt_ingestao")
    d = d.select("dataCotacao", "moeda", "cotacaoCompra", "cotacaoVenda", "paridadeCompra", "paridadeVenda",
                 "dataHoraCotacao", "tipoBoletim", "dt_ingestao")
    if start is not None:
        d = after(d, "dataCotacao", start)
    return dedupe(d, ["dataCotacao", "moeda"], [("dataHoraCotacao", "desc")])


def index_to_raw(extract: DataFrame, start=None, run_ts=None) -> DataFrame:
    """Daily index quotes (long, one row per date and ticker) -> ``raw.cotacoes_indices``:
    prices rounded to cents, ticker code and display name, latest quote per day."""
    t = F.col("Ticker")
    d = extract.select(
        F.to_date("Date").alias("dataCotacao"),
        t.alias("ticker"),
        map_values(t, TICKER_CODES).alias("codigoTicker"),
        map_values(t, TICKER_NAMES).alias("tickerNome"),
        round_price("Close").alias("fechamento"),
        round_price("High").alias("maiorAlta"),
        round_price("Open").alias("abertura"),
        F.col("Repaired?").alias("corrigiuDividendos"),
        round_price("Volume").alias("volume"),
        F.col("Date").alias("dataHoraCotacao"))
    d = with_audit(d, run_ts, date_col=None, ts_col="dt_ingestao")
    if start is not None:
        d = after(d, "dataCotacao", start)
    return dedupe(d, ["dataCotacao", "ticker", "codigoTicker"], [("dataHoraCotacao", "desc")])
