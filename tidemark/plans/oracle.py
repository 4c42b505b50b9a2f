"""DuckDB SQL oracles, one per registered query (same column names and types).

Written from the semantics, not from the Spark plans: ``ASOF`` joins for as-of and for the row
before, ``LAG`` windows on ticks, ``GROUP BY`` and joins."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Shared CTEs: the landed extracts, in SQL.
LANDING = """
q_bars AS (
  SELECT CAST(ts AS DATE) AS dataCotacao, event_type, arg_max(value, ts) AS fechamento
  FROM events WHERE event_type IN ('click', 'view', 'signup', 'error') GROUP BY ALL
),
quotes AS (
  SELECT dataCotacao, ticker,
         CASE ticker WHEN 'VT' THEN 'VT' WHEN '^BVSP' THEN 'IBOV' WHEN '^GSPC' THEN 'S&P500'
                     WHEN 'IDIV.SA' THEN 'IDIV' WHEN 'DIVO11.SA' THEN 'IDIV - DIVO11 IT ETF' ELSE ticker END AS codigoTicker,
         CASE ticker WHEN 'VT' THEN 'Vanguard Total World' WHEN '^BVSP' THEN 'Ibovespa'
                     WHEN '^GSPC' THEN 'S&P 500' WHEN 'IDIV.SA' THEN 'IDIV' ELSE ticker END AS tickerNome,
         fechamento
  FROM (SELECT dataCotacao, fechamento,
               CASE event_type WHEN 'click' THEN 'VT' WHEN 'view' THEN '^GSPC'
                               WHEN 'signup' THEN '^BVSP' WHEN 'error' THEN 'IDIV.SA' END AS ticker
        FROM q_bars)
),
fx AS (
  SELECT CAST(ts AS DATE) AS dataCotacao, 'USD' AS moeda, arg_max(value, ts) AS cotacaoVenda
  FROM events WHERE event_type = 'purchase' AND isodow(CAST(ts AS DATE)) < 6 GROUP BY 1
),
macro AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 12 WHEN 'O' THEN 433 WHEN 'P' THEN 189 END AS cod_sgs,
         CASE o_orderstatus WHEN 'F' THEN 'cdi' WHEN 'O' THEN 'ipca' WHEN 'P' THEN 'igpm' END AS nm_indice,
         CAST(o_orderdate AS DATE) AS data, max(o_totalprice) AS valor
  FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_orderstatus, CAST(o_orderdate AS DATE)
)"""

# Variation against the row before in the same series; macro values are variations already.
SILVER_FROM = """
  WITH series AS (
    SELECT 'rate' AS kind, upper(nm_indice) AS label, CAST(cod_sgs AS VARCHAR) AS code, upper(nm_indice) AS title,
           data AS day, valor AS close FROM {macro}
    UNION ALL BY NAME
    SELECT 'quote' AS kind, upper(codigoTicker) AS label, upper(ticker) AS code, upper(tickerNome) AS title,
           dataCotacao AS day, fechamento AS close FROM {quotes}
    UNION ALL BY NAME
    SELECT 'fx' AS kind, upper(moeda) AS label, upper(moeda) AS code, upper(moeda) AS title,
           dataCotacao AS day, cotacaoVenda AS close FROM {fx})
  SELECT now.day AS dataCotacao, now.label AS indicador, now.code AS ticker, now.title AS tickernome, now.close AS fechamento,
         CASE WHEN now.kind = 'rate' THEN now.close
              WHEN past.close IS NULL OR past.close = 0 THEN 0.0
              ELSE now.close / past.close - 1 END AS variacao_diaria
  FROM series now ASOF LEFT JOIN series past ON now.kind = past.kind AND now.code = past.code AND now.day > past.day"""

GOLD_SELECT = """
SELECT row.*,
       CASE WHEN rate.day_change IS NOT NULL AND row.ticker IN ('VT', '^GSPC')
            THEN row.variacao_diaria + rate.day_change + row.variacao_diaria * rate.day_change
            ELSE row.variacao_diaria END AS retorno_em_reais,
       rate.price AS dolar_fechamento, rate.day_change AS dolar_variacao
FROM (SELECT * FROM {base}) row
ASOF LEFT JOIN (SELECT dataCotacao AS day, fechamento AS price, variacao_diaria AS day_change
                FROM {usd} WHERE ticker = 'USD') rate ON row.dataCotacao >= rate.day"""


def _silver_cte():
    return "silver AS (" + SILVER_FROM.format(macro="macro", quotes="quotes", fx="fx") + "\n)"


ORACLE["gold_returns"] = ("WITH " + LANDING + ",\n" + _silver_cte() + "\n"
                          + GOLD_SELECT.format(base="silver", usd="silver"))

ORACLE["silver_variation"] = "WITH " + LANDING + ",\n" + _silver_cte() + "\nSELECT * FROM silver"

ORACLE["silver_backfill"] = ORACLE["silver_variation"]

_CUT = "DATE '2024-01-20'"
STORED = f""",
macro_c AS (SELECT * FROM macro WHERE data <= {_CUT}),
quotes_c AS (SELECT * FROM quotes WHERE dataCotacao <= {_CUT}),
fx_c AS (SELECT * FROM fx WHERE dataCotacao <= {_CUT}),
stored AS ({SILVER_FROM.format(macro="macro_c", quotes="quotes_c", fx="fx_c")}
),
wm AS (SELECT max(dataCotacao) AS m FROM stored)"""


def _newer(table, col):
    return f"(SELECT * FROM {table} WHERE (SELECT m FROM wm) IS NULL OR {col} > (SELECT m FROM wm))"


def _replace(stored, new):
    return (f"SELECT * FROM {stored} s WHERE NOT EXISTS (SELECT 1 FROM {new} n "
            f"WHERE n.dataCotacao = s.dataCotacao AND n.ticker = s.ticker)\nUNION ALL SELECT * FROM {new}")


ORACLE["silver_increment"] = ("WITH " + LANDING + STORED + ",\nnew AS ("
                              + SILVER_FROM.format(macro=_newer("macro", "data"),
                                                   quotes=_newer("quotes", "dataCotacao"),
                                                   fx=_newer("fx", "dataCotacao"))
                              + "\n)\n" + _replace("stored", "new"))

ORACLE["silver_increment_last"] = ("WITH " + LANDING + STORED + ",\n" + _silver_cte()
                                   + ",\nnew AS " + _newer("silver", "dataCotacao") + "\n" + _replace("stored", "new"))

_GOLD_STORED = ",\n" + _silver_cte() + ",\nstored_gold AS (" + GOLD_SELECT.format(base="stored", usd="stored") + """
),
gwm AS (SELECT max(dataCotacao) AS m FROM stored_gold),
base AS (SELECT * FROM silver WHERE (SELECT m FROM gwm) IS NULL OR dataCotacao > (SELECT m FROM gwm))"""

ORACLE["gold_increment"] = ("WITH " + LANDING + STORED + _GOLD_STORED + ",\nnew AS ("
                            + GOLD_SELECT.format(base="base", usd="base") + ")\n" + _replace("stored_gold", "new"))
ORACLE["gold_increment_last"] = ("WITH " + LANDING + STORED + _GOLD_STORED + ",\nnew AS ("
                                 + GOLD_SELECT.format(base="base", usd="silver") + ")\n"
                                 + _replace("stored_gold", "new"))

ORACLE["silver_increment_slow"] = ORACLE["silver_variation"]

ORACLE["series_state"] = "WITH " + LANDING + """
SELECT 'macro' AS kind, CAST(cod_sgs AS VARCHAR) AS series, max(data) AS last_date, arg_max(valor, data) AS last_value FROM macro GROUP BY cod_sgs
UNION ALL SELECT 'quotes', ticker, max(dataCotacao), arg_max(fechamento, dataCotacao) FROM quotes GROUP BY ticker
UNION ALL SELECT 'fx', moeda, max(dataCotacao), arg_max(cotacaoVenda, dataCotacao) FROM fx GROUP BY moeda"""

ORACLE["extract_quarantine"] = """
WITH d AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 89 = 0 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
    CASE WHEN o_orderkey % 83 = 0 THEN 'n/a ' || o_orderkey ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS value FROM orders),
l AS (SELECT *, '{"data":"' || day || '","valor":"' || value || '"}' AS line FROM d)
SELECT 'macro' AS kind, true AS has_file,
  CASE WHEN k % 97 = 0 THEN 'broken line' WHEN k % 89 = 0 THEN 'wrong type' ELSE 'cast of valor' END AS reason,
  CASE WHEN k % 97 = 0 THEN line[:20] ELSE line END AS record
FROM l WHERE k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0"""

# ---------------------------------------------------------------- joins
ORACLE["asof_rate"] = """
WITH fx AS (
  SELECT max(ts) AS bulletin_ts, arg_max(value, ts) AS usd_rate
  FROM events WHERE event_type = 'purchase' AND isodow(CAST(ts AS DATE)) < 6 GROUP BY CAST(ts AS DATE)
)
SELECT e.event_id, e.ts, e.event_type, e.value, u.usd_rate, u.bulletin_ts
FROM events e
LEFT JOIN LATERAL (SELECT usd_rate, bulletin_ts FROM fx WHERE fx.bulletin_ts <= e.ts
                   ORDER BY bulletin_ts DESC LIMIT 1) u ON TRUE"""

ORACLE["asof_by_user"] = """
SELECT l.event_id, l.ts, l.user_id, l.event_type, l.value,
       r.event_id AS last_purchase_id, r.value AS last_purchase_value
FROM events l
ASOF LEFT JOIN (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase') r
  ON l.user_id = r.user_id AND l.ts >= r.ts"""

_BURST = """burst AS (
  SELECT event_id, event_type, value, user_id % 5 AS desk, CASE WHEN value < 1 THEN 0.0 ELSE value END AS close,
         CASE WHEN event_id % 200 = 0 THEN ts ELSE TIMESTAMP '2024-01-15 00:00:00' + to_seconds(event_id * 7919 % 1000) END AS ts
  FROM events)"""

ORACLE["burst_asof_rate"] = f"""
WITH {_BURST},
rates AS (SELECT ts, max(event_id) AS rate_id, arg_max(value, event_id) AS rate FROM burst WHERE event_type = 'purchase' GROUP BY ts)
SELECT b.event_id, b.ts, r.rate_id, r.rate FROM burst b ASOF LEFT JOIN rates r ON b.ts >= r.ts"""

ORACLE["burst_asof_by_desk"] = f"""
WITH {_BURST},
rates AS (SELECT desk, ts, max(event_id) AS rate_id, arg_max(value, event_id) AS rate FROM burst WHERE event_type = 'purchase' GROUP BY ALL)
SELECT b.event_id, b.ts, b.desk, r.rate_id, r.rate FROM burst b ASOF LEFT JOIN rates r ON b.desk = r.desk AND b.ts >= r.ts"""

ORACLE["burst_prev_close"] = f"""
WITH {_BURST}
SELECT event_id, event_type, ts, value, LAG(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_close FROM burst"""

_BURST_LAG = f"""
WITH {_BURST},
p AS (SELECT *, LAG(close) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_close FROM burst)"""

ORACLE["burst_returns"] = f"""{_BURST_LAG}
SELECT event_id, close, previous_close, close - previous_close AS price_change,
       ((close - previous_close) / NULLIF(previous_close, 0)) * 100 AS pct_change FROM p"""

ORACLE["burst_variation"] = f"""{_BURST_LAG}
SELECT event_id, close, COALESCE(close / NULLIF(previous_close, 0) - 1, 0) AS variation FROM p"""

ORACLE["burst_distinct_from"] = f"""
WITH {_BURST}
SELECT event_id, desk, event_type, prev_type
FROM (SELECT *, LAG(event_type) OVER (PARTITION BY desk ORDER BY ts, event_id) AS prev_type FROM burst)
WHERE event_type IS DISTINCT FROM prev_type"""

ORACLE["changed_rows_semi"] = """
WITH s AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders
)
SELECT * FROM s WHERE EXISTS (
  SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey AND (
    t.o_custkey IS DISTINCT FROM s.o_custkey OR t.o_orderstatus IS DISTINCT FROM s.o_orderstatus
    OR t.o_totalprice IS DISTINCT FROM s.o_totalprice OR t.o_orderdate IS DISTINCT FROM s.o_orderdate
    OR t.o_orderpriority IS DISTINCT FROM s.o_orderpriority))"""

# ---------------------------------------------------------------- windows
ORACLE["prev_close"] = """
SELECT event_id, event_type, ts, value,
       LAG(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_close
FROM events"""

_ZEROED = "(SELECT *, CASE WHEN value < 1 THEN 0.0 ELSE value END AS close FROM events)"

ORACLE["period_returns"] = f"""
SELECT event_id, event_type, ts, close, previous_close,
       close - previous_close AS price_change,
       ((close - previous_close) / NULLIF(previous_close, 0)) * 100 AS pct_change
FROM (SELECT *, LAG(close) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_close FROM {_ZEROED})"""

ORACLE["daily_variation"] = f"""
SELECT event_id, event_type, ts, close,
       COALESCE(close / NULLIF(LAG(close) OVER (PARTITION BY event_type ORDER BY ts, event_id), 0) - 1, 0) AS variation
FROM {_ZEROED}"""

_AUDIT = "'2025-09-08' AS dt_ptcao, TIMESTAMP '2025-09-08 03:00:00' AS dthr_igtao"

ORACLE["monthly_returns"] = f"""
WITH bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS data,
         first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS abertura,
         max(l_extendedprice) AS alta, min(l_extendedprice) AS baixa,
         first(l_extendedprice ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS fechamento,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2
), p AS (SELECT *, LAG(fechamento) OVER (PARTITION BY ticker ORDER BY data) AS fechamento_mes_anterior FROM bars)
SELECT ticker, data, abertura, alta, baixa, fechamento, volume, fechamento_mes_anterior,
       fechamento - fechamento_mes_anterior AS valor_retorno,
       ((fechamento - fechamento_mes_anterior) / NULLIF(fechamento_mes_anterior, 0)) * 100 AS porcentagem_retorno,
       {_AUDIT}
FROM p"""

ORACLE["index_daily_returns"] = "WITH " + LANDING + f""",
bars AS (
  SELECT CAST(ts AS DATE) AS data, event_type, arg_max(value, ts) AS fechamento,
         arg_min(value, ts) AS abertura, max(value) AS alta
  FROM events WHERE event_type IN ('click', 'view', 'signup', 'error') GROUP BY ALL
), named AS (
  SELECT b.*, q.ticker AS indice, q.tickerNome AS nome_indice
  FROM bars b JOIN quotes q ON q.dataCotacao = b.data AND q.ticker =
       CASE b.event_type WHEN 'click' THEN 'VT' WHEN 'view' THEN '^GSPC' WHEN 'signup' THEN '^BVSP' WHEN 'error' THEN 'IDIV.SA' END
), p AS (SELECT *, LAG(fechamento) OVER (PARTITION BY indice ORDER BY data) AS previous_close FROM named)
SELECT indice, abertura, alta, fechamento, nome_indice, data, previous_close,
       fechamento - previous_close AS valor_retorno,
       ((fechamento - previous_close) / NULLIF(previous_close, 0)) * 100 AS porcentagem_retorno,
       {_AUDIT}
FROM p"""

ORACLE["dedupe_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
                                        l_partkey ASC NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLE["wide_to_long"] = """
WITH b AS (SELECT CAST(ts AS DATE) AS d, event_type AS ticker, arg_max(value, ts) AS close, max(value) AS high
           FROM events GROUP BY ALL),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
t AS (SELECT * FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) v(ticker))
SELECT days.d, t.ticker, b.close, b.high
FROM days CROSS JOIN t LEFT JOIN b ON b.d = days.d AND b.ticker = t.ticker"""

# ---------------------------------------------------------------- cleansing
_QUOTES = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ticker, o_orderpriority AS nome_curto, o_orderstatus AS nome_exibicao,
       o_totalprice AS preco_mercado_regular, o_custkey AS volume_mercado_regular,
       o_totalprice AS capitalizacao_mercado, o_orderpriority AS nome_exchange_completa,
       o_orderstatus AS nome_fonte_cotacao, {_AUDIT}
FROM orders WHERE o_orderkey IS NOT NULL"""
ORACLE["standardise_quotes"] = _QUOTES
ORACLE["top_by_cap"] = _QUOTES + "\nORDER BY capitalizacao_mercado DESC, ticker ASC LIMIT 200"
ORACLE["audit_columns"] = f"SELECT event_id, {_AUDIT} FROM events"
ORACLE["cast_keys"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders"""
ORACLE["drop_null_keys"] = "SELECT event_id, event_type AS ticker, value FROM events WHERE value >= 5"
ORACLE["filter_ge"] = "SELECT * FROM orders WHERE o_totalprice >= 150000.0"
ORACLE["filter_eq"] = "SELECT * FROM events WHERE event_type = 'purchase'"
ORACLE["after_date"] = "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1998-08-02'"
ORACLE["map_codes"] = """
SELECT event_id, ticker,
       CASE ticker WHEN 'VT' THEN 'VT' WHEN '^BVSP' THEN 'IBOV' WHEN '^GSPC' THEN 'S&P500'
                   WHEN 'IDIV.SA' THEN 'IDIV' WHEN 'DIVO11.SA' THEN 'IDIV - DIVO11 IT ETF' ELSE ticker END AS codigoTicker,
       CASE ticker WHEN 'VT' THEN 'Vanguard Total World' WHEN '^BVSP' THEN 'Ibovespa'
                   WHEN '^GSPC' THEN 'S&P 500' WHEN 'IDIV.SA' THEN 'IDIV' ELSE ticker END AS tickerNome
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'VT' WHEN 'view' THEN '^GSPC' WHEN 'signup' THEN '^BVSP'
                                      WHEN 'error' THEN 'IDIV.SA' ELSE event_type END AS ticker FROM events)"""
ORACLE["cleanse_sentinel"] = """
SELECT event_id, CASE WHEN value < 2 THEN 0.0 WHEN value > 300 THEN 0.0 WHEN value > 250 THEN NULL
                      ELSE value END AS price
FROM events"""
ORACLE["quarantine_bad"] = """
SELECT event_id, props AS raw_id, 'raw_id' AS bad_columns
FROM events WHERE value < 5 AND props IS NOT NULL AND TRY_CAST(props AS BIGINT) IS NULL"""
ORACLE["quarantine_good"] = """
SELECT event_id, CASE WHEN value < 5 THEN TRY_CAST(props AS BIGINT) ELSE event_id END AS raw_id
FROM events WHERE NOT (value < 5 AND props IS NOT NULL AND TRY_CAST(props AS BIGINT) IS NULL)"""

_CUST = "customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE c.c_name IS NOT NULL"
_PRICE = "CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END"


def _sometimes(value, default):
    """A number that one key in five has as each sentinel (both take the default) and one in five lacks."""
    return f"CASE c_custkey % 5 WHEN 0 THEN {default} WHEN 1 THEN {default} WHEN 2 THEN NULL ELSE {value} END"


ORACLE["company_split_general"] = f"""
SELECT c_name AS ticker, c_mktsegment AS setor, c_mktsegment AS industria, c_nationkey AS funcionarios,
       CAST(NULL AS VARCHAR) AS cidade, upper(n_name) AS estado, n_name AS pais,
       CAST(NULL AS VARCHAR) AS website, CAST(NULL AS VARCHAR) AS resumo_negocios, 'X-' || c_mktsegment AS exchange,
       {_AUDIT}
FROM {_CUST}"""
ORACLE["company_split_financial"] = f"""
SELECT c_name AS ticker, c_custkey AS capitalizacao_mercado, c_custkey * 3 AS valor_empresa,
       {_sometimes("c_custkey * 1000", "0")} AS receita, {_sometimes("c_custkey * 100", "0")} AS lucros_brutos,
       c_custkey - 500 AS lucro_liquido, {_sometimes("c_custkey - 700", "0")} AS ebitda,
       CASE WHEN c_custkey % 5 = 3 THEN NULL ELSE {_sometimes("c_custkey * 7", "0")} END AS divida_total,
       {_sometimes("c_custkey", "0")} AS caixa_total,
       {_sometimes("c_acctbal / 100", "0.0::DOUBLE")} AS dividend_yield, {_AUDIT}
FROM {_CUST}"""
ORACLE["company_split_market"] = f"""
SELECT c_name AS ticker, {_PRICE} AS preco_atual, {_PRICE} AS fechamento_anterior,
       {_sometimes("c_acctbal + 1", "0.0::DOUBLE")} AS abertura, {_sometimes("c_acctbal - 1", "0.0::DOUBLE")} AS minimo_dia,
       {_sometimes("c_acctbal + 2", "0.0::DOUBLE")} AS maximo_dia,
       c_acctbal - 50 AS minimo_52_semanas, c_acctbal + 50 AS maximo_52_semanas,
       c_custkey AS volume, CAST(c_nationkey AS BIGINT) AS volume_medio,
       {_sometimes("c_acctbal / 1000", "0.0::DOUBLE")} AS beta, {_AUDIT}
FROM {_CUST}"""
ORACLE["company_split_dividend"] = f"""
SELECT c_name AS ticker, {_sometimes("c_acctbal / 10", "0.0::DOUBLE")} AS taxa_dividendo,
       strftime(make_timestamp((c_custkey * 86400 + 1700000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS data_exdividendo,
       {_sometimes("c_acctbal / 3", "0.0::DOUBLE")} AS indice_distribuicao, {_AUDIT}
FROM {_CUST}"""
ORACLE["company_split_valuation"] = f"""
SELECT c_name AS ticker, {_sometimes("c_acctbal / 5", "0.0::DOUBLE")} AS pl_futuro,
       {_sometimes("c_acctbal / 6", "0.0::DOUBLE")} AS pl_retroativo, c_acctbal / 7 AS preco_booking,
       {_sometimes("c_acctbal / 9", "0.0::DOUBLE")} AS indice_preco_lucro_cresc, {_AUDIT}
FROM {_CUST}"""
_SPLITS = {"cadastro": "general", "financas": "financial", "mercado": "market", "dividendos": "dividend", "valuation": "valuation"}
ORACLE["company_rows"] = " UNION ALL BY NAME ".join(
    f"SELECT '{table}' AS tabela, * FROM ({ORACLE[f'company_split_{split}']})" for table, split in _SPLITS.items())
# all companies are stored on the first run; on the second those of a key divisible by 3 arrive with a balance one higher
ORACLE["facts_upsert_swap"] = f"""
SELECT c_name AS ticker, CAST(c_custkey AS BIGINT) AS volume, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS preco,
       '2025-09-01' AS dt_ptcao,
       CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2025-09-08 03:00:00' ELSE TIMESTAMP '2025-09-01 03:00:00' END AS dthr_igtao
FROM customer WHERE c_name IS NOT NULL"""

# expected days are generated one by one; each missing day finds the stored days around it
ORACLE["fetch_plan"] = """
WITH raw AS (
  SELECT DISTINCT 'macro' AS kind, CASE o_orderstatus WHEN 'F' THEN 'cdi' WHEN 'O' THEN 'ipca' WHEN 'P' THEN 'igpm' END AS series,
         CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
  UNION ALL
  SELECT DISTINCT 'index', CASE event_type WHEN 'click' THEN 'VT' WHEN 'view' THEN '^GSPC' WHEN 'signup' THEN '^BVSP' ELSE 'IDIV.SA' END,
         CAST(ts AS DATE) FROM events WHERE event_type IN ('click', 'view', 'signup', 'error')
  UNION ALL
  SELECT DISTINCT 'fx', 'USD', CAST(ts AS DATE) FROM events WHERE event_type = 'purchase' AND isodow(CAST(ts AS DATE)) < 6),
stored AS (SELECT * FROM raw WHERE day IS NOT NULL AND NOT day(day) BETWEEN 10 AND 12),
span AS (SELECT kind, series, min(day) AS a, max(day) AS b FROM stored GROUP BY kind, series),
due AS (SELECT kind, series, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
missing AS (SELECT * FROM due WHERE kind = 'macro' OR isodow(day) < 6 EXCEPT SELECT kind, series, day FROM stored),
held AS (SELECT m.kind, m.series, m.day, p.day AS before, n.day AS later FROM missing m
  ASOF JOIN stored p ON p.kind = m.kind AND p.series = m.series AND m.day > p.day
  ASOF JOIN stored n ON n.kind = m.kind AND n.series = m.series AND m.day < n.day),
wanted AS (SELECT DISTINCT kind, series FROM raw UNION ALL VALUES ('index', 'DIVO11.SA'), ('fx', 'EUR'), ('fx', 'CHF')),
ahead AS (SELECT w.kind, w.series, CASE WHEN s.b IS NULL THEN 'first' ELSE 'next' END AS reason,
    coalesce(s.b, DATE '2025-09-08' - 3640) AS start,
    CASE WHEN w.kind = 'fx' THEN DATE '2025-09-05' ELSE DATE '2025-09-07' END AS "end"
  FROM wanted w LEFT JOIN span s ON s.kind = w.kind AND s.series = w.series)
SELECT kind, series, 'gap' AS reason, before AS start, CAST(later - 1 AS DATE) AS "end", count(*) AS days
FROM held GROUP BY kind, series, before, later
UNION ALL
SELECT kind, series, reason, start, "end",
       len(list_filter(generate_series(start + INTERVAL 1 DAY, CAST("end" AS TIMESTAMP), INTERVAL 1 DAY),
                       lambda x: kind = 'macro' OR isodow(x) < 6)) AS days
FROM ahead WHERE start < "end" """

# ---------------------------------------------------------------- scalar functions
ORACLE["epoch_to_text"] = """
SELECT event_id, epoch_s, strftime(make_timestamp(epoch_s * 1000000), '%Y-%m-%d %H:%M:%S') AS ts_text
FROM (SELECT event_id, date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS epoch_s FROM events)"""
ORACLE["round_prices"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, round(l_extendedprice / 3, 2) AS instalment FROM lineitem"""
ORACLE["upper_labels"] = "SELECT event_id, upper(event_type) AS label FROM events"
ORACLE["distinct_from"] = """
SELECT event_id, user_id, event_type, prev_type FROM (
  SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type FROM events)
WHERE event_type IS DISTINCT FROM prev_type"""

# ---------------------------------------------------------------- aggregates / sets
ORACLE["row_count"] = "SELECT count(*) AS n FROM lineitem"
ORACLE["high_watermark_day"] = "SELECT max(CAST(o_orderdate AS DATE)) AS high_watermark FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"
ORACLE["high_watermark"] = "SELECT max(o_orderdate) AS high_watermark FROM orders"
ORACLE["union_series"] = """
SELECT 'orders' AS source, o_orderstatus AS series, CAST(o_orderdate AS DATE) AS data, o_totalprice AS price FROM orders
UNION ALL SELECT 'lineitem', l_returnflag, CAST(l_shipdate AS DATE), l_extendedprice FROM lineitem
UNION ALL SELECT 'events', event_type, CAST(ts AS DATE), value FROM events"""

# ---------------------------------------------------------------- mutation
ORACLE["update_where"] = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders"""
ORACLE["delete_where"] = "SELECT * FROM orders WHERE NOT COALESCE(o_orderstatus = 'P', FALSE)"

_ARRIVING = """SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
         o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '{since} 00:00:00'"""
ORACLE["merge_upsert"] = f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'),
s AS ({_ARRIVING.format(since="1997-01-01")})
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""

ORACLE["upsert_changed"] = """
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority,
         '2025-09-01' AS dt_ptcao, TIMESTAMP '2025-09-01 03:00:00' AS dthr_igtao
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
), s AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority,
         '2025-09-08' AS dt_ptcao, TIMESTAMP '2025-09-08 03:00:00' AS dthr_igtao
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
), j AS (
  SELECT t.o_orderkey AS tk, s.o_orderkey AS sk,
         t.o_custkey AS t_custkey, s.o_custkey AS s_custkey, t.o_orderstatus AS t_status, s.o_orderstatus AS s_status,
         t.o_totalprice AS t_price, s.o_totalprice AS s_price, t.o_orderdate AS t_date, s.o_orderdate AS s_date,
         t.o_orderpriority AS t_prio, s.o_orderpriority AS s_prio, t.dt_ptcao AS t_dt, s.dt_ptcao AS s_dt,
         t.dthr_igtao AS t_th, s.dthr_igtao AS s_th,
         (t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND (
            t.o_custkey IS DISTINCT FROM s.o_custkey OR t.o_orderstatus IS DISTINCT FROM s.o_orderstatus
            OR t.o_totalprice IS DISTINCT FROM s.o_totalprice OR t.o_orderdate IS DISTINCT FROM s.o_orderdate
            OR t.o_orderpriority IS DISTINCT FROM s.o_orderpriority)) AS chg
  FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
)
SELECT COALESCE(tk, sk) AS o_orderkey,
       CASE WHEN tk IS NULL OR chg THEN s_custkey ELSE t_custkey END AS o_custkey,
       CASE WHEN tk IS NULL OR chg THEN s_status ELSE t_status END AS o_orderstatus,
       CASE WHEN tk IS NULL OR chg THEN s_price ELSE t_price END AS o_totalprice,
       CASE WHEN tk IS NULL OR chg THEN s_date ELSE t_date END AS o_orderdate,
       CASE WHEN tk IS NULL OR chg THEN s_prio ELSE t_prio END AS o_orderpriority,
       CASE WHEN tk IS NULL THEN s_dt ELSE t_dt END AS dt_ptcao,
       CASE WHEN tk IS NULL OR chg THEN s_th ELSE t_th END AS dthr_igtao
FROM j"""

ORACLE["replace_by_key"] = f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
s AS ({_ARRIVING.format(since="1998-01-01")})
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s"""

# ---------------------------------------------------------------- versions
_LOG = """log AS (
  SELECT user_id, event_type, value, ts, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS _version,
         CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS _op, event_id AS _seq, ts AS _commit_ts
  FROM events)"""
ORACLE["version_history"] = f"""
WITH {_LOG}
SELECT _version AS version, max(_commit_ts) AS timestamp,
       CASE WHEN bool_or(_op = 'overwrite') THEN 'WRITE' WHEN bool_and(_op = 'delete') THEN 'DELETE'
            WHEN bool_and(_op = 'upsert') THEN 'UPDATE' ELSE 'MERGE' END AS operation,
       count(*) AS num_rows, count(*) FILTER (WHERE _op = 'delete') AS num_deleted,
       count(*) FILTER (WHERE _op <> 'delete') AS num_written
FROM log GROUP BY _version"""


def _as_of(cut_filter: str) -> str:
    return f"""
WITH {_LOG},
cut AS (SELECT * FROM log {cut_filter}),
b AS (SELECT max(_version) AS v FROM cut WHERE _op = 'overwrite'),
c AS (SELECT * FROM cut WHERE (SELECT v FROM b) IS NULL OR _version >= (SELECT v FROM b)),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _version DESC, _seq DESC) AS rn FROM c)
SELECT user_id, event_type, value, ts FROM r WHERE rn = 1 AND _op <> 'delete'"""


# The states before and after every version, set against each other.
ORACLE["version_metrics"] = f"""
WITH {_LOG},
o AS (SELECT user_id, _version, _seq, CASE WHEN _version % 7 = 0 AND _op <> 'delete' THEN 'overwrite' ELSE _op END AS _op FROM log),
v AS (SELECT DISTINCT _version AS v FROM o),
b AS (SELECT v, (SELECT max(_version) FROM o WHERE _op = 'overwrite' AND _version <= v) AS since FROM v),
seen AS (
  SELECT b.v, o.user_id, arg_max(_op, _version * 1000000000 + _seq) AS op, max(_version) AS last
  FROM b JOIN o ON _version <= b.v AND (since IS NULL OR _version >= since) GROUP BY b.v, o.user_id),
live AS (SELECT * FROM seen WHERE op <> 'delete'),
steps AS (SELECT v, lag(v) OVER (ORDER BY v) AS prev FROM v)
SELECT s.v AS version, '{{"day": ' || s.v || '}}' AS parameters,
  (SELECT count(*) FROM live a WHERE a.v = s.v AND NOT EXISTS (SELECT 1 FROM live p WHERE p.v = s.prev AND p.user_id = a.user_id)) AS inserted,
  (SELECT count(*) FROM live a WHERE a.v = s.v AND a.last = s.v AND EXISTS (SELECT 1 FROM live p WHERE p.v = s.prev AND p.user_id = a.user_id)) AS updated,
  (SELECT count(*) FROM live p WHERE p.v = s.prev AND NOT EXISTS (SELECT 1 FROM live a WHERE a.v = s.v AND p.user_id = a.user_id)) AS deleted,
  (SELECT count(*) FROM live a WHERE a.v = s.v) AS num_live
FROM steps s"""

ORACLE["as_of_version"] = _as_of("WHERE _version <= date_diff('day', DATE '1970-01-01', DATE '2024-01-15')")
ORACLE["versioned_current"] = _as_of("")

ORACLE["commit_versions"] = f"""
SELECT user_id, event_type, value, ts, 1 AS step FROM ({ORACLE["versioned_current"]}) WHERE event_type IS DISTINCT FROM 'click'
UNION ALL SELECT user_id, event_type, value, ts, 3 FROM ({ORACLE["as_of_version"]})"""

# ---------------------------------------------------------------- incremental
ORACLE["incremental_filter"] = """
SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
                                          WHERE o_orderdate < TIMESTAMP '1999-06-01 00:00:00')"""

# ---------------------------------------------------------------- data tests
_GOLD = "WITH " + LANDING + ",\n" + _silver_cte() + ",\ngold AS (" + GOLD_SELECT.format(base="silver", usd="silver") + ")\n"
ORACLE["check_not_null"] = _GOLD + """SELECT * FROM gold
WHERE dataCotacao IS NULL OR ticker IS NULL OR fechamento IS NULL OR dolar_fechamento IS NULL"""
ORACLE["check_rows"] = _GOLD + "SELECT * FROM gold WHERE dataCotacao IS NULL OR ticker IS NULL"
ORACLE["check_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
ORACLE["pk_conflicts"] = """
WITH e AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
n AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey IS NOT NULL)
SELECT o_orderkey, count(*) AS n FROM (
  SELECT o_orderkey FROM e WHERE o_orderkey IN (SELECT o_orderkey FROM n)
  UNION ALL SELECT o_orderkey FROM n) GROUP BY o_orderkey HAVING count(*) > 1"""

# ---------------------------------------------------------------- IO and streams
ORACLE["roundtrip_parquet"] = "SELECT * FROM orders"
ORACLE["roundtrip_csv_typed"] = "SELECT * FROM part"
ORACLE["stream_table_copy"] = "SELECT * FROM events"
ORACLE["stream_restart_no_dup"] = "SELECT * FROM events"

# ---------------------------------------------------------------- raw layer
ORACLE["macro_extract_to_raw"] = """
SELECT CAST(12 AS BIGINT) AS cod_sgs, 'cdi' AS nm_indice, CAST(o_orderdate AS DATE) AS data,
       max(o_totalprice) AS valor, TIMESTAMP '2025-09-08 03:00:00' AS dt_ingestao
FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1995-06-30' GROUP BY CAST(o_orderdate AS DATE)"""

ORACLE["fx_extract_to_raw"] = """
SELECT CAST(ts AS DATE) AS dataCotacao, 'USD' AS moeda, arg_max(value, ts) AS cotacaoCompra,
       arg_max(value, ts) AS cotacaoVenda, CAST(1.0 AS DOUBLE) AS paridadeCompra, CAST(1.0 AS DOUBLE) AS paridadeVenda,
       max(ts) AS dataHoraCotacao, 'Fechamento' AS tipoBoletim, TIMESTAMP '2025-09-08 03:00:00' AS dt_ingestao
FROM events WHERE event_type = 'purchase' AND isodow(CAST(ts AS DATE)) < 6
  AND CAST(ts AS DATE) > DATE '2024-01-02'
GROUP BY CAST(ts AS DATE)"""

ORACLE["index_extract_to_raw"] = """
WITH t AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'VT' WHEN 'view' THEN '^GSPC' WHEN 'signup' THEN '^BVSP'
                            WHEN 'error' THEN 'IDIV.SA' ELSE event_type END AS tk
  FROM events WHERE event_type <> 'purchase'
), last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), tk ORDER BY ts DESC) AS rn FROM t)
  WHERE rn = 1
)
SELECT CAST(ts AS DATE) AS dataCotacao, tk AS ticker,
       CASE tk WHEN 'VT' THEN 'VT' WHEN '^BVSP' THEN 'IBOV' WHEN '^GSPC' THEN 'S&P500'
               WHEN 'IDIV.SA' THEN 'IDIV' WHEN 'DIVO11.SA' THEN 'IDIV - DIVO11 IT ETF' ELSE tk END AS codigoTicker,
       CASE tk WHEN 'VT' THEN 'Vanguard Total World' WHEN '^BVSP' THEN 'Ibovespa'
               WHEN '^GSPC' THEN 'S&P 500' WHEN 'IDIV.SA' THEN 'IDIV' ELSE tk END AS tickerNome,
       round(value, 2) AS fechamento, round(value, 2) AS maiorAlta, round(value / 3, 2) AS abertura,
       FALSE AS corrigiuDividendos, round(CAST(user_id AS DOUBLE), 2) AS volume, ts AS dataHoraCotacao,
       TIMESTAMP '2025-09-08 03:00:00' AS dt_ingestao
FROM last"""

ORACLE["silver_increment_series"] = ("WITH " + LANDING + STORED + ",\n" + _silver_cte() + """,
wmt AS (SELECT ticker, max(dataCotacao) AS m FROM stored GROUP BY ticker),
new AS (SELECT s.* FROM silver s LEFT JOIN wmt w ON w.ticker = s.ticker
        WHERE w.m IS NULL OR s.dataCotacao > w.m)
""" + _replace("stored", "new"))

ORACLE["check_rows_failing"] = f"""
SELECT * FROM ({ORACLE["gold_returns"]}) WHERE abs(retorno_em_reais) > 0.5 AND ticker NOT IN ('12', '433', '189')"""

ORACLE["upsert_null_keys"] = """
WITH o AS (SELECT o_orderkey % 1000 AS k, nullif(o_orderpriority, '5-LOW') AS p, o_orderkey, o_totalprice,
                  o_orderdate >= TIMESTAMP '1999-01-01' AS arrives FROM orders),
one AS (SELECT * FROM o WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k, p, arrives ORDER BY o_orderkey, o_totalprice DESC) = 1)
SELECT k, p, o_orderkey, o_totalprice FROM o WHERE p IS NULL
UNION ALL SELECT k, p, o_orderkey, o_totalprice FROM one QUALIFY row_number() OVER (PARTITION BY k, p ORDER BY arrives DESC) = 1"""
