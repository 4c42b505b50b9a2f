"""Query registry: one builder per operator from the survey, each ``(spark, sf_dir) ->
DataFrame`` over the driver's tables, plus the matching DuckDB SQL in ``oracle.py``.

Builders call the real operators, so each registered query exercises the library code
a user would run. Splits of one table into "stored" and "arriving" parts (for merges,
upserts and incremental loads) are by date, and every row of the input is read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fetch_window import fetch_plan as plan_fetches
from ..functions.scalars import distinct_from, epoch_to_text, ntz_micros, round_price
from ..operators import clean as C
from ..operators import incremental as I
from ..operators import mutate as MU
from ..operators import quality as Q
from ..operators import versions as V
from ..operators._time import Rows
from ..operators.asof import asof_left
from ..operators.reshape import dedupe, wide_to_long
from ..operators.returns import with_previous, with_returns, with_variation
from ..operators.setops import top, union_all
from ..session import materialize
from . import equities as EQ
from . import landing as L
from . import macro as M

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN_TS = L.RUN_TS
EARLIER_RUN_TS = "2025-09-01 03:00:00"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SILVER_CUT = "2024-01-20"   # the stored silver/gold tables hold rows up to this day
VERSION_CUT = date(2024, 1, 15)
# Tick-level windows and as-of joins cut a key that has more than 2M rows into buckets of
# about as many, whatever the volume and however the rows crowd (see operators/_time.py).
TICK_BUCKETS = "auto"


def query(fn=None, *, name: str | None = None):
    """Register a builder under its function name, or under ``name`` when that would
    clash with an imported operator."""
    def reg(f):
        QUERIES[name or f.__name__] = f
        return f
    return reg(fn) if fn is not None else reg


def _t(spark, sf, name):
    return L.table(spark, sf, name)


def _raw(spark, sf):
    """The raw layer: landed extracts (scanned once by whichever job reads them)."""
    ev = _t(spark, sf, "events")
    return L.landed_macro(_t(spark, sf, "orders")), L.landed_quotes(ev), L.landed_fx(ev)


def _silver(spark, sf, raw=None):
    """The silver layer, stored once: gold reads it several times (rows, USD, dates)."""
    return materialize(M.silver_variation(*(raw or _raw(spark, sf))))


def _stored(df):
    """What an earlier run stored: the table up to the cut day. Variation and as-of only
    look back in time, so this equals building it from the raw rows up to that day
    (the L1 job test checks incremental == full)."""
    return df.filter(F.col("dataCotacao") <= F.lit(SILVER_CUT).cast("date"))


def _zeroed_ticks(spark, sf):
    """Ticks whose price is below 1 are set to 0 so the zero-division path is exercised."""
    ev = _t(spark, sf, "events")
    return ev.withColumn("close", F.when(F.col("value") < 1, F.lit(0.0)).otherwise(F.col("value")))


def _changelog(spark, sf):
    """Events as a change log: user = key, day = version, an ``error`` event deletes."""
    ev = _t(spark, sf, "events")
    return ev.select("user_id", "event_type", "value", "ts",
                     F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint").alias(V.VERSION),
                     F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert")).alias(V.OP),
                     F.col("event_id").alias(V.SEQ),
                     F.col("ts").alias(V.COMMIT_TS))


def _before(df, col, day):
    return df.filter(F.col(col) < F.lit(day + " 00:00:00").cast("timestamp_ntz"))


def _from(df, col, day):
    return df.filter(F.col(col) >= F.lit(day + " 00:00:00").cast("timestamp_ntz"))


# ------------------------------------------------------------------ L1 macro job

@query
def gold_returns(spark: SparkSession, sf: str) -> DataFrame:
    """L1 flagship: raw extracts -> silver -> gold with the as-of USD join."""
    return M.gold_returns(_silver(spark, sf))


@query
def silver_variation(spark, sf):
    """5-way union of macro, index and FX series with their variation."""
    return _silver(spark, sf)


def _increment(spark, sf, cut=SILVER_CUT, macro_cut=SILVER_CUT, **how):
    """The stored raw layer; silver and state of its rows up to the cut days; the increment by the rest."""
    raw = [materialize(r, "raw") for r in _raw(spark, sf)]
    held = [r.filter(F.col(c) <= F.lit(d).cast("date")) for r, c, d in zip(raw, ("data", "dataCotacao", "dataCotacao"), (macro_cut, cut, cut))]
    return M.silver_increment(M.silver_variation(*held), *raw, state=M.raw_state(*held), **how)


@query
def silver_increment(spark, sf):
    """I3 with ``lookback="none"`` (the reference's incremental LAG)."""
    return _increment(spark, sf, lookback="none")


@query
def silver_increment_last(spark, sf):
    """I3 with ``lookback="last"`` (LAG seeded with the state's last value)."""
    return _increment(spark, sf, lookback="last")


@query
def silver_increment_series(spark, sf):
    """I3 with one watermark per series (Q6 option) and LAG seeded from the state."""
    return _increment(spark, sf, lookback="last", scope="series")


@query
def silver_increment_slow(spark, sf):
    """I3 where the macro series are held up to 1998 only: a watermark per series loads their later rows, though far older
    than the newest quote."""
    return _increment(spark, sf, macro_cut="1998-01-01", lookback="last", scope="series")


@query
def series_state(spark, sf):
    """The state table of the raw layer, merged from the state up to the cut day and that of the rows after it."""
    raw = [materialize(r, "raw") for r in _raw(spark, sf)]
    cut = F.lit(SILVER_CUT).cast("date")
    old = M.raw_state(*[r.filter(F.col(c) <= cut) for r, c in zip(raw, ("data", "dataCotacao", "dataCotacao"))])
    new = M.raw_state(*[r.filter(F.col(c) > cut) for r, c in zip(raw, ("data", "dataCotacao", "dataCotacao"))])
    return I.merge_state(old, new)


@query
def extract_quarantine(spark, sf):
    """Orders as a macro extract of JSON lines, some cut short, some with a day that is none, some with a value that is
    no number: the rows that the quarantine gets."""
    from ..session import scratch_path
    from ..sources.files import read_extract_checked
    key = F.col("o_orderkey")
    day = F.when(key % 89 == 0, F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    value = F.when(key % 83 == 0, F.concat(F.lit("n/a "), key)).otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"))
    line = F.concat(F.lit('{"data":"'), day, F.lit('","valor":"'), value, F.lit('"}'))
    path = scratch_path(spark, "extract")
    (_t(spark, sf, "orders").select(F.when(key % 97 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
     .write.text(path))
    good, broken = read_extract_checked(spark, "macro", path)
    _, failed = C.convert_or_quarantine(good, {"valor": "double"})
    failed = C.rejected(failed, "macro", F.concat(F.lit("cast of "), "bad_columns"), F.col("source_file"), ["data", "valor"])
    return broken.unionByName(failed).select("kind", "reason", "record", F.col("source_file").isNotNull().alias("has_file"))


@query
def silver_backfill(spark, sf):
    """A gap of five days in every index and FX series of the stored silver, and of two years in the macro
    ones, filled by a backfill."""
    raw = _raw(spark, sf)

    def gap(df, col, first, last):
        return df.filter(~F.col(col).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    held = (gap(raw[0], "data", "1995-03-01", "1997-02-28"), *[gap(r, "dataCotacao", "2024-01-08", "2024-01-12") for r in raw[1:]])
    return M.silver_backfill(materialize(M.silver_variation(*held)), *raw)


@query
def gold_increment(spark, sf):
    """I4 with the USD series cut to the new rows (the reference)."""
    silver = _silver(spark, sf)
    return M.gold_increment(_stored(M.gold_returns(silver)), silver, lookback="none")


@query
def gold_increment_last(spark, sf):
    """I4 with the as-of over the whole USD history."""
    silver = _silver(spark, sf)
    return M.gold_increment(_stored(M.gold_returns(silver)), silver, lookback="last")


# ------------------------------------------------------------------ joins

@query
def asof_rate(spark, sf):
    """Every tick with the last USD closing bulletin published at or before it."""
    ev = _t(spark, sf, "events")
    fx = L.landed_fx(ev).select(F.col("dataHoraCotacao").alias("bulletin_ts"),
                                F.col("cotacaoVenda").alias("usd_rate"))
    left = ev.select("event_id", "ts", "event_type", "value")
    return asof_left(left, fx, on="ts", right_on="bulletin_ts", payload=["usd_rate", "bulletin_ts"],
                     bucket_width=TICK_BUCKETS)


@query
def asof_by_user(spark, sf):
    """Every event with the same user's latest purchase at or before it."""
    ev = _t(spark, sf, "events")
    right = (ev.filter(F.col("event_type") == "purchase")
               .select(F.col("user_id").alias("buyer"), F.col("ts").alias("purchase_ts"),
                       F.col("event_id").alias("last_purchase_id"), F.col("value").alias("last_purchase_value")))
    left = ev.select("event_id", "ts", "user_id", "event_type", "value")
    return asof_left(left, right, on="ts", right_on="purchase_ts", by=["user_id"], right_by=["buyer"],
                     payload=["last_purchase_id", "last_purchase_value"], right_order=["last_purchase_id"],
                     bucket_width=TICK_BUCKETS)


# The same operators on crowded ticks: 99.5% of the rows within 1000 seconds, many at one instant, and buckets that hold
# a share of the rows such that every key has more than 20 of them at any scale.
BURST_BUCKETS = 24


def _burst(spark, sf):
    crowded = F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00' + make_dt_interval(0, 0, 0, CAST(event_id * 7919 % 1000 AS INT))")
    ev = _t(spark, sf, "events")
    return ev.withColumns({"ts": F.when(F.col("event_id") % 200 == 0, F.col("ts")).otherwise(crowded), "desk": F.col("user_id") % 5,
                           "close": F.when(F.col("value") < 1, F.lit(0.0)).otherwise(F.col("value"))})


def _share(df, keys):
    return Rows(max(1, df.count() // (BURST_BUCKETS * keys)))


@query
def burst_asof_rate(spark, sf):
    """J1 on crowded ticks: the latest purchase of all, the largest id of an instant."""
    ev = _burst(spark, sf)
    right = ev.filter(F.col("event_type") == "purchase").select(
        F.col("ts").alias("rate_ts"), F.col("event_id").alias("rate_id"), F.col("value").alias("rate"))
    return asof_left(ev.select("event_id", "ts"), right, on="ts", right_on="rate_ts", payload=["rate_id", "rate"],
                     right_order=["rate_id"], bucket_width=_share(ev, 1))


@query
def burst_asof_by_desk(spark, sf):
    """J2 on crowded ticks: the same desk's latest purchase."""
    ev = _burst(spark, sf)
    right = ev.filter(F.col("event_type") == "purchase").select(
        F.col("desk").alias("at_desk"), F.col("ts").alias("rate_ts"), F.col("event_id").alias("rate_id"), F.col("value").alias("rate"))
    return asof_left(ev.select("event_id", "ts", "desk"), right, on="ts", right_on="rate_ts", by=["desk"], right_by=["at_desk"],
                     payload=["rate_id", "rate"], right_order=["rate_id"], bucket_width=_share(ev, 5))


@query
def burst_prev_close(spark, sf):
    """W1 on crowded ticks."""
    ev = _burst(spark, sf)
    d = with_previous(ev, "event_type", "ts", "value", "previous_close", order=["event_id"], bucket_width=_share(ev, 5))
    return d.select("event_id", "event_type", "ts", "value", "previous_close")


@query
def burst_returns(spark, sf):
    """W2/W3 on crowded ticks, zero prices included."""
    ev = _burst(spark, sf)
    d = with_returns(ev, "event_type", "ts", "close", "previous_close", "price_change", "pct_change", order=["event_id"],
                     bucket_width=_share(ev, 5))
    return d.select("event_id", "close", "previous_close", "price_change", "pct_change")


@query
def burst_variation(spark, sf):
    """W4 on crowded ticks, zero prices included."""
    ev = _burst(spark, sf)
    d = with_variation(ev, "event_type", "ts", "close", "variation", order=["event_id"], bucket_width=_share(ev, 5))
    return d.select("event_id", "close", "variation")


@query
def burst_distinct_from(spark, sf):
    """F7 over W1 on crowded ticks: events whose type differs from their desk's event before."""
    ev = _burst(spark, sf)
    d = with_previous(ev, "desk", "ts", "event_type", "prev_type", order=["event_id"], bucket_width=_share(ev, 5))
    return d.filter(distinct_from("event_type", "prev_type")).select("event_id", "desk", "event_type", "prev_type")


@query
def changed_rows_semi(spark, sf):
    """Arriving orders whose key exists and some column changed."""
    o = _t(spark, sf, "orders")
    src = o.withColumn("o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("F"))
                       .otherwise(F.col("o_orderstatus")))
    return MU.changed_rows(o, src, ["o_orderkey"])


# ------------------------------------------------------------------ windows / returns

@query
def prev_close(spark, sf):
    """Previous tick price per event type (bucketed lag, skew-safe)."""
    ev = _t(spark, sf, "events")
    d = with_previous(ev, "event_type", "ts", "value", "previous_close", order=["event_id"],
                      bucket_width=TICK_BUCKETS)
    return d.select("event_id", "event_type", "ts", "value", "previous_close")


@query
def period_returns(spark, sf):
    """Absolute and percent return per event type, zero prices included."""
    d = with_returns(_zeroed_ticks(spark, sf), "event_type", "ts", "close", "previous_close",
                     "price_change", "pct_change", order=["event_id"], bucket_width=TICK_BUCKETS)
    return d.select("event_id", "event_type", "ts", "close", "previous_close", "price_change", "pct_change")


@query
def daily_variation(spark, sf):
    """Null-safe variation per event type, zero prices included."""
    d = with_variation(_zeroed_ticks(spark, sf), "event_type", "ts", "close", "variation",
                       order=["event_id"], bucket_width=TICK_BUCKETS)
    return d.select("event_id", "event_type", "ts", "close", "variation")


@query
def monthly_returns(spark, sf):
    """L2: monthly bars per supplier -> previous close and returns, audited."""
    return EQ.monthly_returns(L.landed_monthly_bars(_t(spark, sf, "lineitem")), RUN_TS)


@query
def index_daily_returns(spark, sf):
    """L2 index table: daily return per index from the landed quotes."""
    q = L.landed_quotes(_t(spark, sf, "events"))
    prices = q.select(F.col("ticker").alias("indice"), "abertura", F.col("maiorAlta").alias("alta"),
                      "fechamento", F.col("tickerNome").alias("nome_indice"), F.col("dataCotacao").alias("data"))
    return EQ.index_returns(prices, RUN_TS)


@query
def dedupe_latest(spark, sf):
    """One line per (order, line number): latest ship date, then highest price,
    then lowest part key."""
    li = _t(spark, sf, "lineitem")
    return dedupe(li, ["l_orderkey", "l_linenumber"],
                  [("l_shipdate", "desc"), ("l_extendedprice", "desc"), ("l_partkey", "asc")])


@query(name="wide_to_long")
def wide_to_long_bars(spark, sf):
    """Daily bars pivoted wide (one column per event type and field), then back to
    one row per (day, type)."""
    ev = _t(spark, sf, "events")
    wide = (ev.groupBy(F.to_date("ts").alias("d")).pivot("event_type", EVENT_TYPES)
              .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.max("value").alias("high")))
    return wide_to_long(wide, ["d"], ["close", "high"], EVENT_TYPES, name="{ticker}_{field}")


# ------------------------------------------------------------------ cleansing

def _quotes(spark, sf):
    return EQ.active_companies(L.landed_active_quotes(_t(spark, sf, "orders")), RUN_TS)


@query
def standardise_quotes(spark, sf):
    """Whitelist, rename, audit, cast and null-key drop of screener quotes."""
    return _quotes(spark, sf)


@query
def top_by_cap(spark, sf):
    """O1-O3: the 200 largest by market cap (the screener's report size)."""
    return top(_quotes(spark, sf), [("capitalizacao_mercado", "desc"), ("ticker", "asc")], 200)


@query
def audit_columns(spark, sf):
    """Audit columns with an injected run time."""
    return C.with_audit(_t(spark, sf, "events").select("event_id"), RUN_TS)


@query
def cast_keys(spark, sf):
    """Key columns to text, order timestamp to a date."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return C.cast_columns(o, {"o_orderkey": "string", "o_custkey": "string", "o_orderdate": "date"})


@query
def drop_null_keys(spark, sf):
    """P5: ticks below 5 lose their ticker; those rows are dropped."""
    ev = _t(spark, sf, "events")
    d = ev.select("event_id", F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("event_type")).alias("ticker"),
                  "value")
    return C.drop_null_keys(d, ["ticker"])


@query
def filter_ge(spark, sf):
    """Numeric lower bound, pushed into the scan."""
    return _t(spark, sf, "orders").filter(F.col("o_totalprice") >= F.lit(150000.0))


@query
def filter_eq(spark, sf):
    """Keep one kind of record (closing bulletins <- purchase ticks)."""
    return _t(spark, sf, "events").filter(F.col("event_type") == "purchase")


@query
def after_date(spark, sf):
    """Strictly after the start day (the day itself excluded)."""
    return C.after(_t(spark, sf, "orders"), "o_orderdate", "1998-08-02")


@query
def map_codes(spark, sf):
    """Event type -> ticker -> code and display name (CASE lookups)."""
    ev = _t(spark, sf, "events").select("event_id", C.map_values("event_type", L.EVENT_TICKERS).alias("ticker"))
    return ev.select("event_id", "ticker", C.map_values("ticker", L.TICKER_CODES).alias("codigoTicker"),
                     C.map_values("ticker", L.TICKER_NAMES).alias("tickerNome"))


@query
def cleanse_sentinel(spark, sf):
    """Text prices with Infinity sentinels and gaps -> default 0.0, nulls kept."""
    ev = _t(spark, sf, "events")
    v = F.col("value")
    txt = (F.when(v < 2, F.lit("Infinity")).when(v > 300, F.lit("-Infinity")).when(v > 250, F.lit(None))
            .otherwise(v.cast("string")))
    d = ev.select("event_id", txt.alias("price"))
    return C.cleanse_sentinel(d, {"price": 0.0}, {"price": "double"})


def _quarantine(spark, sf):
    ev = _t(spark, sf, "events")
    raw = F.when(F.col("value") < 5, F.col("props")).otherwise(F.col("event_id").cast("string"))
    return C.convert_or_quarantine(ev.select("event_id", raw.alias("raw_id")), {"raw_id": "bigint"})


@query
def quarantine_bad(spark, sf):
    """Rows whose text id does not convert, with the failing column names."""
    return _quarantine(spark, sf)[1]


@query
def quarantine_good(spark, sf):
    """The converted rows."""
    return _quarantine(spark, sf)[0]


def _company(spark, sf, table):
    info = L.landed_company_info(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    return EQ.split_company_info(info, RUN_TS, zone="UTC")[table]


@query
def company_split_general(spark, sf):
    """General company dimension."""
    return _company(spark, sf, "cadastro")


@query
def company_split_financial(spark, sf):
    """Financial dimension (bigint fields)."""
    return _company(spark, sf, "financas")


@query
def company_split_market(spark, sf):
    """Market dimension, sentinel prices defaulted."""
    return _company(spark, sf, "mercado")


@query
def company_split_dividend(spark, sf):
    """Dividend dimension, ex-dividend epoch as UTC text."""
    return _company(spark, sf, "dividendos")


@query
def company_split_valuation(spark, sf):
    """Valuation dimension."""
    return _company(spark, sf, "valuation")


@query
def company_rows(spark, sf):
    """P12 in one pass: the five dimensions of every company as rows of one frame, from one scan of the extract."""
    info = L.landed_company_info(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    return EQ.company_rows(info, RUN_TS, zone="UTC")


@query
def facts_upsert_swap(spark, sf):
    """K3/C4/M4: two runs into a bucketed fact table, each staged, tested while written and swapped in; the second brings
    changed prices for some companies and the others as they were."""
    import uuid

    from ..catalog import ensure_database
    from ..session import scratch_path
    from ..sinks.swap import described, upsert_table
    c = _t(spark, sf, "customer").filter("c_name IS NOT NULL").selectExpr(
        "c_name AS ticker", "c_custkey AS volume", "c_acctbal AS preco", "c_custkey % 3 = 0 AS moves")
    db, base = f"swap_{uuid.uuid4().hex}", scratch_path(spark, "facts")
    ensure_database(spark, db)
    checks = {"no_ticker": "ticker IS NULL"}
    upsert_table(spark, f"{db}.prices", C.with_audit(c.drop("moves"), EARLIER_RUN_TS), ["ticker"], base, 8, checks)
    later = c.withColumn("preco", F.when(F.col("moves"), F.col("preco") + 1).otherwise(F.col("preco"))).drop("moves")
    upsert_table(spark, f"{db}.prices", C.with_audit(later, RUN_TS), ["ticker"], base, 8, checks)
    stored = spark.read.parquet(described(spark, f"{db}.prices")["Location"])
    spark.sql(f"DROP DATABASE {db} CASCADE")          # external: the files stay, no database is left per call
    return stored


@query
def fetch_plan(spark, sf):
    """I1/F11 per series: what to fetch next, holes included. The stored raw layer lacks the 10th to 12th of every month, and
    three wanted series have no rows at all."""
    macro, quotes, fx = _raw(spark, sf)
    day = lambda kind, df, series, d: df.select(F.lit(kind).alias("kind"), F.col(series).alias("series"), F.col(d).alias("day"))
    stored = union_all([day("macro", macro, "nm_indice", "data"), day("index", quotes, "ticker", "dataCotacao"),
                        day("fx", fx, "moeda", "dataCotacao")])
    unseen = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("series"))
                                 for k, n in (("index", "DIVO11.SA"), ("fx", "EUR"), ("fx", "CHF"))])).alias("w")
    wanted = stored.select("kind", "series").unionByName(spark.range(1).select(unseen).select("w.*"))
    return plan_fetches(wanted, stored.filter(~F.dayofmonth("day").between(10, 12)), RUN_TS)


# ------------------------------------------------------------------ scalar functions

@query(name="epoch_to_text")
def epoch_to_text_utc(spark, sf):
    """Unix seconds -> text in UTC whatever the session zone."""
    ev = _t(spark, sf, "events")
    secs = F.floor(ntz_micros("ts") / F.lit(1_000_000)).cast("bigint")
    d = ev.select("event_id", secs.alias("epoch_s"))
    return d.withColumn("ts_text", epoch_to_text("epoch_s", "UTC"))


@query
def round_prices(spark, sf):
    """a price split in three instalments, rounded to cents."""
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     round_price(F.col("l_extendedprice") / F.lit(3), 2).alias("instalment"))


@query
def upper_labels(spark, sf):
    """upper-case labels."""
    return _t(spark, sf, "events").select("event_id", F.upper("event_type").alias("label"))


@query(name="distinct_from")
def distinct_from_prev(spark, sf):
    """events whose type IS DISTINCT FROM the user's previous event type."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    d = with_previous(ev, "user_id", "ts", "event_type", "prev_type", order=["event_id"],
                      bucket_width=TICK_BUCKETS)
    return d.filter(distinct_from("event_type", "prev_type")).select("event_id", "user_id", "event_type", "prev_type")


# ------------------------------------------------------------------ aggregates / sets

@query
def row_count(spark, sf):
    """A1: row count."""
    return _t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query
def high_watermark(spark, sf):
    """A2: the stored table's latest date."""
    return I.footer_watermark(spark, f"{sf.rstrip('/')}/orders.parquet", "o_orderdate")


@query
def high_watermark_day(spark, sf):
    """A2: the latest day of the stored macro extract, from the Parquet footers alone."""
    from ..session import scratch_path
    path = scratch_path(spark, "raw-macro")
    L.landed_macro(_t(spark, sf, "orders")).write.parquet(path)
    return I.footer_watermark(spark, path, "data")


@query
def union_series(spark, sf):
    """Three differently sourced price series in one shape, matched by name."""
    o = _t(spark, sf, "orders").select(F.lit("orders").alias("source"), F.col("o_orderstatus").alias("series"),
                                       F.to_date("o_orderdate").alias("data"), F.col("o_totalprice").alias("price"))
    li = _t(spark, sf, "lineitem").select(F.lit("lineitem").alias("source"), F.col("l_returnflag").alias("series"),
                                          F.to_date("l_shipdate").alias("data"), F.col("l_extendedprice").alias("price"))
    ev = _t(spark, sf, "events").select(F.lit("events").alias("source"), F.col("event_type").alias("series"),
                                        F.to_date("ts").alias("data"), F.col("value").alias("price"))
    return union_all([o, li, ev])


# ------------------------------------------------------------------ mutation

@query
def update_where(spark, sf):
    """M1: add 100 to urgent orders' price."""
    return MU.update_where(_t(spark, sf, "orders"), "o_orderpriority = '1-URGENT'",
                           {"o_totalprice": "o_totalprice + 100"})


@query
def delete_where(spark, sf):
    """M2: delete pending orders."""
    return MU.delete_where(_t(spark, sf, "orders"), F.col("o_orderstatus") == "P")


def _arriving_orders(spark, sf, since):
    o = _from(_t(spark, sf, "orders"), "o_orderdate", since)
    return o.withColumns({"o_orderstatus": F.lower("o_orderstatus"), "o_totalprice": F.col("o_totalprice") * 2})


@query
def merge_upsert(spark, sf):
    """M3: merge arriving orders, updating only the price; new keys inserted whole."""
    tgt = _before(_t(spark, sf, "orders"), "o_orderdate", "1998-01-01")
    src = _arriving_orders(spark, sf, "1997-01-01")
    return MU.merge_into(tgt, src, ["o_orderkey"], update={"o_totalprice": "src.o_totalprice"})


def _audited_orders(df, run_ts):
    d = df.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return C.with_audit(d, run_ts)


@query
def upsert_changed(spark, sf):
    """M4: change-aware upsert of arriving orders (status changed for urgent ones,
    null priorities on both sides)."""
    o = _t(spark, sf, "orders")
    tgt = _audited_orders(_before(o, "o_orderdate", "1999-01-01"), EARLIER_RUN_TS)
    src = _from(o, "o_orderdate", "1998-01-01").withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("F")).otherwise(F.col("o_orderstatus")))
    return MU.upsert_changed(tgt, _audited_orders(src, RUN_TS), ["o_orderkey"])


@query
def replace_by_key(spark, sf):
    """M5: delete+insert by key of arriving orders."""
    tgt = _before(_t(spark, sf, "orders"), "o_orderdate", "1999-01-01")
    return MU.replace_by_key(tgt, _arriving_orders(spark, sf, "1998-01-01"), ["o_orderkey"])


# ------------------------------------------------------------------ versions

@query
def version_history(spark, sf):
    """M6: one row per version of the events change log."""
    return V.history(_changelog(spark, sf))


@query
def version_metrics(spark, sf):
    """M6: inserted, updated and deleted keys per version of the events change log, where every seventh day overwrites."""
    log = _changelog(spark, sf)
    log = log.withColumns({V.OP: F.when((F.col(V.VERSION) % 7 == 0) & (F.col(V.OP) != "delete"), F.lit("overwrite")).otherwise(F.col(V.OP)),
                           V.PARAMS: F.concat(F.lit('{"day": '), F.col(V.VERSION), F.lit("}"))})
    return V.commit_metrics(log, ["user_id"])


@query
def as_of_version(spark, sf):
    """M7: state of the change log as of 2024-01-15."""
    v = (VERSION_CUT - date(1970, 1, 1)).days
    return V.as_of_version(_changelog(spark, sf), ["user_id"], v)


@query
def versioned_current(spark, sf):
    """Latest state of the change log."""
    return V.current(_changelog(spark, sf), ["user_id"])


@query
def commit_versions(spark, sf):
    """M8 / K5: three commits on the change log - delete the clicks, overwrite with nothing, merge
    the state of 2024-01-15 - and the state after each (``step`` 2 has no row)."""
    keys, log = ["user_id"], _changelog(spark, sf)
    last = log.select(F.max(V.VERSION)).scalar()
    state, cut = V.current(log, keys), V.as_of_version(log, keys, (VERSION_CUT - date(1970, 1, 1)).days)
    after = materialize(V.commit(log, V.delete_changes(state, "event_type = 'click'"), "delete"), "commit-1")
    after = materialize(V.commit(after, cut.limit(0), "overwrite"), "commit-2")
    after = materialize(V.commit(after, V.merge_changes(V.current(after, keys), keys, cut), "merge"), "commit-3")
    steps = [V.as_of_version(after, keys, last + n).withColumn("step", F.lit(n)) for n in (1, 2, 3)]
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


# ------------------------------------------------------------------ incremental

@query
def incremental_filter(spark, sf):
    """Orders newer than the stored table's high-watermark."""
    o = _t(spark, sf, "orders")
    return I.newer_than_target(o, _before(o, "o_orderdate", "1999-06-01"), "o_orderdate")


# ------------------------------------------------------------------ data tests

def _gold(spark, sf):
    return M.gold_returns(_silver(spark, sf))


@query
def check_not_null(spark, sf):
    """Gold rows lacking a date, ticker, close or USD close."""
    return Q.check_not_null(_gold(spark, sf), ["dataCotacao", "ticker", "fechamento", "dolar_fechamento"])


@query
def check_unique(spark, sf):
    """Duplicated (order, line number) keys."""
    return Q.check_unique(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_rows_failing(spark, sf):
    """T3 with rows that fail: gold rows of a day that moved by more than half."""
    return Q.check_rows(_gold(spark, sf), "abs(retorno_em_reais) > 0.5 AND ticker NOT IN ('12', '433', '189')")


@query
def upsert_null_keys(spark, sf):
    """M4 / Q3: arriving orders of which some have no priority, a part of the key: none matches, all are inserted."""
    o = _t(spark, sf, "orders")
    part = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    tgt = _before(o, "o_orderdate", "1999-01-01").select((F.col("o_orderkey") % 1000).alias("k"), part.alias("p"), "o_orderkey", "o_totalprice")
    src = _from(o, "o_orderdate", "1999-01-01").select((F.col("o_orderkey") % 1000).alias("k"), part.alias("p"), "o_orderkey", "o_totalprice")
    one = src.filter("p IS NULL").unionByName(dedupe(src.filter("p IS NOT NULL"), ["k", "p"], [("o_orderkey", "asc")]))
    tgt = tgt.filter("p IS NULL").unionByName(dedupe(tgt.filter("p IS NOT NULL"), ["k", "p"], [("o_orderkey", "asc")]))
    return MU.upsert_changed(tgt, one, ["k", "p"])


@query
def check_rows(spark, sf):
    """The gold singular test (null date or ticker)."""
    return Q.check_rows(_gold(spark, sf), "dataCotacao IS NULL OR ticker IS NULL")


@query
def pk_conflicts(spark, sf):
    """T4: arriving order keys that already exist."""
    o = _t(spark, sf, "orders")
    return Q.pk_conflicts(_before(o, "o_orderdate", "1999-01-01"), _from(o, "o_orderdate", "1998-01-01"),
                          ["o_orderkey"])


# ------------------------------------------------------------------ IO and streams
# These write under the shared folder named by spark.checkpoint.dir (a fresh path per
# call) and return the data read back.

@query
def roundtrip_parquet(spark, sf):
    """K1 + S6: overwrite orders as parquet (partitioned by status), read back."""
    from ..session import scratch_path
    from ..sinks.files import write_parquet
    from ..sources.files import read_parquet
    out = scratch_path(spark, "roundtrip-parquet")
    o = _t(spark, sf, "orders")
    write_parquet(o, out, partition_by=["o_orderstatus"])
    return read_parquet(spark, out).select(*o.columns)


@query
def roundtrip_csv_typed(spark, sf):
    """K2 + S5: parts as CSV with a header, read back as text, cast back to the
    declared types."""
    from ..session import scratch_path
    from ..sinks.files import write_csv
    from ..sources.files import read_csv
    out = scratch_path(spark, "roundtrip-csv")
    p = _t(spark, sf, "part")
    write_csv(p, out)
    back = read_csv(spark, out)
    return C.cast_columns(back, {f.name: f.dataType.simpleString() for f in p.schema.fields})


def _stream_copy(spark, sf, runs):
    from ..session import scratch_path
    from ..streaming.sinks import drain, stream_append
    from ..streaming.sources import table_stream
    schema = _t(spark, sf, "events").schema
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    for _ in range(runs):
        sdf = table_stream(spark, sf, schema, glob="events.parquet")
        drain(stream_append(sdf, out, ckpt, trigger="availableNow"))
    return spark.read.schema(schema).parquet(out)


@query
def stream_table_copy(spark, sf):
    """S11 + K8 + K10: the events table as a stream appended into a table with a
    checkpoint (availableNow run), read back."""
    return _stream_copy(spark, sf, 1)


@query
def stream_restart_no_dup(spark, sf):
    """The same stream run twice on one checkpoint; the second run adds nothing."""
    return _stream_copy(spark, sf, 2)


# ------------------------------------------------------------------ raw layer (extract -> raw)

@query
def macro_extract_to_raw(spark, sf):
    """L1 raw: a macro extract (orders' total price by order day plays the CDI series)
    -> keyed raw rows, start day excluded, one row per day."""
    from .raw import macro_to_raw
    o = _t(spark, sf, "orders")
    ext = o.select(F.to_date("o_orderdate").alias("data"), F.col("o_totalprice").alias("valor"))
    return macro_to_raw(ext, 12, "cdi", start="1995-06-30", run_ts=RUN_TS)


@query
def fx_extract_to_raw(spark, sf):
    """L1 raw: every purchase tick as a USD bulletin (closing on weekdays, intermediate
    on weekends) -> closing bulletins, latest per day."""
    from .raw import fx_to_raw
    ev = _t(spark, sf, "events").filter(F.col("event_type") == L.FX_EVENT)
    ext = ev.select(F.lit("USD").alias("moeda"), F.col("value").alias("cotacaoCompra"),
                    F.col("value").alias("cotacaoVenda"), F.lit(1.0).alias("paridadeCompra"),
                    F.lit(1.0).alias("paridadeVenda"), F.col("ts").alias("dataHoraCotacao"),
                    F.when(F.weekday(F.to_date("ts")) < 5, F.lit("Fechamento"))
                     .otherwise(F.lit("Intermediário")).alias("tipoBoletim"))
    return fx_to_raw(ext, start="2024-01-02", run_ts=RUN_TS)


@query
def index_extract_to_raw(spark, sf):
    """L1 raw: ticks as an index quote extract -> rounded, named, latest quote per
    (day, ticker)."""
    from .raw import index_to_raw
    ev = _t(spark, sf, "events").filter(F.col("event_type") != L.FX_EVENT)
    ext = ev.select(F.col("ts").alias("Date"), C.map_values("event_type", L.EVENT_TICKERS).alias("Ticker"),
                    (F.col("value") / F.lit(3)).alias("Open"), F.col("value").alias("High"),
                    F.col("value").alias("Low"), F.col("value").alias("Close"),
                    F.col("user_id").cast("double").alias("Volume"), F.lit(False).alias("Repaired?"))
    return index_to_raw(ext, run_ts=RUN_TS)
