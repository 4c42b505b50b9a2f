"""L1: the macro job - raw extracts -> silver variation -> gold BRL returns.

Silver (U2) unions five differently sourced series into
``(dataCotacao, indicador, ticker, tickernome, fechamento, variacao_diaria)``; gold
adds the USD close/variation as of each date (J1) and compounds the foreign tickers'
return with the currency variation (F9/P10). Both have full and incremental (I3/I4)
forms; the incremental ones replace rows by ``(dataCotacao, ticker)`` (M5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import brl_compound
from ..operators.asof import asof_left
from ..operators.incremental import merge_state, newer_than_state, newer_than_target, series_state
from ..operators.mutate import replace_by_key
from ..operators.returns import with_variation
from ..operators.setops import union_all

SILVER_COLS = ["dataCotacao", "indicador", "ticker", "tickernome", "fechamento", "variacao_diaria"]
GOLD_COLS = SILVER_COLS + ["retorno_em_reais", "dolar_fechamento", "dolar_variacao"]
SILVER_KEY = ["dataCotacao", "ticker"]
# Fixed values of the reference's gold model: the FX series and the foreign tickers
# whose return is compounded with it.
FX_TICKER = "USD"
FOREIGN_TICKERS = ("VT", "^GSPC")


def silver_macro(macro: DataFrame) -> DataFrame:
    """Macro branch: the value is already a period variation, copied as is (Q11)."""
    name = F.upper("nm_indice")
    return macro.select(F.col("data").alias("dataCotacao"), name.alias("indicador"),
                        F.col("cod_sgs").cast("string").alias("ticker"), name.alias("tickernome"),
                        F.col("valor").alias("fechamento"), F.col("valor").alias("variacao_diaria"))


def _varied(rows: DataFrame, seeds: DataFrame | None, series: str, value: str) -> DataFrame:
    """``rows`` with their variation; ``seeds`` are rows before them that only feed the LAG."""
    if seeds is None:
        return with_variation(rows, series, "dataCotacao", value, "__var")
    both = rows.withColumn("__seed", F.lit(False)).unionByName(seeds.withColumn("__seed", F.lit(True)), allowMissingColumns=True)
    return with_variation(both, series, "dataCotacao", value, "__var").filter(~F.col("__seed")).drop("__seed")


def silver_quotes(quotes: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Index branch: variation per raw ticker by date; ticker upper-cased in the output
    only (Q17)."""
    v = _varied(quotes, seeds, "ticker", "fechamento")
    return v.select("dataCotacao", F.upper("codigoTicker").alias("indicador"),
                    F.upper("ticker").alias("ticker"), F.upper("tickerNome").alias("tickernome"),
                    "fechamento", F.col("__var").alias("variacao_diaria"))


def silver_fx(fx: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """FX branch: selling rate as the close, variation per currency by date."""
    v = _varied(fx, seeds, "moeda", "cotacaoVenda")
    cur = F.upper("moeda")
    return v.select("dataCotacao", cur.alias("indicador"), cur.alias("ticker"), cur.alias("tickernome"),
                    F.col("cotacaoVenda").alias("fechamento"), F.col("__var").alias("variacao_diaria"))


def silver_variation(macro: Sequence[DataFrame] | DataFrame | None = None,
                     quotes: DataFrame | None = None, fx: DataFrame | None = None) -> DataFrame:
    """Full silver table from the raw extracts."""
    macros = [macro] if isinstance(macro, DataFrame) else list(macro or [])
    parts = [silver_macro(m) for m in macros]
    if quotes is not None:
        parts.append(silver_quotes(quotes))
    if fx is not None:
        parts.append(silver_fx(fx))
    return union_all(parts)


def gold_returns(silver: DataFrame, fx_ticker: str = FX_TICKER,
                 foreign: Sequence[str] = FOREIGN_TICKERS, usd_source: DataFrame | None = None) -> DataFrame:
    """L1 gold: every silver row plus the as-of USD close and variation and the BRL
    return (``r + d + r*d`` for foreign tickers, their own variation when no FX, the
    variation unchanged for the others)."""
    src = usd_source if usd_source is not None else silver
    usd = (src.filter(F.col("ticker") == fx_ticker)
              .select(F.col("dataCotacao").alias("__usd_date"),
                      F.col("fechamento").alias("dolar_fechamento"),
                      F.col("variacao_diaria").alias("dolar_variacao")))
    j = asof_left(silver.select(*SILVER_COLS), usd, on="dataCotacao", right_on="__usd_date",
                  payload=["dolar_fechamento", "dolar_variacao"])
    r, d = F.col("variacao_diaria"), F.col("dolar_variacao")
    ret = F.when(F.col("ticker").isin(*foreign), F.coalesce(brl_compound(r, d), r)).otherwise(r)
    return j.withColumn("retorno_em_reais", ret).select(*GOLD_COLS)


# ------------------------------------------------------------------ incremental

# Where each raw extract has its series, date and value.
RAW_SHAPE = {"macro": ("cod_sgs", "data", "valor"), "quotes": ("ticker", "dataCotacao", "fechamento"),
             "fx": ("moeda", "dataCotacao", "cotacaoVenda")}


def raw_state(macro: Sequence[DataFrame] | DataFrame | None = None, quotes: DataFrame | None = None,
              fx: DataFrame | None = None) -> DataFrame | None:
    """The state table of raw rows: (kind, series, last_date, last_value) per series; None without any extract."""
    macros = [macro] if isinstance(macro, DataFrame) else list(macro or [])
    parts = [series_state(df, *RAW_SHAPE[kind], kind) for kind, dfs in (("macro", macros), ("quotes", [quotes]), ("fx", [fx]))
             for df in dfs if df is not None]
    return union_all(parts) if parts else None


def silver_new_rows(state: DataFrame, macro: Sequence[DataFrame] | DataFrame | None = None,
                    quotes: DataFrame | None = None, fx: DataFrame | None = None,
                    lookback: str = "last", scope: str = "series") -> DataFrame:
    """I3 from a state table: the silver rows of all raw rows newer than the state. Every raw extract is scanned once; the
    LAG of a series begins with the state's last value (``lookback="last"``) instead of raw history."""
    macros = [macro] if isinstance(macro, DataFrame) else list(macro or [])
    wm = state.agg(F.max("last_date")).first()[0] if scope == "global" else None

    def newer(df, kind):
        series, date, _ = RAW_SHAPE[kind]
        return newer_than_state(df, state, series, date, kind, scope, wm)

    def seeds(df, kind):
        if lookback == "none":
            return None
        series, date, value = RAW_SHAPE[kind]
        return state.filter(F.col("kind") == kind).select(F.col("series").alias(series), F.col("last_date").alias(date),
                                                          F.col("last_value").alias(value))

    parts = [silver_macro(newer(m, "macro")) for m in macros]
    for df, kind, build in ((quotes, "quotes", silver_quotes), (fx, "fx", silver_fx)):
        if df is not None:
            parts.append(build(newer(df, kind), seeds(df, kind)))
    return union_all(parts)


def silver_increment(silver: DataFrame | None, macro: Sequence[DataFrame] | DataFrame | None = None,
                     quotes: DataFrame | None = None, fx: DataFrame | None = None,
                     lookback: str = "none", scope: str = "global", state: DataFrame | None = None) -> DataFrame:
    """Rows newer than the stored silver's watermark from every source -> variation
    -> union -> replace by key.

    ``scope="global"`` (the reference): one ``max(dataCotacao)`` over the whole silver
    table, so a slower series older than the newest row is skipped (Q6).
    ``scope="series"``: one watermark per silver ticker (a small grouped aggregate).
    ``lookback="none"`` reproduces the reference: LAG only sees the new rows, so each
    series' first new row has variation 0 (Q8). ``lookback="last"`` pulls in the last
    stored row per series so the first new variation is the true one. With a ``state`` table (``raw_state`` of the
    rows that were loaded) watermarks and last rows come from it: the new rows are computed in one scan of each
    extract and written once, since the replacement reads them twice."""
    if lookback not in ("none", "last"):
        raise ValueError("lookback must be 'none' or 'last'")
    if scope not in ("global", "series"):
        raise ValueError("scope must be 'global' or 'series'")
    macros = [macro] if isinstance(macro, DataFrame) else list(macro or [])
    if silver is None:
        return silver_variation(macros, quotes, fx)
    if state is not None:
        new = materialize_small(silver_new_rows(state, macros, quotes, fx, lookback, scope))
        return replace_by_key(silver.select(*SILVER_COLS), new, SILVER_KEY)
    if scope == "global":
        gwm = silver.select(F.max("dataCotacao")).scalar()

        def with_wm(raw, series_key):
            return raw.withColumn("__wm", gwm)

        def keep_new(out):
            return out.filter(gwm.isNull() | (F.col("dataCotacao") > gwm))
    else:
        wm_tbl = silver.groupBy("ticker").agg(F.max("dataCotacao").alias("__wm"))

        def with_wm(raw, series_key):
            w = wm_tbl.withColumnRenamed("ticker", "__series")
            return raw.withColumn("__series", series_key).join(w, on="__series", how="left").drop("__series")

        def keep_new(out):
            return (out.join(wm_tbl, on="ticker", how="left")
                    .filter(F.col("__wm").isNull() | (F.col("dataCotacao") > F.col("__wm")))
                    .drop("__wm").select(*SILVER_COLS))

    def newer(raw_w, date_col):
        return raw_w.filter(F.col("__wm").isNull() | (F.col(date_col) > F.col("__wm"))).drop("__wm")

    parts = [silver_macro(newer(with_wm(m, F.col("cod_sgs").cast("string")), "data")) for m in macros]

    def branch(raw, series, series_key, date_col, builder):
        raw_w = with_wm(raw, series_key)
        new = newer(raw_w, date_col)
        if lookback == "none":
            return builder(new)
        # the last stored row per series only seeds LAG; rows at or before the series'
        # watermark are dropped again after the variation is computed
        cols = [c for c in raw.columns if c != series]
        prev = (raw_w.filter(F.col(date_col) <= F.col("__wm")).drop("__wm")
                .groupBy(series).agg(F.max_by(F.struct(*cols), F.col(date_col)).alias("__r"))
                .select(series, "__r.*").select(*raw.columns))
        return keep_new(builder(new.unionByName(prev)))

    if quotes is not None:
        parts.append(branch(quotes, "ticker", F.upper("ticker"), "dataCotacao", silver_quotes))
    if fx is not None:
        parts.append(branch(fx, "moeda", F.upper("moeda"), "dataCotacao", silver_fx))
    return replace_by_key(silver.select(*SILVER_COLS), union_all(parts), SILVER_KEY)


def gold_increment(gold: DataFrame | None, silver: DataFrame, lookback: str = "none",
                   fx_ticker: str = FX_TICKER, foreign: Sequence[str] = FOREIGN_TICKERS,
                   scope: str = "global") -> DataFrame:
    """I4: silver rows newer than gold's watermark (global, or per ticker with
    ``scope="series"``) -> as-of USD -> compound -> replace by key. ``lookback="none"``
    cuts the USD series to the new rows too (the reference, Q8); ``"last"`` lets the
    as-of see the whole USD history."""
    if lookback not in ("none", "last"):
        raise ValueError("lookback must be 'none' or 'last'")
    if gold is None:
        return gold_returns(silver, fx_ticker, foreign)
    base = newer_than_target(silver, gold, "dataCotacao", scope=scope, series=["ticker"])
    usd_src = base if lookback == "none" else silver
    new = materialize_small(gold_returns(base, fx_ticker, foreign, usd_source=usd_src))   # the replacement reads it twice
    return replace_by_key(gold.select(*GOLD_COLS), new, SILVER_KEY)


def silver_backfill(silver: DataFrame, macro: Sequence[DataFrame] | DataFrame | None = None,
                    quotes: DataFrame | None = None, fx: DataFrame | None = None) -> DataFrame:
    """The stored silver after raw rows older than its watermark arrived: rows whose recomputed value is
    new or other than the stored one replace it by key. The row after a filled gap changes as well, since its
    previous close is another. Equals the full recompute for every series that the raw layer holds."""
    new = materialize_small(_other(silver_variation(macro, quotes, fx), silver))   # the replacement reads it twice
    return replace_by_key(silver.select(*SILVER_COLS), new, SILVER_KEY)


def _other(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``fresh`` that ``stored`` does not hold just so (null-safe on the key and every value)."""
    s = stored.select(*[F.col(c).alias(f"__{c}") for c in fresh.columns])
    return fresh.join(s, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in fresh.columns], "left_anti")


# ------------------------------------------------------------------ the job

class RejectedRows(AssertionError):
    """Raised when a job has stored all it could and some rows of the extracts are in the quarantine."""


# A raw row without these is not stored.
RAW_REQUIRED = {kind: [series, date, value] for kind, (series, date, value) in RAW_SHAPE.items()}


def _accepted(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may be stored, the others as the quarantine keeps them)."""
    from ..operators.clean import rejected
    need = [c for c in RAW_REQUIRED[kind] if c in df.columns]
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in need]))
    bad = df.filter(F.size(missing) > 0)
    kept = [c for c in df.columns if c != "dt_ingestao"]
    return (df.filter(F.size(missing) == 0),
            rejected(bad.select(*kept), kind, F.concat(F.lit("missing "), F.array_join(missing, ","))))


def _raw_tables(spark, base: str, raw_db: str | None) -> dict[str, str]:
    """Kind of extract -> its table in ``raw_db``, created if missing; none without a database."""
    from ..catalog import RAW_TABLES, bootstrap_raw
    if not raw_db:
        return {}
    bootstrap_raw(spark, base, raw_db)
    return {kind: f"{raw_db}.{t}" for t, kind in RAW_TABLES.items()}


def _declared(df: DataFrame, kind: str) -> DataFrame:
    """``df`` in the declared columns and types of its raw table; a column that the extract lacks is null."""
    from ..schemas import RAW_SCHEMAS
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in RAW_SCHEMAS[kind].fields])


def run_job(spark, extracts: dict, base: str, lookback: str = "last", run_checks: bool = True,
            scope: str = "series", rejects: DataFrame | None = None, raw_db: str | None = None) -> dict:
    """L1 end to end over stored tables under ``base``:

    1. raw: rows of each extract (``macro``/``quotes``/``fx`` frames in the raw shapes) that lack key, date or value go to
       ``quarantine`` with the ``rejects`` of the reader, so that no later run meets them; the others keep rows
       newer than the stored table's watermark (strict ``>``, Q5), deduped on the key
       (D1), appended when non-empty with a primary-key check (T4, K11);
    2. silver: the raw rows newer than the ``state`` table (one row per series: last date and value) -> variation seeded by the
       state, written by replacing keys in the touched months only; then the state is merged. A run that
       ends between the two is made up by the next, which replaces the same keys;
    3. gold: I4 against the stored gold, same write.
    The new rows of 2 and 3 pass the data tests (T1/T2/T3) before they are written; the job fails on
    a bad row. The watermark is per series by default, so a slower series is not held back by a faster one.

    Returns row counts of the increments. Reruns are idempotent: a second run with the same extracts adds nothing.
    With ``run_checks`` rejected rows raise ``RejectedRows`` once all the others are stored: a corrected extract, a
    later day or a backfill then takes their place. With ``raw_db`` the raw rows go into the tables of ``catalog.bootstrap_raw``
    (created if missing) in their declared columns and types, and new months become partitions of them.
    """
    from ..catalog import add_months
    from ..operators.incremental import newer_than_target, table_or_none
    from ..operators.quality import assert_empty, check_unique
    from ..operators.reshape import dedupe
    from ..schemas import RAW_KEYS
    from ..sinks.tables import MONTH, append_new_keys, quarantine_write, replace_by_key_write

    base = base.rstrip("/")
    tables = _raw_tables(spark, base, raw_db)
    counts, bad = {}, [] if rejects is None else [rejects]
    for kind, df in extracts.items():
        path = f"{base}/raw/{kind}"
        stored = table_or_none(spark, path)
        df, wrong = _accepted(_declared(df, kind) if raw_db else df, kind)
        bad.append(wrong)
        series, date, _ = RAW_SHAPE[kind]
        fresh = newer_than_target(df, stored, date, scope="series", series=[series])
        fresh = dedupe(fresh, RAW_KEYS[kind], [("dt_ingestao", "desc")] if "dt_ingestao" in df.columns else ())
        fresh = materialize_small(fresh)
        counts[f"raw_{kind}"] = append_new_keys(spark, fresh, path, RAW_KEYS[kind], date)
        if raw_db:   # also where an earlier run ended between the append and this
            add_months(spark, tables[kind], fresh if counts[f"raw_{kind}"] else df, date)
    refused = quarantine_write(spark, union_all(bad), f"{base}/quarantine") if bad else 0

    raw = {}
    for kind in RAW_SHAPE:
        t = table_or_none(spark, f"{base}/raw/{kind}")
        raw[kind] = None if t is None else t.drop(MONTH)
    args = (raw["macro"], raw["quotes"], raw["fx"])
    if any(t is not None for t in args):
        silver_path, gold_path, state_path = f"{base}/silver", f"{base}/gold", f"{base}/state"
        silver_old, state = table_or_none(spark, silver_path), table_or_none(spark, state_path)
        silver_old = None if silver_old is None else silver_old.drop(MONTH)
        if silver_old is None:
            new_silver = silver_variation(*args)
        elif state is None:                       # a store of before there was a state table
            merged = silver_increment(silver_old, *args, lookback=lookback, scope=scope)
            new_silver = newer_than_target(merged, silver_old, "dataCotacao", scope=scope, series=["ticker"])
        else:
            new_silver = silver_new_rows(state, *args, lookback=lookback, scope=scope)
        new_silver, counts["silver_new"] = staged(new_silver, SILVER_CHECKS if run_checks else {})
        if run_checks:  # before the write: a bad row must not be stored, and must fail the retry as well
            assert_empty(check_unique(new_silver, SILVER_KEY), "silver unique")
        replace_by_key_write(spark, new_silver, silver_path, SILVER_KEY, "dataCotacao")
        if state is None:
            materialize_small(raw_state(*args)).write.mode("overwrite").parquet(state_path)
        elif counts["silver_new"]:
            wm = state.agg(F.max("last_date")).first()[0] if scope == "global" else None
            newer = [None if raw[k] is None else newer_than_state(raw[k], state, *RAW_SHAPE[k][:2], k, scope, wm) for k in RAW_SHAPE]
            materialize_small(merge_state(state, raw_state(*newer))).write.mode("overwrite").parquet(state_path)

        silver_all = table_or_none(spark, silver_path).drop(MONTH)
        gold_old = table_or_none(spark, gold_path)
        gold_old = None if gold_old is None else gold_old.drop(MONTH)
        base_rows = silver_all if gold_old is None else newer_than_target(
            silver_all, gold_old, "dataCotacao", scope=scope, series=["ticker"])
        new_gold, counts["gold_new"] = staged(gold_returns(base_rows, usd_source=base_rows if lookback == "none" else silver_all),
                                              GOLD_CHECKS if run_checks else {})
        replace_by_key_write(spark, new_gold, gold_path, SILVER_KEY, "dataCotacao")
    if refused and run_checks:
        raise RejectedRows(f"{refused} rows of the extracts are in {base}/quarantine")
    return counts


def run_backfill(spark, extracts: dict, base: str, start, end=None, rejects: DataFrame | None = None,
                 raw_db: str | None = None) -> dict:
    """L1 over a custom window: raw rows after ``start`` up to ``end`` (``fetch_window``: a default span per
    kind) that are not stored yet, or stored with other values, replace theirs by key, whatever the watermark. Then only what
    they can change is computed again: silver for the window's series, each from its first day in the window on (the raw row before it
    seeds the variation), gold for those rows and, where the FX series is among them, for every row since. Rows that come out new or
    different are tested and replace the stored ones in the months they touch. Idempotent; a rerun of the
    window makes up for a run that ended in between. Rows that lack key, date or value
    go to the quarantine, as in ``run_job``; so does ``raw_db``."""
    from ..catalog import add_months
    from ..functions.fetch_window import fetch_window
    from ..operators.clean import after
    from ..operators.incremental import table_or_none
    from ..operators.quality import assert_empty, check_unique
    from ..operators.reshape import dedupe
    from ..schemas import RAW_KEYS
    from ..sinks.tables import MONTH, quarantine_write, replace_by_key_write

    base = base.rstrip("/")
    tables = _raw_tables(spark, base, raw_db)
    counts, raw, firsts, bad, since = {}, {}, {}, [] if rejects is None else [rejects], None
    for kind, (series, date, value) in RAW_SHAPE.items():
        path, keys = f"{base}/raw/{kind}", RAW_KEYS[kind]
        stored = table_or_none(spark, path)
        if kind in extracts:
            since, last = fetch_window({"quotes": "index"}.get(kind, kind), start=start, end=end)
            rows, wrong = _accepted(_declared(extracts[kind], kind) if raw_db else extracts[kind], kind)
            bad.append(wrong)
            rows = after(rows, date, since).filter(F.col(date) <= F.lit(last))
            window = materialize_small(dedupe(rows, keys, [("dt_ingestao", "desc")] if "dt_ingestao" in rows.columns else ()))
            firsts[kind] = materialize_small(first_days(window, kind))
            rows = window
            if stored is not None:
                same = [c for c in rows.columns if c in stored.columns and c != "dt_ingestao"]
                old = stored.select(*[F.col(c).alias(f"__{c}") for c in same])
                rows = materialize_small(rows.join(old, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in same], "left_anti"))
            counts[f"raw_{kind}"] = not rows.isEmpty()
            if counts[f"raw_{kind}"]:
                replace_by_key_write(spark, rows, path, keys, date)
            if raw_db:
                add_months(spark, tables[kind], window, date)
            stored = table_or_none(spark, path)
        raw[kind] = stored
    refused = quarantine_write(spark, union_all(bad), f"{base}/quarantine") if bad else 0

    def recent(df):
        """The months that the window can change: a filter on the partitions."""
        return df.filter(F.col(MONTH) >= F.lit(since.replace(day=1)))

    def put(layer, fresh, checks, unique):
        path = f"{base}/{layer}"
        old = table_or_none(spark, path)
        rows, counts[f"{layer}_changed"] = staged(fresh if old is None else _other(fresh, recent(old)), checks)
        if unique:
            assert_empty(check_unique(rows, SILVER_KEY), f"{layer} unique")
        replace_by_key_write(spark, rows, path, SILVER_KEY, "dataCotacao")
        return table_or_none(spark, path)

    args = tuple(None if raw[kind] is None else raw[kind].drop(MONTH) for kind in ("macro", "quotes", "fx"))
    held = {kind: first for kind, first in firsts.items() if raw[kind] is not None}
    silver_old, state = (table_or_none(spark, f"{base}/{t}") for t in ("silver", "state"))
    if silver_old is None or state is None:
        if any(t is not None for t in args):
            silver = put("silver", silver_variation(*args), SILVER_CHECKS, True).drop(MONTH)
            materialize_small(raw_state(*args)).write.mode("overwrite").parquet(f"{base}/state")
            put("gold", gold_returns(silver), GOLD_CHECKS, False)
    elif held:
        own = {kind: touched_series(raw[kind], first, kind) for kind, first in held.items()}
        silver = put("silver", silver_touched({kind: (recent(df), df) for kind, df in own.items()}), SILVER_CHECKS, True)
        states = union_all([series_state(df, *RAW_SHAPE[kind], kind) for kind, df in own.items()])
        others = state.join(states.select("kind", "series"), ["kind", "series"], "left_anti")
        materialize_small(others.unionByName(states)).write.mode("overwrite").parquet(f"{base}/state")
        firsts = union_all([first.select(F.upper("series").alias("ticker"), "first_day") for first in held.values()])
        gold_old = table_or_none(spark, f"{base}/gold")
        rows = silver if gold_old is None else gold_touched(recent(silver), firsts)
        put("gold", gold_returns(rows, usd_source=silver), GOLD_CHECKS, False)
    if refused:
        raise RejectedRows(f"{refused} rows of the extracts are in {base}/quarantine")
    return counts


def first_days(rows: DataFrame, kind: str) -> DataFrame:
    """(series, first_day): the first day of every series in ``rows``, raw rows that are new or restated."""
    series, date, _ = RAW_SHAPE[kind]
    return rows.groupBy(F.col(series).cast("string").alias("series")).agg(F.min(date).alias("first_day"))


def touched_series(raw: DataFrame, firsts: DataFrame, kind: str) -> DataFrame:
    """The raw rows of the series in ``firsts`` (one row per series), each with its ``first_day``."""
    series = F.col(RAW_SHAPE[kind][0]).cast("string")
    return raw.join(firsts.withColumnRenamed("series", "__series"), series == F.col("__series")).drop("__series")


def silver_touched(own: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Silver rows of the touched series from their first touched day on. ``own`` holds per kind the ``touched_series`` twice: rows that
    hold all from the first day on, and rows that hold all before it, whose last value seeds the variation."""
    parts = []
    for kind, (later, earlier) in own.items():
        series, date, value = RAW_SHAPE[kind]
        rows = later.filter(F.col(date) >= F.col("first_day")).drop("first_day")
        if kind == "macro":
            parts.append(silver_macro(rows))
            continue
        seeds = earlier.filter(F.col(date) < F.col("first_day")).groupBy(series).agg(
            F.max_by(value, date).alias(value), F.max(date).alias(date))
        parts.append((silver_quotes if kind == "quotes" else silver_fx)(rows, seeds))
    return union_all(parts)


def gold_touched(silver: DataFrame, firsts: DataFrame, fx_ticker: str = FX_TICKER) -> DataFrame:
    """The silver rows whose gold rows may change: those of the tickers in ``firsts`` (ticker, first_day) from that day on, and
    all rows since the first day of the FX series, which every later row looks back at."""
    own = firsts.groupBy("ticker").agg(F.min("first_day").alias("__first"))
    usd = own.filter(F.col("ticker") == fx_ticker).agg(F.min("__first")).first()[0]
    day = F.col("dataCotacao")
    hit = day >= F.col("__first")
    if usd is not None:
        hit = F.coalesce(hit, F.lit(False)) | (day >= F.lit(usd))
    return silver.join(own, "ticker", "left").filter(hit).select(*SILVER_COLS)


# T1/T3 of the layers: name -> predicate of the rows that fail.
SILVER_CHECKS = {"silver not_null": "dataCotacao IS NULL OR ticker IS NULL OR fechamento IS NULL"}
GOLD_CHECKS = {"gold singular": "dataCotacao IS NULL OR ticker IS NULL"}


def staged(df: DataFrame, checks: dict) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and its row count. The rows that fail a check are counted by that same write; any
    fails the job before a stored table is touched."""
    from ..operators.quality import observe_checks
    seen = Observation()
    rows = materialize_small(observe_checks(df, seen, checks))
    for name in checks:
        if seen.get[name]:
            raise AssertionError(f"data test {name} failed")
    return rows, seen.get["rows"]


def materialize_small(df):
    from ..session import materialize
    return materialize(df, "increment")


def _landed(spark, extract_dir: str, series: dict | None, run_ts) -> tuple[dict[str, DataFrame], DataFrame]:
    """The raw rows of every extract found below ``extract_dir``, and what the reader rejects; no extract at all is an error."""
    from ..operators.clean import convert_or_quarantine, rejected
    from ..sources.files import read_checked_or_none
    from .landing import MACRO_SERIES
    from .raw import fx_to_raw, index_to_raw, macro_to_raw

    d = extract_dir.rstrip("/")
    macros, extracts, bad = [], {}, []
    for name, code in (series or MACRO_SERIES).items():
        if (got := read_checked_or_none(spark, "macro", f"{d}/macro/{name}")) is not None:
            rows, wrong = convert_or_quarantine(got[0], {"valor": "double"})
            bad += [got[1], rejected(wrong, "macro", F.concat(F.lit("cast of "), "bad_columns"), F.col("source_file"), ["data", "valor"])]
            macros.append(macro_to_raw(rows, code, name, run_ts=run_ts))
    if macros:
        extracts["macro"] = union_all(macros)
    for kind, name, to_raw in (("fx", "fx", fx_to_raw), ("quotes", "index_daily", index_to_raw)):
        if (got := read_checked_or_none(spark, name, f"{d}/{name}")) is not None:
            extracts[kind] = to_raw(got[0], run_ts=run_ts)
            bad.append(got[1])
    if not extracts:
        raise FileNotFoundError(f"no extract under {d}")
    return extracts, union_all(bad)


def run_job_from_extracts(spark, extract_dir: str, base: str, series: dict | None = None,
                          lookback: str = "last", run_ts=None, scope: str = "series",
                          start=None, end=None, raw_db: str | None = None) -> dict:
    """L1 from landed files: ``extract_dir/{macro/<name>, fx, index_daily}`` (JSON lines, one scan
    per kind over all series) -> raw rows (``plans.raw``) -> ``run_job``. Lines that are broken and values that do not
    convert go to the quarantine with file and reason.
    ``series`` maps macro series names to SGS codes (default: CDI, IPCA, IGP-M). With ``start`` the window after
    it (up to ``end``) is backfilled instead (``run_backfill``)."""
    extracts, rejects = _landed(spark, extract_dir, series, run_ts)
    if start is not None:
        return run_backfill(spark, extracts, base, start, end, rejects=rejects, raw_db=raw_db)
    return run_job(spark, extracts, base, lookback=lookback, scope=scope, rejects=rejects, raw_db=raw_db)


# The gold table's column documentation.
GOLD_COMMENTS = {
    "dataCotacao": "Data da cotação",
    "indicador": "Nome do indicador",
    "ticker": "Código do ticker",
    "tickernome": "Nome completo do ticker",
    "fechamento": "Preço de fechamento do índice ou moeda",
    "variacao_diaria": "Variação diária do índice ou moeda (em percentual)",
    "retorno_em_reais": "Retorno em reais para índices globais (USD), ou igual à variacao_diaria para outros",
    "dolar_fechamento": "Fechamento do dólar no dia",
    "dolar_variacao": "Variação diária do dólar",
}


def publish(spark, base: str, db: str = "gold", raw_db: str | None = "raw") -> list[str]:
    """Register the stored tables of ``run_job`` in the catalog (schema from the
    files, month partitions discovered) and document gold's columns. Returns the silver
    and gold names first, then the raw ones (``raw_db=None`` skips the raw layer)."""
    from ..catalog import RAW_TABLES, _q, comment_columns, ensure_database, register
    from ..operators.incremental import table_or_none
    root = base.rstrip("/")

    def reg(name, path):
        register(spark, name, path)
        spark.sql(f"MSCK REPAIR TABLE {_q(name)}")
        return name

    ensure_database(spark, db)
    names = [reg(f"{db}.variacao_indices", f"{root}/silver"), reg(f"{db}.retorno_indices", f"{root}/gold")]
    comment_columns(spark, names[1], GOLD_COMMENTS)
    if raw_db:
        ensure_database(spark, raw_db)
        for table, kind in RAW_TABLES.items():
            if table_or_none(spark, f"{root}/raw/{kind}") is not None:
                names.append(reg(f"{raw_db}.{table}", f"{root}/raw/{kind}"))
    return names
