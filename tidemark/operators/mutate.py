"""Row mutation as DataFrame plans (no table format needed).

Merges are full outer joins on the key columns. Both sides are keyed tables, so no key
is hot; at scale bucket both sides by the key (``sinks.save_table(bucket_by=...)``) and
the join runs without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import distinct_from

_IN_T, _IN_S, _N = "__in_t", "__in_s", "__n"


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _val(v) -> Column:
    return F.expr(v) if isinstance(v, str) else v


def update_where(df: DataFrame, cond, set_exprs: Mapping[str, object]) -> DataFrame:
    """M1: ``UPDATE df SET k = expr WHERE cond``. All expressions see the old row; a null
    condition is no match."""
    hit = F.coalesce(_cond(cond), F.lit(False))
    return df.withColumns({k: F.when(hit, _val(v)).otherwise(F.col(k)) for k, v in set_exprs.items()})


def delete_where(df: DataFrame, cond) -> DataFrame:
    """M2: ``DELETE FROM df WHERE cond`` (a null condition keeps the row)."""
    return df.filter(~F.coalesce(_cond(cond), F.lit(False)))


def unique_source(src: DataFrame, keys: Sequence[str], what: str = "merge", null_safe_keys: bool = False) -> DataFrame:
    """Q1: fail the job when two source rows share a key. A key with a null in it matches nothing (Q3), so rows may share
    it, unless ``null_safe_keys``.

    The check is inside the plan: a ``count`` window over the key raises on a count
    above 1. The window's hash partitioning and sort on the key are exactly what the
    following sort-merge join on the same key needs, so the check adds no shuffle and no
    extra job."""
    keys = list(keys)
    msg = F.lit(f"{what}: more than one source row for a key")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    shared = F.col(_N) > 1
    for k in [] if null_safe_keys else keys:
        shared = shared & F.col(k).isNotNull()
    return (src.withColumn(_N, n)
               .filter(F.when(shared, F.raise_error(msg)).otherwise(F.lit(True)))
               .drop(_N))


def _full_join(t: DataFrame, s: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Full outer join on the keys, key columns coalesced. ``null_safe`` matches null
    keys to each other (``<=>``); the default never matches a null key (Q3)."""
    if not null_safe:
        return t.join(s, on=keys, how="full")
    s2 = s.withColumnsRenamed({k: f"__sk_{k}" for k in keys})
    cond = [t[k].eqNullSafe(s2[f"__sk_{k}"]) for k in keys]
    j = t.join(s2, on=cond, how="full")
    return j.withColumns({k: F.coalesce(t[k], s2[f"__sk_{k}"]) for k in keys}).drop(*[f"__sk_{k}" for k in keys])


def _strip(ref: str) -> str:
    for p in ("src.", "source.", "new_data."):
        if ref.startswith(p):
            return ref[len(p):]
    return ref


def merge_into(tgt: DataFrame, src: DataFrame, keys: Sequence[str],
               update: Mapping[str, str] | None = None, insert: Mapping[str, str] | None = None,
               check_unique: bool = True, null_safe_keys: bool = False) -> DataFrame:
    """``MERGE INTO tgt USING src ON keys``.

    matched -> the ``update`` columns take the named source columns, the others keep the
    target value (``update=None``: every same-named column); unmatched source -> inserted
    via ``insert`` (``None``: same-named columns, others null); unmatched target -> kept."""
    keys = list(keys)
    if check_unique:
        src = unique_source(src, keys, "merge_into", null_safe_keys)
    tcols = tgt.columns
    nonkey = [c for c in tcols if c not in keys]
    if update is None:
        update = {c: c for c in nonkey if c in src.columns}
    if insert is None:
        insert = {c: c for c in tcols if c in src.columns}
    scols = [c for c in src.columns if c not in keys]
    s = src.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in scols], F.lit(True).alias(_IN_S))
    t = tgt.withColumn(_IN_T, F.lit(True))
    j = _full_join(t, s, keys, null_safe_keys)
    matched = F.col(_IN_T).isNotNull() & F.col(_IN_S).isNotNull()
    only_s = F.col(_IN_T).isNull()

    def src_ref(name):
        n = _strip(name)
        return F.col(n) if n in keys else F.col(f"__s_{n}")

    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
            continue
        upd = src_ref(update[c]) if c in update else F.col(c)
        ins = src_ref(insert[c]) if c in insert else F.lit(None)
        out.append(F.when(only_s, ins).when(matched, upd).otherwise(F.col(c)).cast(tgt.schema[c].dataType).alias(c))
    return j.select(*out)


def upsert_changed(tgt: DataFrame, src: DataFrame, keys: Sequence[str],
                   first_seen: str = "dt_ptcao", touched: str = "dthr_igtao",
                   check_unique: bool = True, null_safe_keys: bool = False) -> DataFrame:
    """M4: change-aware upsert.

    New keys are inserted as they come. For an existing key the non-key columns and
    ``touched`` are written only when some non-key column ``IS DISTINCT FROM`` the source;
    ``first_seen`` is never updated, so the first-seen date survives. Non-key columns are
    discovered from the target. A null key never matches (Q3), so such a source row is
    inserted again; ``null_safe_keys=True`` matches null keys to each other instead. A target column
    that the source lacks is no change: matched rows keep it, new rows have null there."""
    keys = list(keys)
    if check_unique:
        src = unique_source(src, keys, "upsert_changed", null_safe_keys)
    tcols = tgt.columns
    audit = {first_seen, touched}
    nonkey = [c for c in tcols if c not in keys and c not in audit]
    carried = [c for c in tcols if c not in keys]
    s = src.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in carried if c in src.columns],
                   F.lit(True).alias(_IN_S))
    t = tgt.withColumn(_IN_T, F.lit(True))
    j = _full_join(t, s, keys, null_safe_keys)

    def sv(c):
        return F.col(f"__s_{c}") if c in src.columns else F.lit(None)

    changed = F.lit(False)
    for c in nonkey:
        if c in src.columns:
            changed = changed | distinct_from(F.col(c), sv(c))
    only_s = F.col(_IN_T).isNull()
    write = F.col(_IN_T).isNotNull() & F.col(_IN_S).isNotNull() & changed
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
        elif c == first_seen or c not in src.columns:
            out.append(F.when(only_s, sv(c)).otherwise(F.col(c)).cast(tgt.schema[c].dataType).alias(c))
        else:
            out.append(F.when(only_s | write, sv(c)).otherwise(F.col(c)).cast(tgt.schema[c].dataType).alias(c))
    return j.select(*out)


def replace_by_key(tgt: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M5: incremental write by unique key - delete target rows whose key is in the
    source, insert every source row (dbt's delete+insert)."""
    keys = list(keys)
    kept = tgt.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src.select(*tgt.columns))


def changed_rows(tgt: DataFrame, src: DataFrame, keys: Sequence[str],
                 compare: Sequence[str] | None = None) -> DataFrame:
    """Source rows whose key exists in the target and where some compared column is
    distinct (``EXISTS (key match AND any IS DISTINCT FROM)``) - a left semi join."""
    keys = list(keys)
    if compare is None:
        compare = [c for c in tgt.columns if c not in keys and c in src.columns]
    s, t = src.alias("s"), tgt.alias("t")
    cond = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    anyd = F.lit(False)
    for c in compare:
        anyd = anyd | distinct_from(F.col(f"s.{c}"), F.col(f"t.{c}"))
    return s.join(t, on=cond + [anyd], how="left_semi")
