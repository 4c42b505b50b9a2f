"""Data tests that return the failing rows (empty = pass)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``columns``."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicated key values with their count (a partial aggregate, then a filter)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_rows(df: DataFrame, predicate) -> DataFrame:
    """Singular test - rows matching ``predicate`` fail."""
    return df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)


def pk_conflicts(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T4: keys of ``new`` that would break the primary key after an append (already in
    ``existing`` or repeated in ``new``). ``existing`` is first cut to the new keys by a
    semi join, so the count only touches relevant rows. Null keys are ignored (a primary
    key rejects them on insert anyway)."""
    keys = list(keys)
    nk = new.select(*keys).dropna()
    old = existing.select(*keys).join(nk.distinct(), on=keys, how="left_semi")
    return check_unique(old.unionByName(nk), keys)


def assert_empty(df: DataFrame, name: str) -> None:
    """Fail the job when a data test returns rows (``isEmpty`` stops at the first row)."""
    if not df.isEmpty():
        raise AssertionError(f"data test {name} failed")


def observe_checks(df: DataFrame, seen: Observation, checks: Mapping[str, str | Column]) -> DataFrame:
    """T1/T3 during a write: ``df`` unchanged, while the job that consumes it counts ``rows`` and, per check, the rows
    that match its predicate (= fail). Put it right below the write: metrics of the last stage are counted once
    per task, whatever is retried."""
    counts = [F.count(F.when(F.expr(p) if isinstance(p, str) else p, F.lit(1))).alias(name) for name, p in checks.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
