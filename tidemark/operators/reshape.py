"""R1 (wide -> long) and D1 (deterministic dedupe on keys)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def wide_to_long(df: DataFrame, ids: Sequence[str], fields: Sequence[str],
                 tickers: Sequence[str], name: str = "{field}_{ticker}",
                 ticker_col: str = "ticker") -> DataFrame:
    """A frame with one column per (field, ticker) - named by ``name`` - becomes one
    row per (ids, ticker) with the fields as columns. A single generator (``inline``
    over an array of structs) in the same stage: no per-ticker union, no shuffle."""
    structs = [F.struct(F.lit(t).alias(ticker_col),
                        *[F.col(f"`{name.format(field=f, ticker=t)}`").alias(f) for f in fields])
               for t in tickers]
    return df.select(*ids, F.inline(F.array(*structs)))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row per key - the first by ``order`` (``[(col, 'asc'|'desc'), ...]``).

    Planned as ``row_number() = 1``, which Catalyst turns into a group limit before the
    shuffle: every map task sends one row per key, so a key holding a third of the rows
    never gathers in one task, and each column travels once. Ordering follows Spark's
    defaults (asc NULLS FIRST, desc NULLS LAST); ties on ``order`` go to the largest
    remaining row, so the survivor is always deterministic."""
    keys = list(keys)
    if all(c in keys for c in df.columns):
        return df.select(*keys).distinct()
    cols = [F.col(n).desc_nulls_last() if d.lower() == "desc" else F.col(n).asc_nulls_first() for n, d in order]
    cols += [F.col(c).desc_nulls_last() for c in _tiebreak(df, keys, order)]
    w = Window.partitionBy(*keys).orderBy(*(cols or keys))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _tiebreak(df, keys, order) -> list[str]:
    used = set(keys) | {n for n, _ in order}
    return [f.name for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))]
