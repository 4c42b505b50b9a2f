"""U1/U2 unions and O1-O3 ordering helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """Union of same-shaped frames, matched by column name (Q2) unless
    ``by_name=False``. Prefer one scan over all series to many per-series frames."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), frames)
    return reduce(lambda a, b: a.union(b), frames)


def order_by(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """O1/O2: total order, mixed directions, applied at the end of a plan only."""
    cols = [F.col(c).desc() if d.lower() == "desc" else F.col(c).asc() for c, d in spec]
    return df.orderBy(*cols)


def top(df: DataFrame, spec: Sequence[tuple[str, str]], n: int) -> DataFrame:
    """O3: ``ORDER BY ... LIMIT n`` (Spark plans it as TakeOrderedAndProject, a per-task
    top-n then a merge - never a full sort)."""
    return order_by(df, spec).limit(n)
