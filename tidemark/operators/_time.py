"""Time-bucket helpers shared by the bucketed window operators.

A hot series (one ticker holding a third of all ticks) must not become one window
partition. The bucketed operators therefore window over ``(key, bucket)`` and carry the
last value of the previous non-empty bucket in from a small per-bucket summary. The
bucket id must be a non-decreasing function of the time column; these helpers build one.

Widths are in the time column's own units - days for DATE, microseconds for timestamps
(zone-free for TIMESTAMP_NTZ), the value itself for numerics - or a text interval
(``"1 day"``, ``"6 hours"``, ``"15 minutes"``), or ``"density"``: one width for all keys,
such that the densest key has about ``AUTO_TARGET_ROWS`` rows a bucket on average.

``Rows(n)`` cuts by row count instead, ``"auto"`` is ``Rows(AUTO_TARGET_ROWS)``: every key with
more than ``n`` rows gets its own equi-depth cut points, so a burst is cut up however short it is,
and rows of one instant are parted by the order columns. A table without such a key has no cuts and
no carried rows at all.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ntz_micros
from ..session import materialize

AUTO_TARGET_ROWS = 2_000_000
SAMPLES_PER_BUCKET = 100            # sampled rows that place one cut: bucket sizes vary by about a tenth
BROADCAST_CUTS = 1_000_000          # cuts (under 64 bytes each) that are sent to every task at most
FAN, MAX_LEVELS, CUTS = 64, 5, "__cuts"   # the groups of a key's cuts: up to a billion of them
_UNIT_SECONDS = {"day": 86400, "hour": 3600, "minute": 60, "second": 1}
_DAY_MICROS = 86_400_000_000


def time_number(c: Column, dtype: T.DataType) -> Column:
    """The time column as a monotone number in its native units."""
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date"))
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.NumericType):
        return c
    raise TypeError(f"cannot bucket a {dtype.simpleString()} column")


def default_width(dtype: T.DataType):
    """31 days for dates, 1 day for timestamps; numerics must say."""
    if isinstance(dtype, T.DateType):
        return 31
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _DAY_MICROS
    return None


def parse_width(width, dtype: T.DataType):
    """Width in native units from an int/float, a text interval or None (default)."""
    if width is None:
        return default_width(dtype)
    if isinstance(width, (int, float)):
        return width
    m = re.fullmatch(r"\s*(\d+)\s*(day|hour|minute|second)s?\s*", str(width))
    if not m:
        raise ValueError(f"bad bucket width {width!r}")
    seconds = int(m.group(1)) * _UNIT_SECONDS[m.group(2)]
    if isinstance(dtype, T.DateType):
        return max(1, seconds // 86400)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return seconds * 1_000_000
    raise ValueError("text widths apply to date and timestamp columns only")


def auto_width(df: DataFrame, keys, time_col: str, dtype: T.DataType, target: int = AUTO_TARGET_ROWS):
    """Width such that the densest key has about ``target`` rows per bucket.

    One column-pruned, partially aggregated pass (count and span per key); a single
    number reaches the driver. (As a scalar subquery it would be re-run in every branch
    of the plan that buckets.) The width only shapes the work - results are the same for
    any width."""
    n = time_number(F.col(time_col), dtype)
    per_key = (df.select(*keys, n.alias("__n")).filter(F.col("__n").isNotNull())
                 .groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), (F.max("__n") - F.min("__n") + 1).alias("span")))
    dens = per_key.agg(F.max(F.col("c") / F.col("span"))).first()[0]
    if not dens:
        return default_width(dtype)
    floor_w = 1_000_000 if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else 1
    if isinstance(dtype, T.FractionalType):
        return target / dens
    return max(floor_w, int(math.ceil(target / dens)))


def bucket_of(c: Column, dtype: T.DataType, width) -> Column:
    """Monotone bucket id of ``c`` for a width in native units."""
    if width is None:
        raise ValueError("numeric time columns need an explicit bucket width")
    w = width if isinstance(width, Column) else F.lit(width)
    return F.floor(time_number(c, dtype) / w).cast("bigint")


def resolve_width(width, df: DataFrame, keys, time_col: str, dtype: T.DataType):
    if isinstance(width, str) and width == "density":
        return auto_width(df, keys, time_col, dtype)
    return parse_width(width, dtype)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


# ------------------------------------------------------------------ buckets by row count

class Rows(int):
    """Rows a bucket should hold: ``bucket_width=Rows(500_000)``."""


def row_target(width) -> int | None:
    """The row count that ``width`` asks for; None if it is a width in time."""
    if isinstance(width, Rows):
        return max(1, int(width))
    return AUTO_TARGET_ROWS if width == "auto" else None


class RowCuts:
    """Equi-depth cut points of the keys that have more than ``target`` rows, and the buckets that they make.

    ``position`` is a struct column by whose order a key's rows are cut. Two passes over the key and position columns: counts
    per key (partially aggregated; not even that if the whole table has no more than ``target`` rows), and a
    random sample of about ``SAMPLES_PER_BUCKET`` rows a bucket, ranked per key. The cuts - rows / target of them - are
    stored once in the shared folder, so that every use of them sees the same. Rows that are equal in position stay together.

    A key's cuts are stored as the groups of a tree, ``FAN`` to a group: a row meets one group per level by an equi-join
    and finds its place in it, so that it never carries all cuts of its key."""

    def __init__(self, df: DataFrame, keys, position: str, target: int):
        self.keys, self.position, self.cuts, self.total, self.levels = list(keys), position, None, 0, 0
        if df.count() <= target:
            return
        counts = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__c")).filter(F.col("__c") > target)
        hot = counts.select(*[F.col(k).alias(f"__h_{k}") for k in self.keys], F.ceil(F.col("__c") / target).alias("__n"),
                            F.lit(0).cast("bigint").alias("__h_idx"))
        rate = min(1.0, SAMPLES_PER_BUCKET / target)
        sample = df.select(*self.keys, position)
        if rate < 1.0:
            sample = sample.filter(F.rand(17) < rate)
        sample = sample.withColumn("__idx", self._zero())
        of_key = Window.partitionBy(*self.keys)
        at, size = F.row_number().over(of_key.orderBy(position)), F.count(F.lit(1)).over(of_key)
        cut = F.floor(F.col("__at") * F.col("__n") / F.col("__size")) > F.floor((F.col("__at") - 1) * F.col("__n") / F.col("__size"))
        placed = (sample.join(hot, self._same(sample, hot)).withColumns({"__at": at, "__size": size})
                  .filter(cut & (F.col("__at") < F.col("__size"))).select(*self.keys, position).distinct())
        # a cut's rank in level 0; the first cut of every group but the first is in the level above as well
        ranked = placed.withColumn("__r0", (F.row_number().over(of_key.orderBy(position)) - 1).cast("bigint"))
        for i in range(MAX_LEVELS - 1):
            r = F.col(f"__r{i}")
            ranked = ranked.withColumn(f"__r{i + 1}", F.when((r > 0) & (r % FAN == 0), F.floor(r / FAN) - 1))
        at_level = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"__r{i}").alias("r")) for i in range(MAX_LEVELS)]),
                                      lambda x: x["r"].isNotNull()))
        groups = (ranked.select(*self.keys, position, at_level.alias("__l"))
                  .groupBy(*[F.col(k).alias(f"__h_{k}") for k in self.keys], F.col("__l.level").alias("__level"),
                           F.floor(F.col("__l.r") / FAN).alias("__h_idx"))
                  .agg(F.sort_array(F.collect_list(position)).alias(CUTS)))
        stored = materialize(groups, "row-cuts")
        self.total, self.levels = stored.agg(F.coalesce(F.sum(F.size(CUTS)), F.lit(0)), F.coalesce(F.max("__level") + 1, F.lit(0))).first()
        if self.total:
            self.cuts = stored

    def _zero(self):
        """The group that every search begins with; written over the position, as a constant is no join key."""
        return F.coalesce(F.pmod(F.hash(self.position), F.lit(1)), F.lit(0)).cast("bigint")

    def _same(self, left: DataFrame, right: DataFrame):
        return [left[k].eqNullSafe(right[f"__h_{k}"]) for k in self.keys] + [left["__idx"] == right["__h_idx"]]

    def assign(self, df: DataFrame, bucket: str) -> DataFrame:
        """``df`` with its bucket, 0 for keys without cuts. The cuts are broadcast while there are at most ``BROADCAST_CUTS``."""
        out = df.withColumn("__idx", self._zero())
        steps = F.sequence(F.lit(1), F.lit(FAN.bit_length()))

        def halve(acc, _):
            mid = F.shiftright(acc["lo"] + acc["hi"], 1)
            after = F.get(F.col(CUTS), mid) <= F.col(self.position)
            return (F.when(acc["lo"] >= acc["hi"], acc)
                    .when(after, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
                    .otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))))

        for level in reversed(range(self.levels)):
            groups = self.cuts.filter(F.col("__level") == level).drop("__level")
            found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.coalesce(F.size(CUTS), F.lit(0)).alias("hi")),
                                halve, lambda acc: acc["lo"])
            out = (out.join(F.broadcast(groups) if self.total <= BROADCAST_CUTS else groups, self._same(out, groups), "left")
                   .withColumn("__idx", F.col("__idx") * FAN + found)
                   .drop(CUTS, "__h_idx", *[f"__h_{k}" for k in self.keys]))
        return out.withColumnRenamed("__idx", bucket)
