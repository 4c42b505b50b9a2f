"""Versioned tables as a change log.

A change log is any DataFrame with the key columns, the payload columns and
``_version`` (long), ``_op`` (``overwrite`` | ``upsert`` | ``delete``) and ``_seq`` (order
inside a version). The state at version *v* is, per key, the row with the greatest
``(_version, _seq)`` among versions ``<= v`` and not older than the last overwrite
``<= v``; it is absent when that row is a delete. ``commit`` adds one marker row per
version (``_op`` ``begin`` or ``begin_overwrite``), so that a version without rows - an
overwrite with nothing, an update that hits nothing - counts too.

Reading a version is one grouped ``max_by`` (partially aggregated before the shuffle, so
a hot key does not land whole in one task) plus one scalar subquery for the last
overwrite. The log is an ordinary DataFrame: where it is stored, and how its writers take
turns, is the caller's affair.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .mutate import merge_into, update_where

VERSION, OP, SEQ, COMMIT_OP, COMMIT_TS, PARAMS = "_version", "_op", "_seq", "_commit_op", "_commit_ts", "_commit_params"
META = (VERSION, OP, SEQ, COMMIT_OP, COMMIT_TS, PARAMS)
BEGIN, BEGIN_OVERWRITE = "begin", "begin_overwrite"
#: op of a commit -> (its name in the history, ``_op`` of rows that carry none)
COMMITS = {"overwrite": ("WRITE", "overwrite"), "update": ("UPDATE", "upsert"),
           "delete": ("DELETE", "delete"), "merge": ("MERGE", "upsert")}


def _payload(log: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in log.columns if c not in set(keys) and c not in META]


def _is_marker() -> Column:
    return F.col(OP).isin(BEGIN, BEGIN_OVERWRITE)


def as_of_version(log: DataFrame, keys: Sequence[str], version=None) -> DataFrame:
    """M7: table state as of ``version`` (``None`` = latest)."""
    keys = list(keys)
    cl = log if version is None else log.filter(F.col(VERSION) <= F.lit(version))
    boundary = cl.filter(F.col(OP).isin("overwrite", BEGIN_OVERWRITE)).select(F.max(VERSION)).scalar()
    cl = cl.filter((boundary.isNull() | (F.col(VERSION) >= boundary)) & ~_is_marker())
    payload = _payload(log, keys)
    latest = (cl.groupBy(*keys)
              .agg(F.max_by(F.struct(*payload, OP), F.struct(VERSION, SEQ)).alias("__r")))
    return latest.filter(F.col(f"__r.{OP}") != "delete").select(*keys, *[F.col(f"__r.{c}").alias(c) for c in payload])


def current(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest state of a versioned table."""
    return as_of_version(log, keys, None)


def history(log: DataFrame, ts_col: str = COMMIT_TS) -> DataFrame:
    """M6: one row per version: version, timestamp, operation and row metrics."""
    has_ts = ts_col in log.columns
    row_op = F.when(~_is_marker(), F.col(OP))
    op = (F.when(F.bool_or(row_op == "overwrite"), F.lit("WRITE"))
           .when(F.bool_and(row_op == "delete"), F.lit("DELETE"))
           .when(F.bool_and(row_op == "upsert"), F.lit("UPDATE"))
           .otherwise(F.lit("MERGE")))
    if COMMIT_OP in log.columns:
        op = F.coalesce(F.max(COMMIT_OP), op)
    return (log.groupBy(VERSION)
            .agg((F.max(ts_col) if has_ts else F.lit(None).cast("timestamp")).alias("timestamp"),
                 op.alias("operation"),
                 F.count(row_op).alias("num_rows"),
                 F.count_if(row_op == "delete").alias("num_deleted"),
                 F.count_if(row_op != "delete").alias("num_written"))
            .withColumnRenamed(VERSION, "version"))


def commit_metrics(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M6: what each version did to the table: version, parameters (the commit's, as JSON), and how many keys it inserted,
    updated (rewritten while present) and deleted; ``num_live`` keys are left. Rows that an overwrite does not repeat are deleted by it.

    Per key the version before is read by ``lag`` over the log reduced to one row per key and version, so no state is rebuilt; a
    row of before the last overwrite is not present any more. What an overwrite removes is the count of keys that the
    versions since the overwrite before it had left, less those that it repeats."""
    keys = list(keys)
    over = F.col(OP).isin("overwrite", BEGIN_OVERWRITE)
    params = F.max(PARAMS) if PARAMS in log.columns else F.lit(None).cast("string")
    in_order = Window.orderBy(VERSION)                       # one row per version
    versions = (log.groupBy(VERSION).agg(F.bool_or(over).alias("__over"), params.alias("parameters"))
                .withColumn("__since", F.max(F.when(F.col("__over"), F.col(VERSION)))
                            .over(in_order.rowsBetween(Window.unboundedPreceding, -1))))
    of_key = Window.partitionBy(*keys).orderBy(VERSION)
    net = (log.filter(~_is_marker()).groupBy(*keys, VERSION).agg(F.max_by(OP, SEQ).alias("__op"))
           .withColumns({"__prev": F.lag(VERSION).over(of_key), "__prev_op": F.lag("__op").over(of_key)}))
    was = (F.col("__prev").isNotNull() & (F.col("__prev_op") != "delete")
           & (F.col("__since").isNull() | (F.col("__prev") >= F.col("__since"))))
    now = F.col("__op") != "delete"
    per = (net.join(versions.select(VERSION, "__since"), VERSION).groupBy(VERSION)
           .agg(F.count_if(now & ~was).alias("inserted"), F.count_if(now & was).alias("updated"), F.count_if(~now & was).alias("deleted")))
    done = versions.join(per, VERSION, "left").fillna(0, ["inserted", "updated", "deleted"])
    left = F.when(F.col("__over"), F.col("inserted") + F.col("updated")).otherwise(F.col("inserted") - F.col("deleted"))
    segment = Window.partitionBy("__segment").orderBy(VERSION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = (done.withColumn("__segment", F.count_if("__over").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("num_live", F.sum(left).over(segment)).withColumn("__before", F.lag("num_live", 1, 0).over(in_order)))
    gone = F.when(F.col("__over"), F.col("__before") - F.col("updated")).otherwise(F.col("deleted"))
    return done.select(F.col(VERSION).alias("version"), "parameters", "inserted", "updated", gone.alias("deleted"), "num_live")


# ---------------------------------------------------------------- M8

def commit(log: DataFrame | None, changes: DataFrame, op: str, ts: Column | None = None,
           params: Mapping[str, object] | None = None) -> DataFrame:
    """M8 / K5: the log with ``changes`` as its next version (0 for no log).

    ``op`` is ``overwrite`` (the whole new content), ``update``, ``delete`` or ``merge``; see
    ``update_changes``, ``delete_changes`` and ``merge_changes`` for what these three log.
    Rows may carry ``_op`` and ``_seq`` of their own; ``params`` (a predicate, a mode) are kept for the history. The plan reads the log's largest version
    as a scalar subquery; write the result, or only its last version, where the table lives."""
    name, row_op = COMMITS[op]
    if log is None:
        version = F.lit(0).cast("bigint")
    else:
        version = F.coalesce(log.select(F.max(VERSION)).scalar() + 1, F.lit(0)).cast("bigint")
    ts_type = log.schema[COMMIT_TS].dataType if log is not None and COMMIT_TS in log.columns else "timestamp"
    rows = changes.withColumns({c: v for c, v in {OP: F.lit(row_op), SEQ: F.lit(0).cast("bigint")}.items()
                                if c not in changes.columns})
    marker = changes.sparkSession.range(1).select(
        F.lit(BEGIN_OVERWRITE if op == "overwrite" else BEGIN).alias(OP), F.lit(-1).cast("bigint").alias(SEQ))
    out = rows.unionByName(marker, allowMissingColumns=True).withColumns({
        VERSION: version, COMMIT_OP: F.lit(name),
        COMMIT_TS: (F.current_timestamp() if ts is None else ts).cast(ts_type)})
    if params is not None:
        out = out.withColumn(PARAMS, F.lit(json.dumps(params, sort_keys=True)))
    return out if log is None else log.unionByName(out, allowMissingColumns=True)


def update_changes(state: DataFrame, cond, set_exprs: Mapping[str, object]) -> DataFrame:
    """M8 update: matched rows are logged as delete(old key) + upsert(new row), so an
    update that rewrites a key column is handled too."""
    old = _matched(state, cond)
    new = update_where(old, F.lit(True), set_exprs)
    return (old.withColumns({OP: F.lit("delete"), SEQ: F.lit(0).cast("bigint")})
            .unionByName(new.withColumns({OP: F.lit("upsert"), SEQ: F.lit(1).cast("bigint")})))


def delete_changes(state: DataFrame, cond) -> DataFrame:
    """M8 delete: the matched rows."""
    return _matched(state, cond)


def merge_changes(state: DataFrame, keys: Sequence[str], src: DataFrame, update: Mapping[str, str] | None = None,
                  insert: Mapping[str, str] | None = None) -> DataFrame:
    """M8 merge: only matched-and-updated and inserted rows are logged."""
    touched = src.select(*keys).distinct()
    return merge_into(state.join(touched, list(keys), "left_semi"), src, list(keys), update, insert)


def _matched(state: DataFrame, cond) -> DataFrame:
    return state.filter(F.coalesce(F.expr(cond) if isinstance(cond, str) else cond, F.lit(False)))
