"""The small notebook jobs as callable functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import versions as V
from ..operators.clean import stringify_time
from ..session import materialize
from ..sinks.files import save_table
from ..sources.rows import from_pandas


def adults(people: DataFrame, min_age: int = 30, age_col: str = "idade") -> DataFrame:
    """L3: people at or above an age (a pushed-down numeric filter)."""
    return people.filter(F.col(age_col) >= F.lit(min_age))


def extract_to_table(spark: SparkSession, pdf, table: str) -> int:
    """L4: a decoded extract (pandas) -> time-of-day columns as text -> managed table ->
    row count of the stored table."""
    save_table(from_pandas(spark, stringify_time(pdf)), table)
    return spark.table(table).count()


def versioned_walkthrough(spark: SparkSession) -> dict:
    """v0 overwrite 0..4, v1 overwrite 5..9, v2 update id+100 where even, v3 delete
    even, v4 merge 0..19 on id; returns the latest ids, the reads at v0 and v3 and the
    history operations. The log is written after every commit."""
    keys = ["id"]
    put = lambda log: materialize(log, "walkthrough")
    log = put(V.commit(None, spark.range(0, 5), "overwrite"))
    log = put(V.commit(log, spark.range(5, 10), "overwrite"))
    log = put(V.commit(log, V.update_changes(V.current(log, keys), "id % 2 = 0", {"id": "id + 100"}), "update"))
    log = put(V.commit(log, V.delete_changes(V.current(log, keys), "id % 2 = 0"), "delete"))
    log = put(V.commit(log, V.merge_changes(V.current(log, keys), keys, spark.range(0, 20)), "merge"))

    def ids(v=None):
        return sorted(r.id for r in V.as_of_version(log, keys, v).collect())

    hist = {r.version: r.operation for r in V.history(log).collect()}
    return {"latest": ids(), "v0": ids(0), "v3": ids(3), "history": hist}
