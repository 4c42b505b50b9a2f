"""tidemark: market and macro time-series analytics expressed as Spark DataFrame plans.

Every operator is a plain function from DataFrames to a DataFrame; nothing wraps the
SparkSession. Sub-packages:

* ``sources``   - readers (rows, files, landed extracts, catalog tables)
* ``sinks``     - writers (files, managed tables, JDBC options, write-if-any)
* ``operators`` - cleansing, dedupe, returns, as-of joins, mutation, versions,
                  incremental loads and data tests
* ``functions`` - column-level helpers and fetch-window date arithmetic
* ``plans``     - the user-visible jobs (silver/gold, equities, notebooks) and the
                  query registry used by ``__spark_entry__``
* ``streaming`` - rate/table stream sources and checkpointed stream sinks
"""

__version__ = "0.1.0"

from .operators.asof import asof_left
from .operators.clean import (after, cast_columns, cleanse_sentinel, convert_or_quarantine, drop_null_keys,
                              keep, map_values, rename, with_audit)
from .operators.incremental import high_watermark, newer_than_target
from .operators.mutate import changed_rows, delete_where, merge_into, replace_by_key, update_where, upsert_changed
from .operators.quality import check_not_null, check_rows, check_unique, pk_conflicts
from .operators.reshape import dedupe, wide_to_long
from .operators.returns import with_previous, with_returns, with_variation
from .operators.versions import as_of_version, commit, current, history

__all__ = [
    "asof_left", "after", "cast_columns", "cleanse_sentinel", "convert_or_quarantine", "drop_null_keys", "keep",
    "map_values", "rename", "with_audit", "high_watermark", "newer_than_target", "changed_rows", "delete_where",
    "merge_into", "replace_by_key", "update_where", "upsert_changed", "check_not_null", "check_rows",
    "check_unique", "pk_conflicts", "dedupe", "wide_to_long", "with_previous", "with_returns", "with_variation",
    "as_of_version", "commit", "current", "history",
]
