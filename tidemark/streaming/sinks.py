"""Streaming sinks and bounded runs.

Appends are exactly-once through the checkpoint: a restart with the same checkpoint
resumes after the last committed batch and writes nothing twice. Checkpoints belong in
the shared folder named by ``spark.checkpoint.dir`` (see ``session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _trigger(w, trigger):
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    if trigger:
        return w.trigger(processingTime=trigger)
    return w


def stream_append(sdf: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow",
                  fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """K8: append a stream into a table directory with a checkpoint."""
    w = (sdf.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start(path)


def stream_console(sdf: DataFrame, checkpoint: str | None = None, trigger: str | None = None,
                   each_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """K9: print each micro-batch (``console``), or hand it to ``each_batch``
    (``foreachBatch``) - what tests use to observe batches."""
    w = sdf.writeStream.outputMode("append")
    w = w.foreachBatch(each_batch) if each_batch is not None else w.format("console")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def drain(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query to finish (an ``availableNow`` run ends by itself); re-raise a query
    failure. With ``timeout`` seconds an unfinished query is stopped and False returned - for endless
    sources only: what it wrote by then is not the whole input."""
    done = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    if not done:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream failed: {exc}")
    return bool(done)
