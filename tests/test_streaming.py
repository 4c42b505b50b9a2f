"""Rate stream append with checkpoint, table as stream, restarts."""

import time

from tidemark.session import scratch_path
from tidemark.streaming.sinks import drain, stream_append, stream_console
from tidemark.streaming.sources import rate_source, table_stream


def test_rate_stream_append_and_restart(spark):
    out, ckpt = scratch_path(spark, "rate-out"), scratch_path(spark, "rate-ckpt")
    def run(min_rows):
        q = stream_append(rate_source(spark, rows_per_batch=5), out, ckpt, trigger="0 seconds")
        deadline = time.time() + 60      # an infinite source: bounded wait, then stop
        while time.time() < deadline and sum(p["numInputRows"] for p in q.recentProgress) < min_rows:
            q.awaitTermination(0.5)
        q.stop()

    run(15)
    n1 = spark.read.parquet(out).count()
    assert n1 >= 15 and n1 % 5 == 0
    run(10)                               # restart on the same checkpoint: resumes after the last batch
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert len(ids) > n1 and ids == list(range(len(ids)))   # value AS id: no gaps, no duplicates


def test_table_stream_copy_then_restart_adds_nothing(spark, tmp):
    src = f"{tmp}/src"
    spark.range(0, 10).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out, ckpt = scratch_path(spark, "copy-out"), scratch_path(spark, "copy-ckpt")
    assert drain(stream_append(table_stream(spark, src, schema), out, ckpt), timeout=120)
    assert spark.read.parquet(out).count() == 10
    drain(stream_append(table_stream(spark, src, schema), out, ckpt), timeout=120)
    assert spark.read.parquet(out).count() == 10
    spark.range(10, 15).write.mode("append").parquet(src)     # new files are picked up once
    drain(stream_append(table_stream(spark, src, schema), out, ckpt), timeout=120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))


def test_console_sink_via_foreach_batch(spark, tmp):
    src = f"{tmp}/src2"
    spark.range(0, 4).write.parquet(src)
    seen = []
    q = stream_console(table_stream(spark, src, spark.read.parquet(src).schema),
                       checkpoint=scratch_path(spark, "console-ckpt"), trigger="availableNow",
                       each_batch=lambda df, epoch: seen.append(df.count()))
    drain(q, timeout=120)
    assert sum(seen) == 4


def test_console_format_runs_and_drains(spark, tmp):
    src = f"{tmp}/src3"
    spark.range(0, 3).write.parquet(src)
    q = stream_console(table_stream(spark, src, spark.read.parquet(src).schema),
                       checkpoint=scratch_path(spark, "console-fmt-ckpt"), trigger="availableNow")
    assert drain(q, timeout=120)
    assert q.lastProgress["numInputRows"] == 3
