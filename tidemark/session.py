"""Session helpers: building a session for tests/bench and finding shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs. On a cluster the submitter's config wins; this only sets
    what a test or bench needs and never starts the web UI."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that folder is the shared location every executor can reach; we only
    pick our own (a fresh local temp folder) when the session has none, as in tests.
    Works on classic and Spark Connect sessions (no SparkContext needed)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder (for round trips,
    stream checkpoints and materialised intermediates)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemark-scratch/{tag}-{uuid.uuid4().hex}"


def materialize(df, tag: str = "layer", partition_by=()):
    """Write ``df`` once as parquet under the shared checkpoint folder (optionally partitioned)
    and return a frame reading it back.

    Used where a layer is a stored table in the real job (raw extracts, silver) and is
    read several times by the next step: the plan below is cut (no recomputation, no
    long lineage) and the files survive the loss of any executor. One write job, unlike
    ``checkpoint(eager=True)`` which computes the plan twice. Never a local checkpoint."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spill-aware settings for a cluster run, from the input size and the cluster shape.

    * scan splits of ``target_partition_bytes`` (``maxPartitionBytes``);
    * initial shuffle partitions = input / target, at least 2 waves of the cluster's
      cores, so each reduce task's share fits in its memory; AQE then coalesces small
      partitions to the same advisory size and splits skewed join partitions;
    * broadcasts stay at the default threshold: AQE broadcasts a side only after
      measuring it.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
