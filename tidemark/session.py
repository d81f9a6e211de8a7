"""Spark session helpers.

On a cluster the session comes from the launcher; `build_session` is for tests and
the bench. `checkpoint_dir` reads `spark.checkpoint.dir` from the running session and fails
when a cluster leaves it unset; a single-process session (master local[...]), whose driver and
executors are one machine, then gets a folder of its own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", checkpoint: str | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "6g"))
    )
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cutting lineage (checkpoint() or written tables).

    Uses the cluster's `spark.checkpoint.dir`. Without it, tables written by one executor
    would be lost to the others, so this raises, except in a single-process session.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
        sc_dir = sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        sc, sc_dir = None, None
    if conf_dir or sc_dir:
        if sc is not None and sc_dir is None:
            sc.setCheckpointDir(conf_dir)      # the cluster's shared folder, set at runtime
        return sc_dir or conf_dir
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that the driver "
                           "and all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def cluster_conf(total_input_tb: float = 100.0, executors: int = 1000, cores_per_executor: int = 8,
                 executor_memory_gb: int = 32, largest_shuffle_tb: float = 20.0) -> dict[str, str]:
    """Spark settings for the production scale (defaults: 100 TB over 1000 executors).

    The numbers follow from the data volume, not from local tests:
    * scan splits of 512 MB keep a 100 TB scan at ~200k tasks (about 25 waves of 8k cores);
    * AQE coalesces small shuffle partitions but never splits large ones, so the initial
      partition count comes from the largest expected shuffle divided by the 256 MB
      reducer target: 20 TB (a full-width dimension or target after column pruning and
      map-side aggregation) / 256 MB ~ 80k partitions. 256 MB per reducer fits well inside
      a core's execution memory (32 GB / 8 cores, ~60 % usable), so sorts and hash tables
      spill rarely, and smaller shuffles are coalesced down by AQE;
    * skewed partitions over 4x the median and 1 GB are split by the skew-join rule;
    * runtime broadcast only below 64 MB of measured shuffle data; the planner's static
      threshold stays at 32 MB so that estimates alone never broadcast large sides;
    * dynamic partition overwrite for bucket-scoped rewrites.
    """
    advisory_mb = 256
    initial = max(2 * executors * cores_per_executor, int(largest_shuffle_tb * 1024 * 1024 / advisory_mb))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.executor.memory": f"{executor_memory_gb}g",
        "spark.executor.cores": str(cores_per_executor),
    }
