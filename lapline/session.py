"""Session helpers.

The library never builds its own cluster settings into operators: it reads the
session it is given.  ``local_session`` exists for tests, the bench and the
examples only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "lapline", event_log_dir: str | None = None) -> SparkSession:
    """A local-mode session with AQE on and the UI off (tests, bench).

    Shuffles start at two partitions per core and AQE coalesces them, keeping
    the parallelism of the cores, as in ``cluster_conf``.
    With ``event_log_dir`` Spark writes its event log there (stage and task
    times without the web UI).
    """
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 2 * n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as it is; only when
    the setting is absent, in local mode, a fresh scratch folder is made.
    Off local mode that is an error: no other machine would see the folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lapline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cluster_conf(executors: int, cores_per_executor: int, input_tb: float = 100.0) -> dict:
    """Settings this engine is designed around, for a cluster run (pass to ``spark-submit --conf``).

    * AQE on, with partition coalescing and skew-join splitting: per-race and
      per-competition aggregates are partial, and a skewed anti/semi join side
      is split at run time.
    * Shuffle partitions start at ~3 waves of the cluster's cores (or one per
      ~256 MB of input, whichever is larger) and AQE coalesces them to
      ``advisoryPartitionSizeInBytes``.
    * Scan splits of 128 MB; result-sheet and document tables have wide rows,
      so fewer rows per split keep the in-row parse (arrays of lines) within
      executor memory.
    * The broadcast threshold stays at a fixed 32 MB: AQE compares it with
      the measured size of a join side, so nothing is broadcast unchecked.
    """
    cores = executors * cores_per_executor
    by_input = int(input_tb * 1024 * 1024 / 256)          # one partition per ~256 MB of input
    partitions = max(3 * cores, by_input)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
        "spark.sql.parquet.filterPushdown": "true",
    }
