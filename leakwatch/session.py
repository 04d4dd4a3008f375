"""Spark session settings shared by the library, tests and the bench.

The library never creates its own cluster settings when a session already
exists: callers on a cluster pass their session in. ``get_session`` is for
local runs (tests, bench) and pins the settings the operators rely on:
UTC session time zone, ANSI mode, adaptive query execution with skew-join
splitting, and no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs for correct results (time zone) or for the
# skew handling the operators count on (AQE skew join, partition coalescing).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "leakwatch",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a local session with the library's settings."""
    master = master or os.environ.get("LEAKWATCH_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(REQUIRED_CONF)
    conf.update(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # One JVM: every task is process-local, so waiting for a "better"
            # slot only idles cores (it slowed the per-tree GBT stages by 30 %).
            "spark.locality.wait": "0",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.driver.memory": os.environ.get("LEAKWATCH_DRIVER_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
            # Checkpoints go when nothing refers to them any more.
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        }
    )
    if extra_conf:
        conf.update(extra_conf)
    if "spark.checkpoint.dir" not in conf:
        if master.startswith("local["):  # a cluster names its shared folder in its own conf
            conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="leakwatch-ckpt-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators rely on on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and only read here; an
    unset one is an error. In local mode a fresh folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="leakwatch-ckpt-")
    sc.setCheckpointDir(current)
    return current


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 3 per core) and AQE coalesces them at run time to the
    advisory size, so partitions fit executor memory without spilling; skew
    splitting kicks in for partitions 5x the median and above 256 MB.
    """
    partitions = max(3 * total_cores, input_bytes // target_partition_bytes)
    return {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
