"""Session defaults and shared scratch locations.

Scratch output (round-trip tables, quarantine during tests) goes under the
cluster's shared ``spark.checkpoint.dir``; a local directory is created only
when the session names none (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every lakeq job relies on: AQE (runtime broadcast of small sides,
# skew-join splitting, partition coalescing), UTC stamps, ANSI casts kept on
# (all lenient parsing goes through try_* functions), and partition columns
# read as strings so identifiers like '0420' survive.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "lakeq", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory. A local one is made only where none is set
    and all tasks run in this process; on a cluster it must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lakeq-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory path for a written table, under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakeq-scratch/{name}-{uuid.uuid4().hex[:12]}"
