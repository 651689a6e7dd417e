"""Session construction for tests, the bench and local runs.

Library functions never create a session; they take DataFrames.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings for the production cluster (~100 TB of input, ~1000 executors).
# Every shuffle in the tag jobs follows a partial aggregation, so shuffles are
# far smaller than the input; AQE coalesces the generous initial partition
# count down to ~256 MB partitions and splits skewed join partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once the checkpointed data is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_session(app: str = "tagsmith", extra: dict | None = None) -> SparkSession:
    """Session for a cluster submit: the master, executors and
    ``spark.checkpoint.dir`` come from the submit configuration; this adds
    the partition sizing above (explicit ``extra`` settings win)."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not spark.sparkContext.getCheckpointDir():
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tagsmith", extra: dict | None = None) -> SparkSession:
    """Local session (tests, bench): ``local[N]`` with N shuffle partitions."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TAGSMITH_DRIVER_MEM", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that all executors share and is
    used as is.  Where it is unset, a local session (tests, bench) gets a
    scratch folder and a cluster session raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tagsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
