"""Session settings the library relies on, and the shared folder for written tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the size-dependent choices: it broadcasts a join side only
# when its measured size is below autoBroadcastJoinThreshold, splits skewed join
# partitions, and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even if the next step then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(app: str = "martloom", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own session."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        # small test data would otherwise end up in one task after the first shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; on one machine, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
