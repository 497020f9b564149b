"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(
    app: str = "toolwatch", master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    On a cluster the master and most sizing come from spark-submit; the values
    below only fill gaps.  AQE coalesces/splits shuffle partitions at runtime and
    turns a sort-merge join into a broadcast only after measuring the small side.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.filterPushdown", "true")
        # Global MIN/MAX/COUNT over stored tables (as-of dates, retention cut-offs)
        # are answered from parquet footers instead of a scan.
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # Local mode runs every task inside the driver JVM: its heap is the executors' memory.
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there.  One is invented only
    in a local session without the setting; elsewhere its absence is an error, as
    executors do not see a folder of one machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or d
        if not d and sc.getCheckpointDir():
            return sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="toolwatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(d)
    else:
        spark.conf.set("spark.checkpoint.dir", d)
    return d
