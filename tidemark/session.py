"""Session settings every plan in this package relies on.

* Session time zone is UTC: instants are stored and printed in UTC and the
  business date is derived explicitly (``functions.timeutil.business_date``).
* ANSI mode on, so a bad cast fails instead of silently producing NULL; the
  contract code uses ``try_*`` functions where a bad value must be labelled.
* AQE on: it coalesces small shuffle partitions and splits skewed join
  partitions at run time, so library code never fixes partition counts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the default type of written instants has no ranges in Parquet, so no window could prune by it
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Rows here are often CPU-heavy (JSON parse, hashing) but small in bytes;
    # a lower floor keeps several tasks per stage on small inputs.  At cluster
    # scale partitions are far above this floor, so it changes nothing there.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the package settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    cluster manager and AQE decide.  Tests pass ``local[*]`` and a small
    partition count.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written state (commit logs, checkpoints, lakes).

    Read from ``spark.checkpoint.dir`` (the setting a cluster names).  Where it
    is unset a local session gets a fresh scratch folder, registered so that
    every later call agrees on it; on a cluster, where executors would write to
    their own disks, the missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # some sessions refuse core settings at run time
            pass
        spark.sparkContext.setCheckpointDir(current)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")
