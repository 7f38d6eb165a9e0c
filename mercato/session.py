"""Spark session helpers.

The library never hard-codes cluster settings: it reads what the session was
started with and only fills in defaults that are unset (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins (broadcast when a side turns
# out small, split skewed partitions) and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(app: str = "mercato", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    b = SparkSession.builder.appName(app)
    b = b.master(master or os.environ.get("MERCATO_MASTER", "local[8]"))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Fill unset defaults on an existing session (never overrides)."""
    for k, v in _DEFAULTS.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
