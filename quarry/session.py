"""Spark session helpers.

The library never creates a session behind the user's back: every public
operator takes DataFrames. These helpers exist for tests, the benchmark and
the driver entry point.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session defaults that every job of this package assumes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-k per group (row_number <= k) gets a partial limit before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "quarry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.quarry.inputPartitions"] = str(shuffle_partitions)  # few small files on one machine
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    On a cluster the operator names it in ``spark.checkpoint.dir``; we read it
    from the session. Where it is unset we make one, on a local master only: on a
    cluster every executor would write to a disk of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
