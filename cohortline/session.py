"""Session construction and shared-storage helpers.

Operators never create sessions; they take DataFrames. This module is for
entry points (tests, bench, jobs). On a cluster the session already exists
and carries the cluster's own settings; ``configure`` only fills in what is
missing, it never overrides.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones; the reports'
# hot keys (a null raw policy id, a popular visitor) are handled there.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cohortline") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster).

    ``spark.checkpoint.dir`` is left alone when the environment sets it;
    ``checkpoint_dir`` supplies a scratch folder only when it is missing.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("COHORTLINE_DRIVER_MEM", "8g"))
        # Local inputs are megabytes, below AQE's default 1 MB floor for a
        # coalesced partition, which would fold every post-shuffle stage into
        # one task on an 8-core machine. A lower floor keeps the cores busy;
        # clusters keep their own (larger) settings.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Runtime settings ``configure`` may fill in on a session it did not build.
_RUNTIME_KEYS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
)


def configure(spark: SparkSession) -> SparkSession:
    """Turn on AQE (runtime re-planning, coalescing, skew splitting) where the
    session has not set it explicitly. Nothing else is touched: the session
    time zone does not matter to the reports (all timestamps are zone-less)."""
    for key in _RUNTIME_KEYS:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, _DEFAULTS[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster) or from the folder
    the application set. Only a local session may go without: it gets a
    scratch folder of its own, recorded in the session. On any other master a
    folder of the driver would be invisible to the executors, so that is an
    error.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortline-ckpt-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")
