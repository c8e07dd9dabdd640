"""Session construction and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans at runtime (partition
# coalescing, skew-join splitting, broadcast conversion); the session time zone
# is pinned so that epoch arithmetic never depends on the machine.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "adtrail", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is read
    from the session (or from ``setCheckpointDir``).  Only a local master, where
    driver and executors are one process, may run without it: then a folder of
    this process is used.  On any other master a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set on master {master!r}: staged tables need a folder "
                "that the driver and every executor share")
        base = _local_dir()
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


@functools.cache
def _local_dir() -> str:
    """One folder per process, for local masters only."""
    return tempfile.mkdtemp(prefix="adtrail-")


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unused sub-folder of the shared folder (one per run)."""
    return shared_dir(spark, *parts, uuid.uuid4().hex)
