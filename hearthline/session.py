"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work: it splits skewed join partitions,
# merges small shuffle partitions and turns a join into a broadcast only when
# the measured size of a side is under the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A one-machine session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("hearthline")
    settings = dict(SETTINGS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings["spark.driver.memory"] = "12g"
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset on
    a one-machine session (tests) a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="hearthline-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    target = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(target)
