"""Session settings shared by tests, the benchmark and scripts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "formtide") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitter's session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Hash joins instead of sorts where adaptive execution has seen that every partition is this small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only where that is unset and the master is ``local`` (tests on one machine) a temporary folder is made and set. On a
    cluster, executors would each write to their own disk, so there an unset folder is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(current)
        return current
    if context.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="formtide-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    It is computed once, survives lost executors, is read by column, and keeps plans small that use it often.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
