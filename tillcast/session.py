"""Session construction and the checkpoint directory contract."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillcast", extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    AQE stays on so shuffle widths coalesce and skewed join partitions split at run
    time; the session time zone is UTC so dates never shift.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # The driver's status store holds past queries, their plans and tasks even with the web
        # page off: in a long session it keeps only the newest.
        "spark.sql.ui.retainedExecutions": "20",
        "spark.ui.retainedJobs": "100",
        "spark.ui.retainedStages": "100",
        "spark.ui.retainedTasks": "2000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's directory).
    Only a local-mode session without one (tests, a laptop) gets a fresh
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tillcast-ckpt-", dir=os.environ.get("TMPDIR")))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared (HDFS/S3/ABFS) folder")


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` once as a Parquet table in the shared checkpoint
    folder and read it back.

    Preferred to ``Dataset.checkpoint()``, which computes an uncached input twice
    (one job to count, one to write) and stores rows, not columns; the table is
    computed once, survives executor loss and is read back with column pruning.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tillcast-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
