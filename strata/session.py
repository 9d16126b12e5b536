"""Session helpers.

On a cluster the session already exists and carries its own settings; these
helpers only fill in what is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("STRATA_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions is None:
        shuffle_partitions = 8
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local master, where driver and executors share one disk, may do
    without either: a scratch folder is then made once per application. On any
    other master a missing setting is an error, because executors would write
    to disks that nobody else can read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    have = spark.sparkContext.getCheckpointDir()
    if have is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        have = spark.sparkContext.getCheckpointDir()
    return have


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    Computes ``df`` exactly once (an eager reliable ``checkpoint()`` of an
    unpersisted plan computes it twice), survives executor loss (the files
    are on shared storage) and gives later stages a columnar, prunable scan
    instead of a row RDD.
    """
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
