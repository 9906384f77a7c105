"""Session settings the operators were planned for, and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a large cluster; a caller's own settings win.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Call sites of column expressions are of use in a notebook; in a job they
    # only slow down the building of plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "siftline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where the session names none, it lies beside the tables of the warehouse,
    which is on shared storage by nature.  Never a folder of one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/siftline/{spark.sparkContext.applicationId}"


def drop_stages(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it when its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and go on from the written table.

    Cuts the lineage, survives the loss of executors, and, being columnar, lets
    each later step read just the columns it needs.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
