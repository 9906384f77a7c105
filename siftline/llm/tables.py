"""Given tables, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every contract here, and what it leaves as words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _run_folder(spark: SparkSession) -> str:
    """Folder of this application under ``spark.checkpoint.dir``.

    Where the session names none (tests, a laptop), it lies beside the warehouse.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        top = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{top.rstrip('/')}/llm/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table."""
    return f"{_run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_work(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it when its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and go on from the written table.

    Cuts the lineage, outlives lost executors, and later steps read only the
    columns they need.
    """
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def boxed(docs: DataFrame) -> Column:
    """The whole row as the column ``doc``, so that its columns clash with none that is added."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
