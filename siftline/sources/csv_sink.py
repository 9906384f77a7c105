"""CSV export with one-line cells."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siftline.functions.text import csv_cell


def csv_cells(df: DataFrame) -> DataFrame:
    """All columns as one-line text."""
    return df.select(*[csv_cell(F.col(c)).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Write ``df`` as CSV with a header under ``path``; an empty frame leaves
    an earlier export in place when ``skip_empty``.  Returns whether it wrote.

    The plan runs once: rows are counted while they are written beside ``path``,
    and the folder takes its place, or goes, afterwards.
    """
    seen = Observation()
    beside = f"{path.rstrip('/')}.writing"
    csv_cells(df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").csv(
        beside, header=True, escape='"', emptyValue="", encoding="UTF-8"
    )
    spark = df.sparkSession
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    if skip_empty and not seen.get["rows"]:
        files.delete(new, True)
        return False
    # The old folder goes when the new one has its place.
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{uuid.uuid4().hex}.old")
    if files.exists(old):
        files.rename(old, aside)
    files.rename(new, old)
    files.delete(aside, True)
    return True


_MARK = "﻿"


def write_csv_file(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Write ``df`` as the one file ``path``: UTF-8 with a byte-order mark and a header, rows in their order.

    Rows are sorted in parallel and written by one task, since it is one file.  It
    is written beside ``path`` and takes its place in one step, so that a reader
    finds the old file or the new one, and a write that fails leaves the old one.
    An empty frame leaves it, too, when ``skip_empty``.  Returns whether it wrote.
    """
    spark, seen = df.sparkSession, Observation()
    beside = f"{path}.{uuid.uuid4().hex}.writing"
    cells = csv_cells(df)
    marked = cells.withColumnRenamed(cells.columns[0], _MARK + cells.columns[0])
    fs = spark._jvm.org.apache.hadoop.fs
    folder, target = fs.Path(beside), fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        marked.observe(seen, F.count(F.lit(1)).alias("rows")).coalesce(1).write.csv(
            beside, header=True, escape='"', emptyValue="", encoding="UTF-8",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        if skip_empty and not seen.get["rows"]:
            return False
        (part,) = files.globStatus(fs.Path(f"{beside}/part-*"))
        context = fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        options[0] = fs.Options.Rename.OVERWRITE
        context.rename(part.getPath(), context.makeQualified(target), options)
        return True
    finally:
        files.delete(folder, True)
