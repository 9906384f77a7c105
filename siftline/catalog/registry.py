"""Name -> Spark query, and name -> SQL giving the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)``; ``sql`` may use the common tables of ``fixtures``."""

    def register(fn):
        from siftline.catalog.fixtures import Tables, expand

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = expand(sql)
        return run

    return register


def stamp(column: str):
    """Timestamp as text, so that engines need not agree on a timestamp type."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def stamp_sql(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.split('.')[-1]}"
