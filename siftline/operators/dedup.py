"""Keep-first, per-source caps and detection of new keys against history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.freshness import as_timestamp


def _first_n(df: DataFrame, by: Sequence[str], order: str, n: int) -> DataFrame:
    # Filtering the row number lets Spark drop the surplus before the shuffle
    # (WindowGroupLimit), so a hot key sends at most n rows per map task.
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")


def keep_first(df: DataFrame, key: str = "dedup_key", order: str = "seq") -> DataFrame:
    """The earliest row of every key."""
    return _first_n(df, [key], order, 1)


def cap_per_source(df: DataFrame, n: int = 50, order: str = "seq") -> DataFrame:
    """The first ``n`` rows of every source."""
    return _first_n(df, ["source"], order, n)


def unseen(batch: DataFrame, seen: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows of ``batch`` whose key is not in history."""
    return batch.join(seen.select(key), key, "left_anti")


def already_seen(batch: DataFrame, seen: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows of ``batch`` whose key is in history."""
    return batch.join(seen.select(key), key, "left_semi")


def new_rows(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """First sightings: the earliest row of each key that history lacks."""
    return unseen(keep_first(batch), seen)


def touch(seen: DataFrame, batch: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """History with ``last_seen`` moved to ``as_of`` for keys in ``batch``; no inserts."""
    hits = batch.select("dedup_key").distinct().withColumn("_hit", F.lit(True))
    moved = F.when(F.col("_hit"), as_timestamp(as_of)).otherwise(F.col("last_seen"))
    return (
        seen.join(hits, "dedup_key", "left")
        .withColumn("last_seen", moved)
        .select(*seen.columns)
    )


def latest_sightings(seen: DataFrame, sightings: DataFrame) -> DataFrame:
    """History with ``last_seen`` brought up to date from an append-only sight log.

    The log (``dedup_key, seen_at``) is what a daily run adds; wide history rows
    are never rewritten just because a posting was seen again.
    """
    last = sightings.groupBy("dedup_key").agg(F.max("seen_at").alias("_seen_at"))
    return (
        seen.join(last, "dedup_key", "left")
        .withColumn("last_seen", F.greatest("last_seen", "_seen_at"))
        .select(*seen.columns)
    )
