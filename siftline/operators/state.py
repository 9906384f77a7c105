"""Keyed history, run log and schema growth, as whole-table transformations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.freshness import as_timestamp, iso_text
from siftline.functions.text import cut
from siftline.schemas import RUNS, SEEN, SEEN_BASE, UPDATED_COLUMNS, ColumnSpec


def add_missing_columns(df: DataFrame, spec: Sequence[ColumnSpec]) -> DataFrame:
    """Add the columns of ``spec`` that ``df`` lacks, filled with their default."""
    present = set(df.columns)
    return df.select(
        "*",
        *[
            F.lit(default).cast(kind).alias(name)
            for name, kind, default in spec
            if name not in present
        ],
    )


def first_sight(
    rows: DataFrame, as_of: datetime | str | Column, keep: Sequence[str] = ()
) -> DataFrame:
    """History rows for new postings: identity, times, and defaults for the rest.

    Columns named in ``keep`` are carried along, for a later join.
    """
    now = as_timestamp(as_of)
    identity = [name for name, _, _ in SEEN_BASE[:6]]
    known = rows.select(*identity, *keep, now.alias("first_seen"), now.alias("last_seen"))
    return add_missing_columns(known, SEEN).select(*[name for name, _, _ in SEEN], *keep)


def add_keys(rows: DataFrame, table: str, buckets: int, **options: str) -> None:
    """Add the keys of ``rows`` to a key table laid out for the daily new-key join.

    The table is bucketed by ``dedup_key``, so that :func:`~siftline.operators.dedup.unseen`
    shuffles the batch to it and leaves the whole of history where it is.
    """
    writer = rows.select("dedup_key").write.mode("append").options(**options)
    writer.bucketBy(buckets, "dedup_key").sortBy("dedup_key").saveAsTable(table)


def update_columns(
    updates: DataFrame, as_of: datetime | str | Column, kept_text: int | None = None
) -> dict[str, Column]:
    """What an update gives to history, by column, in terms of the columns of ``updates``.

    Identity, first sight, status and notes are left alone.  Job texts are kept
    whole, or cut to ``kept_text`` code points.
    """
    given = {c: F.col(c) for c in UPDATED_COLUMNS if c in updates.columns}
    new = dict(given)
    if "jd_text" in new and kept_text is not None:
        new["jd_text"] = cut(new["jd_text"], kept_text)
    if {"effective_date", "posted_date", "scraped_at"} <= set(given):
        new["effective_date"] = F.coalesce(
            F.nullif(given["effective_date"], F.lit("")),
            F.nullif(given["posted_date"], F.lit("")),
            iso_text(given["scraped_at"]),
        )
    if "ai_match_score" in new:
        new["match_score"] = given["ai_match_score"]
    new["last_seen"] = as_timestamp(as_of)
    return new


def apply_updates(
    seen: DataFrame,
    updates: DataFrame,
    as_of: datetime | str | Column,
    kept_text: int | None = None,
) -> DataFrame:
    """Overwrite the processed columns of history rows that ``updates`` has.

    Keys that history lacks are ignored.  Columns missing from ``updates`` keep
    their value.
    """
    given = {c: v for c, v in update_columns(updates, as_of, kept_text).items() if c in seen.columns}
    fresh = updates.select("dedup_key", F.struct(*[v.alias(c) for c, v in given.items()]).alias("_new"))
    hit = F.col("_new").isNotNull()
    return seen.join(fresh, "dedup_key", "left").select(
        *[
            F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
            for c in seen.columns
        ]
    )


def set_score(seen: DataFrame, scores: DataFrame) -> DataFrame:
    """Overwrite ``match_score`` from ``scores(dedup_key, score)`` where there is one."""
    given = scores.select("dedup_key", F.col("score").alias("_score"))
    return (
        seen.join(given, "dedup_key", "left")
        .withColumn("match_score", F.coalesce("_score", "match_score"))
        .select(*seen.columns)
    )


def replace_rows(
    table: DataFrame, updates: DataFrame, key: str, newest: str | None = None
) -> DataFrame:
    """Rows of ``updates`` take the place of those with the same key, or are added.

    One row per key: among several updates of a key the one with the largest
    ``newest`` column wins, and the largest row where that ties or none is named.
    """
    row = F.struct(*table.columns)
    last = F.col(newest) if newest else F.lit(0)
    ranked = table.select(F.lit(0).alias("_new"), last.alias("_last"), key, row.alias("_row")).unionByName(
        updates.select(*table.columns).select(F.lit(1).alias("_new"), last.alias("_last"), key, row.alias("_row"))
    )
    best = F.max(F.struct("_new", "_last", "_row"))["_row"]
    return ranked.groupBy(key).agg(best.alias("_row")).select("_row.*")


def next_run_id(runs: DataFrame) -> DataFrame:
    return runs.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("bigint").alias("run_id"))


def number_run(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """One row of run metrics with the next free ``run_id`` of the log."""
    rows = metrics.unionByName(next_run_id(runs), allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def run_row(metrics: DataFrame) -> DataFrame:
    """Complete a run's counts with defaults and the derived recommendation rate."""
    rate = F.when(
        F.col("jobs_new") > 0, F.col("jobs_recommended") / F.col("jobs_new")
    ).otherwise(0.0)
    return add_missing_columns(metrics.withColumn("recommendation_rate", rate), RUNS).select(
        *[F.col(name).cast(kind) for name, kind, _ in RUNS]
    )
