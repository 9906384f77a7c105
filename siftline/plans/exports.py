"""CSV exports, sorted the way they are read."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.rules import EXPERIENCE_BANDS, Profile
from siftline.plans import marts as M
from siftline.plans.weekly import weekly_report
from siftline.sources.csv_sink import write_csv_file


# What an export is sorted by, the first column descending; ties go by the
# others, so that an export is the same on every run.
SORTED_BY = {
    "jobs_current": ("ai_match_score", "dedup_key"),
    "daily_stats": ("run_date", "run_id"),
    "recommendations_today": ("ranking_score", "dedup_key"),
    "cross_platform": ("best_score", "canonical_key"),
    "weekly_experience_labels": ("job_count", "experience_required"),
    "weekly_category_match": ("job_count", "role_family"),
    "weekly_company_type": ("avg_ai_score", "company_type", "confidence"),
    "weekly_skills": ("mention_count", "skill"),
    "weekly_source_quality": ("total", "source"),
}


def export_order(name: str, df: DataFrame) -> list[Column]:
    """Sort keys of a data set; none where its order is of no account."""
    if name == "weekly_experience":
        bands = F.array(*[F.lit(b) for b in EXPERIENCE_BANDS])
        return [F.array_position(bands, F.col("experience_range"))]
    first, *rest = [c for c in SORTED_BY.get(name, ()) if c in df.columns] or [None]
    return [F.col(first).desc(), *[F.col(c) for c in rest]] if first else []


def _ordered(name: str, df: DataFrame) -> DataFrame:
    order = export_order(name, df)
    return df.orderBy(*order) if order else df


def daily_exports(seen: DataFrame, runs: DataFrame, as_of: M.AsOf) -> dict[str, DataFrame]:
    return {
        "jobs_current": M.jobs_current(seen, as_of),
        "daily_stats": M.daily_stats(runs),
        "recommendations_today": M.recommendations_today(seen, as_of),
    }


def ordered_marts(seen: DataFrame, as_of: M.AsOf) -> dict[str, DataFrame]:
    """The marts that have an order but are in no export."""
    return {
        "cross_platform": M.cross_platform(seen),
        "weekly_experience_labels": M.weekly_experience(seen, as_of),
    }


def exports_due(
    seen: DataFrame, runs: DataFrame, profile: Profile, as_of: datetime | str
) -> dict[str, DataFrame]:
    """The daily exports, and on a Sunday the weekly report as well."""
    due = daily_exports(seen, runs, as_of)
    day = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    if day.isoweekday() == 7:
        due |= weekly_report(seen, runs, profile, as_of)
    return due


def write_exports(frames: Mapping[str, DataFrame], folder: str) -> list[str]:
    """One CSV file per data set, named after it; empty ones are left out.  Returns what was written."""
    return [
        name
        for name, df in frames.items()
        if write_csv_file(_ordered(name, df), f"{folder.rstrip('/')}/{name}.csv")
    ]
