"""Weekly marts from daily states that batches, late rows and corrections have added to."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog import q_marts  # noqa: F401  (its SQL is taken up here)
from siftline.catalog.fixtures import AS_OF
from siftline.catalog.registry import SQL, query
from siftline.plans import rollup
from siftline.session import stage_path


def _merged(t, mart):
    """Two batches of rows in no order of days; the first with scores that a third corrects."""
    root = stage_path(t.spark, "states")
    first = t.seen.where(F.pmod(F.hash("dedup_key"), F.lit(2)) == 0)
    wrong = first.withColumn("ai_match_score", F.lit(99.0))
    rollup.add_states(rollup.day_states(wrong, mart), root, mart, 0)
    rollup.add_states(rollup.day_states(t.seen.where(F.pmod(F.hash("dedup_key"), F.lit(2)) == 1), mart), root, mart, 1)
    corrected = rollup.day_states(wrong, mart, sign=-1).unionByName(rollup.day_states(first, mart))
    for _ in range(2):  # run twice
        rollup.add_states(corrected, root, mart, 2)
    return rollup.weekly(rollup.read_states(t.spark, root, mart), mart, AS_OF)


@query("weekly_source_states", SQL["weekly_source"])
def weekly_source_states(t):
    return _merged(t, "weekly_source")


@query("weekly_company_type_states", SQL["weekly_company_type"])
def weekly_company_type_states(t):
    return _merged(t, "weekly_company_type")


@query("weekly_experience_states", SQL["weekly_experience"])
def weekly_experience_states(t):
    return _merged(t, "weekly_experience")
