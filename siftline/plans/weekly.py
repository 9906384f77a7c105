"""The weekly report: seven data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siftline.functions import rules as R
from siftline.plans import marts as M


def weekly_report(
    seen: DataFrame,
    runs: DataFrame,
    profile: R.Profile,
    as_of: M.AsOf,
    role_rules: R.Rules = R.ROLE_RULES,
    other_role: str = R.OTHER_ROLE,
) -> dict[str, DataFrame]:
    return {
        "weekly_health": M.weekly_health(runs, as_of),
        "weekly_category_match": M.role_match(seen, as_of, role_rules, other_role),
        "weekly_company_type": M.weekly_company_type(seen, as_of),
        "weekly_skills": M.skill_mentions(seen, as_of, profile),
        "weekly_source_quality": M.weekly_source(seen, as_of),
        "weekly_trends": M.weekly_trends(seen, runs, as_of),
        "weekly_experience": M.experience_bands(seen, as_of),
    }
