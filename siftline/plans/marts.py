"""Derived tables over history and the run log, at a fixed ``as_of``.

Dates compare with midnight.  Orderings belong to whoever presents the rows,
so marts do not sort, except for the bounded top-10.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import rules as R
from siftline.functions import scores as S
from siftline.functions.freshness import age_in_days, days_back, parse_instant
from siftline.functions.keywords import words_in
from siftline.operators.ranking import MAX_RECOMMENDATIONS
from siftline.operators.scoring import ENRICH_MIN, FIT_MIN

AsOf = datetime | str | Column

# Columns of the wide marts.
CURRENT_COLUMNS = (
    "dedup_key", "source", "title", "company", "company_type",
    "company_type_confidence", "location", "experience_required",
    "salary_info", "posted_date", "deadline", "jd_language",
    "keyword_score", "ai_match_score", "ranking_score", "match_reasons",
    "positioning_advice", "url", "first_seen", "last_seen",
    "effective_date", "freshness_label", "canonical_key",
    "prefilter_passed", "application_status",
)
RECOMMENDED_COLUMNS = (
    "dedup_key", "source", "title", "company", "company_type",
    "company_type_confidence", "location", "experience_required",
    "salary_info", "posted_date", "deadline", "jd_language",
    "ai_match_score", "ranking_score", "match_reasons", "positioning_advice",
    "company_intro", "products_services", "business_model", "vision_goals",
    "ideal_candidate", "market_position", "team_function",
    "linkedin_search_url", "url", "freshness_label",
)
DAILY_COLUMNS = (
    "run_date", "jobs_scraped", "jobs_new", "jobs_matched", "jobs_enriched",
    "jobs_recommended", "jobs_prefilter_passed", "recommendation_rate",
    "api_cost_usd", "errors", "duration_seconds",
)


def _since(column: str, as_of: AsOf, days: int) -> Column:
    return F.col(column) >= days_back(as_of, days)


def _before(column: str, as_of: AsOf, days: int) -> Column:
    return F.col(column) < days_back(as_of, days)


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _pct_if(condition: Column) -> Column:
    return F.round(F.lit(100.0) * _count_if(condition) / F.count("*"), 1)


def _avg1(column: str | Column) -> Column:
    return F.round(F.avg(column), 1)


def jobs_current(seen: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Postings first seen in the last ``days`` days."""
    return seen.where(_since("first_seen", as_of, days)).select(*CURRENT_COLUMNS)


def daily_stats(runs: DataFrame) -> DataFrame:
    return runs.select(*DAILY_COLUMNS)


def recommendations_today(
    seen: DataFrame, as_of: AsOf, max_count: int = MAX_RECOMMENDATIONS
) -> DataFrame:
    """Best qualifying postings seen today, new or not."""
    return (
        seen.where((F.col("ai_match_score") >= FIT_MIN) & _since("last_seen", as_of, 0))
        .orderBy(F.col("ranking_score").desc(), F.col("dedup_key"))
        .limit(max_count)
        .select(*RECOMMENDED_COLUMNS)
    )


def cross_platform(seen: DataFrame) -> DataFrame:
    """Canonical keys found in more than one source.

    Counted per (key, source, company) first: that combines before the shuffle
    and breaks up a key with very many rows; the sets then see distinct values.
    """
    parts = (
        seen.where(F.col("canonical_key") != "")
        .groupBy("canonical_key", "source", "company")
        .agg(
            F.count("*").alias("n"),
            F.max("ai_match_score").alias("best"),
            F.min("first_seen").alias("first"),
        )
    )

    def listed(column: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(column)), ",")

    return (
        parts.groupBy("canonical_key")
        .agg(
            F.sum("n").alias("entry_count"),
            F.size(F.collect_set("source")).cast("bigint").alias("source_count"),
            listed("source").alias("sources"),
            listed("company").alias("company_variants"),
            F.max("best").alias("best_score"),
            F.min("first").alias("earliest_seen"),
        )
        .where("source_count > 1")
    )


def weekly_health(runs: DataFrame, as_of: AsOf) -> DataFrame:
    """One row on the runs of the last week, also when there were none."""
    failed = F.when(F.col("errors") != "", F.struct("run_date", "run_id", "errors"))
    notes = F.array_sort(F.collect_list(failed))
    return (
        runs.where(_since("run_date", as_of, 7))
        .agg(
            F.sum("jobs_scraped").alias("total_scraped"),
            F.sum("jobs_new").alias("unique_new"),
            F.sum("jobs_prefilter_passed").alias("prefilter_passed"),
            F.sum("jobs_recommended").alias("recommended"),
            _avg1("duration_seconds").alias("avg_duration_seconds"),
            F.round(F.sum("api_cost_usd"), 4).alias("total_api_cost"),
            F.count("*").alias("total_runs"),
            F.sum(F.when(F.col("errors") != "", 1).otherwise(0)).alias("error_runs"),
            F.when(F.size(notes) > 0, F.array_join(notes["errors"], "; ")).alias("failed_sources"),
        )
        .select(
            "total_scraped",
            "unique_new",
            "prefilter_passed",
            "recommended",
            S.ratio(F.col("prefilter_passed"), F.col("unique_new"), 3).alias("prefilter_rate"),
            S.ratio(F.col("recommended"), F.col("unique_new"), 3).alias("recommendation_rate"),
            "avg_duration_seconds",
            "total_api_cost",
            "total_runs",
            "error_runs",
            "failed_sources",
        )
    )


def weekly_source(seen: DataFrame, as_of: AsOf) -> DataFrame:
    """Volume, prefilter and fit per source; unreadable dates have no age."""
    return (
        seen.where(_since("first_seen", as_of, 7))
        .groupBy("source")
        .agg(
            F.count("*").alias("total"),
            _count_if(F.col("prefilter_passed") == 1).alias("passed_prefilter"),
            _count_if(F.col("ai_match_score") >= FIT_MIN).alias("recommended"),
            _avg1("ai_match_score").alias("avg_score"),
            _avg1(age_in_days(parse_instant(F.col("posted_date")), as_of)).alias("avg_posting_days"),
        )
    )


def weekly_company_type(seen: DataFrame, as_of: AsOf) -> DataFrame:
    return (
        seen.where(_since("first_seen", as_of, 7) & (F.col("company_type") != ""))
        .groupBy("company_type", F.col("company_type_confidence").alias("confidence"))
        .agg(
            F.count("*").alias("job_count"),
            _avg1("ai_match_score").alias("avg_ai_score"),
            _pct_if(F.col("ai_match_score") >= FIT_MIN).alias("pct_recommended"),
        )
    )


def weekly_experience(seen: DataFrame, as_of: AsOf) -> DataFrame:
    """By the experience text as written."""
    return (
        seen.where(_since("first_seen", as_of, 7) & (F.col("experience_required") != ""))
        .groupBy("experience_required")
        .agg(F.count("*").alias("job_count"), _avg1("ai_match_score").alias("avg_ai_score"))
    )


def weekly_trends(seen: DataFrame, runs: DataFrame, as_of: AsOf) -> DataFrame:
    """Four figures, this week against the week before; one scan per table."""

    def both(column: str, value: Column, how) -> list[Column]:
        this = how(F.when(_since(column, as_of, 7), value))
        prev = how(F.when(_before(column, as_of, 7), value))
        return [F.coalesce(x.cast("double"), F.lit(0.0)) for x in (this, prev)]

    def unstack(totals: DataFrame, names: list[str]) -> DataFrame:
        rows = [
            F.struct(
                F.lit(n).alias("metric"),
                F.col(f"{n}_this").alias("this_week"),
                F.col(f"{n}_prev").alias("prev_week"),
            )
            for n in names
        ]
        return totals.select(F.inline(F.array(*rows)))

    counted = {
        "total_scraped": "jobs_scraped", "unique_new": "jobs_new", "recommended": "jobs_recommended"
    }
    sums = []
    for name, column in counted.items():
        this, prev = both("run_date", F.col(column), F.sum)
        sums += [this.alias(f"{name}_this"), prev.alias(f"{name}_prev")]
    run_rows = unstack(runs.where(_since("run_date", as_of, 14)).agg(*sums), list(counted))

    this, prev = both("first_seen", F.col("ai_match_score"), _avg1)
    fit_rows = unstack(
        seen.where(_since("first_seen", as_of, 14) & (F.col("ai_match_score") > 0)).agg(
            this.alias("avg_score_this"), prev.alias("avg_score_prev")
        ),
        ["avg_score"],
    )
    now, before = F.col("this_week"), F.col("prev_week")
    return run_rows.unionByName(fit_rows).select(
        "metric",
        "this_week",
        "prev_week",
        S.change_pct(now, before).alias("change_pct"),
        S.direction(now, before).alias("direction"),
    )


def role_match(
    seen: DataFrame, as_of: AsOf, rules: R.Rules = R.ROLE_RULES, default: str = R.OTHER_ROLE
) -> DataFrame:
    """Fit per role family, told from the title."""
    return (
        seen.where(_since("first_seen", as_of, 7) & (F.col("ai_match_score") > 0))
        # Lower-cased in a step of its own, so once per title and not once per keyword.
        .withColumn("_title", F.lower("title"))
        .groupBy(R.first_rule(F.col("_title"), rules, default).alias("role_family"))
        .agg(
            F.count("*").alias("job_count"),
            _avg1("ai_match_score").alias("avg_ai_score"),
            _pct_if(F.col("ai_match_score") >= FIT_MIN).alias("pct_above_40"),
            _pct_if(F.col("ai_match_score") >= ENRICH_MIN).alias("pct_above_70"),
        )
    )


def skill_mentions(seen: DataFrame, as_of: AsOf, profile: R.Profile) -> DataFrame:
    """How often each profile keyword is among the reasons, and the fit then.

    A keyword listed twice in the profile counts twice, as it does in scoring.
    """
    words = profile.high + profile.medium
    names = F.array(*[F.lit(k) for k in words]).cast("array<string>")
    found = words_in(F.lower("match_reasons"), [k.lower() for k in words])
    return (
        seen.where(
            _since("first_seen", as_of, 7)
            & (F.col("match_reasons") != "")
            & (F.col("ai_match_score") >= FIT_MIN)
        )
        .select("ai_match_score", F.explode(found).alias("_place"))
        .groupBy(F.get(names, "_place").alias("skill"))
        .agg(
            F.count("*").alias("mention_count"),
            _avg1("ai_match_score").alias("avg_score_when_mentioned"),
        )
    )


def experience_bands(seen: DataFrame, as_of: AsOf) -> DataFrame:
    """Share and fit per experience band; bands without postings are left out."""
    bands = (
        seen.where(_since("first_seen", as_of, 7) & (F.col("experience_required") != ""))
        .groupBy(R.experience_band(F.col("experience_required")).alias("experience_range"))
        .agg(F.count("*").alias("job_count"), _avg1("ai_match_score").alias("avg_ai_score"))
    )
    # At most four rows are left here, so the total may be a one-partition window.
    total = F.sum("job_count").over(Window.partitionBy())
    return bands.select(
        "experience_range",
        "job_count",
        F.round(F.lit(100.0) * F.col("job_count") / total, 1).alias("pct_of_total"),
        "avg_ai_score",
    )


def spend_on(runs: DataFrame, as_of: AsOf) -> DataFrame:
    """Money spent by the runs of that day; 0 when there were none."""
    same_day = _since("run_date", as_of, 0) & _before("run_date", as_of, -1)
    return runs.where(same_day).agg(
        F.coalesce(F.sum("api_cost_usd"), F.lit(0.0)).alias("api_cost_usd")
    )
