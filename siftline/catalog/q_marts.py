"""Marts, and the orderings and predicates they stand for."""

from __future__ import annotations

from siftline.catalog import twins as X
from siftline.catalog.fixtures import AS_OF, CLOCK, PROFILE, ROLES
from siftline.catalog.registry import query, stamp, stamp_sql
from siftline.functions.rules import EXPERIENCE_RULES, OTHER_BAND
from siftline.plans import marts as M

WEEK = f"first_seen >= CAST({CLOCK} AS DATE) - INTERVAL 7 DAY"
PREVIOUS = (
    f"first_seen >= CAST({CLOCK} AS DATE) - INTERVAL 14 DAY "
    f"AND first_seen < CAST({CLOCK} AS DATE) - INTERVAL 7 DAY"
)
COUNT_FIT = "count(*) FILTER (WHERE ai_match_score >= {n})"
AVG = "round(avg(ai_match_score), 1)"


def pct(n: int) -> str:
    return f"round(100.0E0 * {COUNT_FIT.format(n=n)} / count(*), 1)"


_PLAIN = [c for c in M.CURRENT_COLUMNS if c not in ("first_seen", "last_seen")]


@query(
    "jobs_current",
    f"""SELECT {', '.join(_PLAIN)}, {stamp_sql('first_seen')}, {stamp_sql('last_seen')}
        FROM @seen WHERE first_seen >= CAST({CLOCK} AS DATE) - INTERVAL 10 DAY""",
)
def jobs_current(t):
    return M.jobs_current(t.seen, AS_OF, days=10).select(
        *_PLAIN, stamp("first_seen"), stamp("last_seen")
    )


@query(
    "daily_stats",
    f"SELECT {', '.join(c for c in M.DAILY_COLUMNS if c != 'run_date')}, {stamp_sql('run_date')} "
    "FROM @runs",
)
def daily_stats(t):
    return M.daily_stats(t.runs).withColumn("run_date", stamp("run_date"))


@query(
    "recommendations_today",
    f"""SELECT {', '.join(M.RECOMMENDED_COLUMNS)} FROM @seen
        WHERE ai_match_score >= 40 AND last_seen >= CAST({CLOCK} AS DATE)
        ORDER BY ranking_score DESC, dedup_key LIMIT 10""",
)
def recommendations_today(t):
    return M.recommendations_today(t.seen, AS_OF)


@query(
    "cross_platform",
    f"""SELECT canonical_key, count(*) AS entry_count, count(DISTINCT source) AS source_count,
        string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
        string_agg(DISTINCT company, ',' ORDER BY company) AS company_variants,
        max(ai_match_score) AS best_score,
        strftime(min(first_seen), '%Y-%m-%d %H:%M:%S') AS earliest_seen
        FROM @seen WHERE canonical_key <> '' GROUP BY canonical_key
        HAVING count(DISTINCT source) > 1""",
)
def cross_platform(t):
    return M.cross_platform(t.seen).withColumn("earliest_seen", stamp("earliest_seen"))


_RUN_WEEK = WEEK.replace("first_seen", "run_date")


def _rate(column: str) -> str:
    return f"COALESCE(round(1.0E0 * sum({column}) / NULLIF(sum(jobs_new), 0), 3), 0.0E0)"


@query(
    "weekly_health",
    f"""SELECT CAST(sum(jobs_scraped) AS BIGINT) AS total_scraped,
        CAST(sum(jobs_new) AS BIGINT) AS unique_new,
        CAST(sum(jobs_prefilter_passed) AS BIGINT) AS prefilter_passed,
        CAST(sum(jobs_recommended) AS BIGINT) AS recommended,
        {_rate('jobs_prefilter_passed')} AS prefilter_rate,
        {_rate('jobs_recommended')} AS recommendation_rate,
        round(avg(duration_seconds), 1) AS avg_duration_seconds,
        round(sum(api_cost_usd), 4) AS total_api_cost, count(*) AS total_runs,
        CAST(sum(CAST(errors <> '' AS INT)) AS BIGINT) AS error_runs,
        string_agg(errors, '; ' ORDER BY run_date) FILTER (WHERE errors <> '') AS failed_sources
        FROM @runs WHERE {_RUN_WEEK}""",
)
def weekly_health(t):
    return M.weekly_health(t.runs, AS_OF)


@query(
    "weekly_source",
    f"""SELECT source, count(*) AS total,
        count(*) FILTER (WHERE prefilter_passed = 1) AS passed_prefilter,
        {COUNT_FIT.format(n=40)} AS recommended, {AVG} AS avg_score,
        round(avg((epoch_us({CLOCK}) - ({X.instant('posted_date')})) / 86400000000.0E0), 1)
            AS avg_posting_days
        FROM @seen WHERE {WEEK} GROUP BY source""",
)
def weekly_source(t):
    return M.weekly_source(t.seen, AS_OF)


@query(
    "weekly_company_type",
    f"""SELECT company_type, company_type_confidence AS confidence, count(*) AS job_count,
        {AVG} AS avg_ai_score, {pct(40)} AS pct_recommended
        FROM @seen WHERE {WEEK} AND company_type <> ''
        GROUP BY company_type, company_type_confidence""",
)
def weekly_company_type(t):
    return M.weekly_company_type(t.seen, AS_OF)


@query(
    "weekly_experience",
    f"""SELECT experience_required, count(*) AS job_count, {AVG} AS avg_ai_score
        FROM @seen WHERE {WEEK} AND experience_required <> '' GROUP BY experience_required""",
)
def weekly_experience(t):
    return M.weekly_experience(t.seen, AS_OF)


_RUN_PREVIOUS = PREVIOUS.replace("first_seen", "run_date")
_COUNTED = {"total_scraped": "jobs_scraped", "unique_new": "jobs_new", "recommended": "jobs_recommended"}
_FIGURES = " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, run_date, CAST({column} AS DOUBLE) AS x FROM @runs"
    for metric, column in _COUNTED.items()
)


@query(
    "weekly_trends",
    f"""WITH figures AS ({_FIGURES}), weeks AS (
          SELECT metric, COALESCE(sum(x) FILTER (WHERE {_RUN_WEEK}), 0.0E0) AS t,
                 COALESCE(sum(x) FILTER (WHERE {_RUN_PREVIOUS}), 0.0E0) AS p
          FROM figures GROUP BY metric
          UNION ALL
          SELECT 'avg_score', COALESCE({AVG.replace('),', f') FILTER (WHERE {WEEK}),')}, 0.0E0),
                 COALESCE({AVG.replace('),', f') FILTER (WHERE {PREVIOUS}),')}, 0.0E0)
          FROM @seen WHERE ai_match_score > 0)
        SELECT metric, t AS this_week, p AS prev_week,
               round(100.0E0 * (t - p) / NULLIF(p, 0), 1) AS change_pct,
               CASE sign(t - p) WHEN 1 THEN 'up' WHEN -1 THEN 'down' ELSE 'flat' END AS direction
        FROM weeks""",
)
def weekly_trends(t):
    return M.weekly_trends(t.seen, t.runs, AS_OF)


@query(
    "role_match",
    f"""SELECT {X.first_of('lower(title)', ROLES, 'other')} AS role_family, count(*) AS job_count,
        {AVG} AS avg_ai_score, {pct(40)} AS pct_above_40, {pct(70)} AS pct_above_70
        FROM @seen WHERE {WEEK} AND ai_match_score > 0 GROUP BY 1""",
)
def role_match(t):
    return M.role_match(t.seen, AS_OF, ROLES, "other")


_SKILLS = ", ".join(f"('{k}')" for k in PROFILE.high + PROFILE.medium)


@query(
    "skill_mentions",
    f"""SELECT k.skill, count(*) AS mention_count, {AVG} AS avg_score_when_mentioned
        FROM @seen s JOIN (VALUES {_SKILLS}) k(skill) ON contains(lower(match_reasons), lower(k.skill))
        WHERE {WEEK} AND match_reasons <> '' AND ai_match_score >= 40 GROUP BY k.skill""",
)
def skill_mentions(t):
    return M.skill_mentions(t.seen, AS_OF, PROFILE)


_BAND = X.first_of("lower(experience_required)", EXPERIENCE_RULES, OTHER_BAND)


@query(
    "experience_bands",
    f"""SELECT {_BAND} AS experience_range, count(*) AS job_count,
        round(100.0E0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_total, {AVG} AS avg_ai_score
        FROM @seen WHERE {WEEK} AND experience_required <> '' GROUP BY 1""",
)
def experience_bands(t):
    return M.experience_bands(t.seen, AS_OF)
