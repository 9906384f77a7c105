"""Merge, employer classes, and the daily and weekly jobs as a whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftline.catalog import twins as X
from siftline.catalog.fixtures import AS_OF, CLOCK, EMPLOYERS, PROFILE, ROLES, RUN_ID, SOURCES
from siftline.catalog import q_marts  # noqa: F401  (its SQL is taken up here)
from siftline.catalog.registry import SQL, query, stamp, stamp_sql
from siftline.functions import freshness as D
from siftline.functions.rules import EXPERIENCE_BANDS
from siftline.operators import companies as C
from siftline.operators.canonical import group_members, merge_cross_platform, with_merge_columns
from siftline.operators.dedup import new_rows
from siftline.plans.daily import posting_features, run_daily
from siftline.plans.exports import daily_exports, export_order, ordered_marts
from siftline.plans.weekly import weekly_report
from siftline.session import stage, stage_path
from siftline.sources.csv_sink import write_csv_file



def _keyed(t):
    """What merging needs, staged: it reads its input more than once."""
    narrow = with_merge_columns(t.postings).select(
        "seq", "source", "dedup_key", "canonical_key", "completeness"
    )
    return stage(narrow, "keyed")


_MERGED = "dedup_key, canonical_key, canonical_group_id, merge_order"


@query("canonical_merge", f"SELECT {_MERGED} FROM @merged_all")
def canonical_merge(t):
    return merge_cross_platform(_keyed(t)).select(*_MERGED.split(", "))


@query(
    "canonical_members",
    """SELECT canonical_key, row_number() OVER (PARTITION BY canonical_key ORDER BY completeness DESC,
       seq) AS position, dedup_key, source FROM @features WHERE canonical_key <> ''""",
)
def canonical_members(t):
    return group_members(_keyed(t))


@query(
    "aged_postings",
    "SELECT dedup_key, freshness_days FROM @features WHERE freshness_days IS NULL OR freshness_days <= 30",
)
def aged_postings(t):
    days = D.effective_freshness_days(F.col("posted_date"), F.col("scraped_at"), AS_OF)
    aged = t.postings.select("dedup_key", days.alias("freshness_days"))
    return aged.where(D.within_age(F.col("freshness_days")))


def _kept(t):
    features = posting_features(t.postings, PROFILE, AS_OF, EMPLOYERS)
    needed = features.select(
        "seq", "source", "dedup_key", "canonical_key", "completeness", "freshness_days",
        "normalized_name", "pattern_index",
    )
    merged = merge_cross_platform(stage(new_rows(needed, t.history), "fresh"))
    return stage(merged.where(D.within_age(F.col("freshness_days"))), "kept")


def _verdicts(t, kept):
    verdicts = C.company_verdicts(kept, t.cache, t.snippets, EMPLOYERS, order="merge_order")
    return stage(verdicts, "verdicts")


@query(
    "employer_verdicts",
    """SELECT normalized_name, postings, cached, company_type, company_type_confidence,
       company_type_source, CASE WHEN pattern = '일반' THEN 'no pattern match' ELSE
       'pattern=' || pattern || ', verified=' || company_type_confidence END AS raw_search_snippet
       FROM @verdicts""",
)
def employer_verdicts(t):
    return _verdicts(t, _kept(t))


_CLASS = "company_type, company_type_confidence, company_type_source"


@query("classified_postings", f"SELECT dedup_key, {_CLASS} FROM @classified")
def classified_postings(t):
    kept = _kept(t)
    classified = C.classify_postings(kept, _verdicts(t, kept), order="merge_order")
    return classified.select("dedup_key", *_CLASS.split(", "))


@query(
    "confidence_tally",
    "SELECT company_type_confidence, count(*) AS postings FROM @classified GROUP BY 1",
)
def confidence_tally(t):
    kept = _kept(t)
    return C.confidence_tally(C.classify_postings(kept, _verdicts(t, kept), order="merge_order"))


def _daily(t):
    return run_daily(
        t.postings,
        t.history,
        t.cache,
        PROFILE,
        AS_OF,
        RUN_ID,
        responses=t.responses,
        snippets=t.snippets,
        enrichments=t.enrichments,
        employer_rules=EMPLOYERS,
        sources=SOURCES,
    )


_SCORED = (
    "dedup_key", "canonical_group_id", "company_type", "company_type_confidence", "jd_language",
    "keyword_score", "prefilter_passed", "ai_match_score", "match_reasons", "ranking_score",
    "effective_date", "spent_units",
)


@query("daily_scored", f"SELECT {', '.join(_SCORED)} FROM @ranked")
def daily_scored(t):
    return _daily(t).scored.select(*_SCORED)


_SHORT = (
    "rank", "dedup_key", "ranking_score", "ai_match_score", "positioning_advice", "company_intro",
    "business_model", "market_position", "team_function", "enrich_units",
)
_HINT = "CASE WHEN team_function <> '' THEN team_function ELSE title END"
_ADDRESS = f"CASE WHEN ai_match_score >= 70 THEN {X.people_search('company', _HINT)} ELSE '' END"


@query(
    "daily_shortlist",
    f"SELECT {', '.join(_SHORT)}, {_ADDRESS} AS linkedin_search_url FROM @shortlist",
)
def daily_shortlist(t):
    return _daily(t).shortlist.select(*_SHORT, "linkedin_search_url")


_STATE = ("canonical_key", "company_type", "ai_match_score", "ranking_score", "match_reasons",
          "company_intro", "effective_date", "jd_language")


@query(
    "daily_history",
    f"""SELECT h.dedup_key, {', '.join('h.' + c for c in _STATE)}, h.match_score,
        h.freshness_label, md5(h.jd_text) AS text_md5, h.positioning_advice,
        {stamp_sql('h.first_seen')},
        strftime(CASE WHEN p.dedup_key IS NOT NULL THEN {CLOCK} ELSE h.last_seen END,
                 '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM @history h LEFT JOIN @postings p ON h.dedup_key = p.dedup_key
        UNION ALL
        SELECT f.dedup_key, {', '.join(
            f"COALESCE(r.{c}, {'0.0E0' if c.endswith('score') else repr('')})"
            for c in _STATE if c != 'company_intro').replace(
                "COALESCE(r.effective_date", "COALESCE(s.company_intro, ''), COALESCE(r.effective_date")},
        COALESCE(r.ai_match_score, 0.0E0),
        CASE WHEN r.dedup_key IS NULL THEN '' ELSE {X.label_of('r.freshness_days')} END,
        md5(COALESCE(r.jd_text, '')),
        COALESCE(s.positioning_advice, r.positioning_advice, ''),
        strftime({CLOCK}, '%Y-%m-%d %H:%M:%S'), strftime({CLOCK}, '%Y-%m-%d %H:%M:%S')
        FROM @fresh f LEFT JOIN @ranked r ON f.dedup_key = r.dedup_key
        LEFT JOIN @shortlist s ON f.dedup_key = s.dedup_key""",
)
def daily_history(t):
    return _daily(t).seen.select(
        "dedup_key", *_STATE, "match_score", "freshness_label", F.md5("jd_text").alias("text_md5"),
        "positioning_advice", stamp("first_seen"), stamp("last_seen"),
    )


@query(
    "daily_sightings",
    f"""SELECT dedup_key, strftime({CLOCK}, '%Y-%m-%d %H:%M:%S') AS seen_at FROM @postings
        WHERE dedup_key IN (SELECT dedup_key FROM @history)""",
)
def daily_sightings(t):
    return _daily(t).sightings.withColumn("seen_at", stamp("seen_at"))


_NEW = "(SELECT count(*) FROM @ranked)"
_PASSED = "(SELECT count(*) FROM @ranked WHERE prefilter_passed = 1)"
_EMPTY = "; ".join(f"{s}: zero results" for s in SOURCES[-2:])


@query(
    "daily_run_row",
    f"""SELECT CAST({RUN_ID} AS BIGINT) AS run_id, (SELECT count(*) FROM @postings) AS jobs_scraped,
        {_NEW} AS jobs_new, {_PASSED} AS jobs_matched, {_PASSED} AS jobs_prefilter_passed,
        (SELECT count(*) FROM @shortlist WHERE company_intro <> '') AS jobs_enriched,
        (SELECT count(*) FROM @shortlist) AS jobs_recommended,
        CAST((SELECT count(*) FROM @shortlist) AS DOUBLE) / {_NEW} AS recommendation_rate,
        CAST((SELECT sum(spent_units) FROM @ranked) + (SELECT sum(enrich_units) FROM @shortlist)
             AS DOUBLE) / 10000000.0E0 AS api_cost_usd, '{_EMPTY}' AS errors""",
)
def daily_run_row(t):
    return _daily(t).run.select(
        "run_id", "jobs_scraped", "jobs_new", "jobs_matched", "jobs_prefilter_passed",
        "jobs_enriched", "jobs_recommended", "recommendation_rate", "api_cost_usd", "errors",
    )


@query(
    "daily_new_companies",
    f"""SELECT normalized_name, company_type, company_type_confidence AS confidence,
        company_type_source AS source, strftime({CLOCK}, '%Y-%m-%d %H:%M:%S') AS verified_at
        FROM @verdicts WHERE NOT cached""",
)
def daily_new_companies(t):
    return _daily(t).new_companies.select(
        "normalized_name", "company_type", "confidence", "source", stamp("verified_at")
    )


# Data set: its mart, what names a row, what it counts, and how it is sorted.
_REPORT = {
    "weekly_category_match": ("role_match", "role_family", "job_count", "job_count DESC, role_family"),
    "weekly_company_type": (
        "weekly_company_type", "company_type || '/' || confidence", "job_count",
        "avg_ai_score DESC, company_type, confidence",
    ),
    "weekly_skills": ("skill_mentions", "skill", "mention_count", "mention_count DESC, skill"),
    "weekly_source_quality": ("weekly_source", "source", "total", "total DESC, source"),
    "weekly_experience": (
        "experience_bands", "experience_range", "job_count",
        f"""list_position([{', '.join(f"'{b}'" for b in EXPERIENCE_BANDS)}], experience_range)""",
    ),
    # Averages have one decimal place.
    "weekly_trends": (
        "weekly_trends",
        "metric || ' ' || direction || ' ' || CAST(CAST(ROUND(prev_week * 10) AS BIGINT) AS STRING)",
        "CAST(ROUND(this_week * 10) AS BIGINT)", "metric",
    ),
    "weekly_health": (
        "weekly_health",
        "CAST(unique_new AS STRING) || '/' || CAST(recommended AS STRING) || '/' || CAST(error_runs AS STRING) || ' ' "
        "|| COALESCE(failed_sources, '')",
        "total_scraped", "1",
    ),
}


@query(
    "weekly_report",
    " UNION ALL ".join(
        f"""SELECT '{data_set}' AS data_set, row_number() OVER (ORDER BY {order}) AS position,
            {name} AS name, {number} AS number FROM ({SQL[mart]}) m"""
        for data_set, (mart, name, number, order) in _REPORT.items()
    ),
)
def weekly(t):
    """Every row of the report in its place."""
    return _placed(weekly_report(t.seen, t.runs, PROFILE, AS_OF, ROLES, "other"), _REPORT)


def _placed(frames, measures):
    """Place, name and number of every row of each data set."""

    def placed(data_set, df):
        name, number = measures[data_set][1:3]
        order = export_order(data_set, df) or [F.expr(name)]
        position = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return df.select(
            F.lit(data_set).alias("data_set"), position.alias("position"),
            F.expr(name).alias("name"), F.expr(number).cast("bigint").alias("number"),
        )

    return reduce(lambda a, b: a.unionByName(b), (placed(n, df) for n, df in frames.items()))


_DAY = "CAST(year(run_date) * 10000 + month(run_date) * 100 + day(run_date) AS STRING)"
_EXPORTS = {
    "jobs_current": (
        f"SELECT * FROM @seen WHERE first_seen >= CAST({CLOCK} AS DATE) - INTERVAL 30 DAY",
        "dedup_key || ' ' || company_type", "CAST(ROUND(ai_match_score * 100) AS BIGINT)", "ai_match_score DESC, dedup_key",
    ),
    "daily_stats": ("SELECT * FROM @runs", _DAY, "jobs_scraped", "run_date DESC"),
    "recommendations_today": (
        f"""SELECT * FROM @seen WHERE ai_match_score >= 40 AND last_seen >= CAST({CLOCK} AS DATE)
            ORDER BY ranking_score DESC, dedup_key LIMIT 10""",
        "dedup_key || ' ' || title", "CAST(ROUND(ranking_score * 100) AS BIGINT)", "ranking_score DESC, dedup_key",
    ),
}
_ORDERED = {
    "cross_platform": (
        SQL["cross_platform"], "canonical_key || ' ' || sources", "CAST(ROUND(best_score * 100) AS BIGINT)",
        "best_score DESC, canonical_key",
    ),
    "weekly_experience_labels": (
        SQL["weekly_experience"], "experience_required", "job_count", "job_count DESC, experience_required",
    ),
}


def _placed_sql(measures):
    return " UNION ALL ".join(
        f"""SELECT '{data_set}' AS data_set, row_number() OVER (ORDER BY {order}) AS position,
            {name} AS name, CAST({number} AS BIGINT) AS number FROM ({rows}) m"""
        for data_set, (rows, name, number, order) in measures.items()
    )


@query("daily_exports", _placed_sql(_EXPORTS))
def exports(t):
    """Every row of the daily exports in its place."""
    return _placed(daily_exports(t.seen, t.runs, AS_OF), _EXPORTS)


@query("ordered_marts", _placed_sql(_ORDERED))
def marts_in_order(t):
    return _placed(ordered_marts(t.seen, AS_OF), _ORDERED)


def _quoted(c):
    return f"""CASE WHEN regexp_matches({c}, '[",]') THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END"""


_LINE = f"{_quoted('dedup_key')} || ',' || {_quoted('title')} || ',' || {_quoted('match_reasons')}"


@query(
    "csv_file",
    f"""SELECT 'EFBBBF' AS mark, line FROM (
          SELECT 'dedup_key,title,match_reasons' AS line UNION ALL SELECT {_LINE} FROM (
            SELECT dedup_key, replace(replace(title, chr(10), ' | '), chr(13), '') AS title, match_reasons FROM @seen)) x""",
)
def csv_file(t):
    """The bytes of a written file: its mark, and its lines."""
    path = f"{stage_path(t.spark, 'exports')}/postings.csv"
    rows = t.seen.select("dedup_key", "title", "match_reasons")
    write_csv_file(rows.orderBy("dedup_key"), path)
    head = t.spark.read.format("binaryFile").load(path).select(F.hex(F.substring("content", 1, 3)).alias("mark"))
    lines = t.spark.read.text(path).select(F.col("value").alias("line"))
    # One row: the one file.
    return lines.join(F.broadcast(head))
