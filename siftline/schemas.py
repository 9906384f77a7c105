"""Columns of the tables the engine reads and writes.

Missing text is ``''`` everywhere, never NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

ColumnSpec = tuple[str, str, object]  # name, type, default

# Columns of a normalised posting.
POSTING_TEXTS = (
    "source", "source_id", "url", "title", "company", "location",
    "experience_required", "salary_info", "posted_date", "deadline", "jd_text",
)
POSTINGS = T.StructType(
    [T.StructField("seq", T.LongType(), False)]
    + [T.StructField(c, T.StringType(), False) for c in POSTING_TEXTS]
    + [T.StructField("scraped_at", T.TimestampType(), True)]
)

# The history table.  The base columns come with the first run,
# the rest were added to it later and carry the default for older rows.
SEEN_BASE: tuple[ColumnSpec, ...] = (
    ("dedup_key", "string", None),
    ("source", "string", None),
    ("source_id", "string", None),
    ("title", "string", None),
    ("company", "string", None),
    ("url", "string", None),
    ("first_seen", "timestamp", None),
    ("last_seen", "timestamp", None),
    ("match_score", "double", 0.0),
    ("application_status", "string", ""),
    ("notes", "string", ""),
)
SEEN_ADDED: tuple[ColumnSpec, ...] = (
    ("location", "string", ""),
    ("experience_required", "string", ""),
    ("salary_info", "string", ""),
    ("posted_date", "string", ""),
    ("deadline", "string", ""),
    ("jd_text", "string", ""),
    ("jd_language", "string", ""),
    ("company_type", "string", ""),
    ("scraped_at", "timestamp", None),
    ("keyword_score", "double", 0.0),
    ("ai_match_score", "double", 0.0),
    ("match_reasons", "string", ""),
    ("positioning_advice", "string", ""),
    ("company_intro", "string", ""),
    ("products_services", "string", ""),
    ("business_model", "string", ""),
    ("vision_goals", "string", ""),
    ("ideal_candidate", "string", ""),
    ("market_position", "string", ""),
    ("team_function", "string", ""),
    ("linkedin_search_url", "string", ""),
    ("freshness_label", "string", ""),
    ("company_type_confidence", "string", "unverified"),
    ("company_type_source", "string", ""),
    ("canonical_key", "string", ""),
    ("canonical_group_id", "string", ""),
    ("effective_date", "string", ""),
    ("ranking_score", "double", 0.0),
    ("prefilter_passed", "int", 0),
)
SEEN = SEEN_BASE + SEEN_ADDED
SEEN_COLUMNS = tuple(name for name, _, _ in SEEN)

# Columns an update may overwrite: all that were added, plus the score twin and
# the time of sight.  Identity, first sight and the user's own notes stay.
UPDATED_COLUMNS = tuple(name for name, _, _ in SEEN_ADDED)

# The run log.
RUNS_BASE: tuple[ColumnSpec, ...] = (
    ("run_id", "bigint", None),
    ("run_date", "timestamp", None),
    ("jobs_scraped", "bigint", 0),
    ("jobs_new", "bigint", 0),
    ("jobs_matched", "bigint", 0),
    ("jobs_enriched", "bigint", 0),
    ("api_cost_usd", "double", 0.0),
    ("errors", "string", ""),
    ("duration_seconds", "double", 0.0),
)
RUNS_ADDED: tuple[ColumnSpec, ...] = (
    ("jobs_recommended", "bigint", 0),
    ("jobs_prefilter_passed", "bigint", 0),
    ("recommendation_rate", "double", 0.0),
)
RUNS = RUNS_BASE + RUNS_ADDED
RUN_COLUMNS = tuple(name for name, _, _ in RUNS)

# The employer dimension.
COMPANY_CACHE: tuple[ColumnSpec, ...] = (
    ("normalized_name", "string", None),
    ("company_type", "string", None),
    ("confidence", "string", None),
    ("source", "string", None),
    ("verified_at", "timestamp", None),
    ("raw_search_snippet", "string", ""),
)

# The order in which sources are read.
SOURCE_ORDER = ("saramin", "incruit", "jobkorea", "wanted")


def struct_of(spec: tuple[ColumnSpec, ...]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind, _ in spec))
