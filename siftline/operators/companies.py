"""Employer class per company: cache, first posting, evidence under a quota."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import rules as R
from siftline.functions.freshness import as_timestamp
from siftline.functions.text import normalize_company
from siftline.operators.skew import lookup
from siftline.session import stage

# Searches per run, and marks of how a class came about.
MAX_SEARCHES = 20
VERIFIED, PATTERN_MATCH, UNVERIFIED = "verified", "pattern_match", "unverified"
FROM_SEARCH, FROM_PATTERN, FROM_DEFAULT = "tavily", "pattern", "default"


def with_company_columns(postings: DataFrame, rules: R.Rules = R.EMPLOYER_RULES) -> DataFrame:
    """Add ``normalized_name`` and ``pattern_index``; no text is needed after this.

    The text is searched where it lies, so only a small number is shuffled.
    """
    lowered = F.lower(F.concat_ws(" ", "jd_text", "company"))
    return (
        postings.withColumn("normalized_name", normalize_company(F.col("company")))
        .withColumn("_lowered", lowered)
        .withColumn("pattern_index", R.first_rule_index(F.col("_lowered"), rules))
        .drop("_lowered")
    )


def first_patterns(postings: DataFrame, order: str = "seq") -> DataFrame:
    """One row per company: the pattern of its first posting decides for all."""
    return postings.groupBy("normalized_name").agg(
        F.count("*").alias("postings"),
        F.min(order).alias("first_order"),
        F.min_by("pattern_index", order).alias("pattern_index"),
    )


def company_verdicts(
    postings: DataFrame,
    cache: DataFrame,
    snippets: DataFrame | None = None,
    rules: R.Rules = R.EMPLOYER_RULES,
    max_searches: int = MAX_SEARCHES,
    order: str = "seq",
) -> DataFrame:
    """Class, confidence and origin per company in ``postings``.

    A cache entry wins.  Otherwise the pattern of the first posting is checked
    against ``snippets(normalized_name, snippet)``, any number of rows for a
    company, for the first ``max_searches`` companies that have any; the rest
    keep the bare pattern.  A keyword counts inside one snippet, not across two.
    """
    known = cache.select(
        "normalized_name",
        F.col("company_type").alias("_type"),
        F.col("confidence").alias("_confidence"),
        F.col("source").alias("_source"),
    )
    named = (
        first_patterns(postings, order)
        .join(known, "normalized_name", "left")
        .withColumn("cached", F.col("_type").isNotNull())
        .withColumn("_pattern", R.rule_label(F.col("pattern_index"), rules, R.GENERAL))
    )
    matched = F.col("pattern_index") < len(rules)
    if snippets is None:
        judged = named.withColumn("_confirmed", F.lit(None).cast("boolean"))
    else:
        # Evidence is read once and where it lies: a flag per class and company is all
        # that is shuffled, whichever companies the quota will choose.
        lowered = F.lower("snippet")
        flags = [F.max(R.contains_any(lowered, words)).alias(f"_flag_{i}") for i, words in enumerate(R.EVIDENCE_WORDS.values())]
        found = snippets.groupBy("normalized_name").agg(F.lit(True).alias("_found"), *flags)
        named = stage(named.join(found, "normalized_name", "left"), "named")
        # At most max_searches names.
        chosen = (
            named.where(~F.col("cached") & matched & F.col("_found"))
            .orderBy("first_order")
            .limit(max_searches)
            .select("normalized_name", F.lit(True).alias("_chosen"))
        )
        flag = F.lit(False)
        for i, label in enumerate(R.EVIDENCE_WORDS):
            flag = F.when(F.col("_pattern") == label, F.col(f"_flag_{i}")).otherwise(flag)
        judged = named.join(F.broadcast(chosen), "normalized_name", "left").withColumn("_confirmed", F.when(F.col("_chosen"), flag))

    confirmed = F.col("_confirmed")
    company_type = (
        F.when(F.col("cached"), F.col("_type"))
        .when(~matched, F.lit(R.UNCONFIRMED))
        .when(confirmed.isNull() | confirmed, F.col("_pattern"))
        .otherwise(R.UNCONFIRMED)
    )
    confidence = (
        F.when(F.col("cached"), F.col("_confidence"))
        .when(~matched, F.lit(UNVERIFIED))
        .when(confirmed.isNull(), F.lit(PATTERN_MATCH))
        .when(confirmed, F.lit(VERIFIED))
        .otherwise(F.lit(UNVERIFIED))
    )
    origin = (
        F.when(F.col("cached"), F.col("_source"))
        .when(~matched, F.lit(FROM_DEFAULT))
        .when(confirmed, F.lit(FROM_SEARCH))
        .otherwise(F.lit(FROM_PATTERN))
    )
    note = F.when(
        matched,
        F.concat(F.lit("pattern="), F.col("_pattern"), F.lit(", verified="), confidence),
    ).otherwise(F.lit("no pattern match"))
    return judged.select(
        "normalized_name",
        "postings",
        "cached",
        company_type.alias("company_type"),
        confidence.alias("company_type_confidence"),
        origin.alias("company_type_source"),
        note.alias("raw_search_snippet"),
    )


def classify_postings(
    postings: DataFrame, verdicts: DataFrame, order: str = "seq"
) -> DataFrame:
    """Hand each posting the verdict on its company."""
    wanted = verdicts.select(
        "normalized_name",
        "postings",
        "company_type",
        "company_type_confidence",
        "company_type_source",
    )
    return lookup(postings, wanted, "normalized_name", weight="postings", spread_by=order)


def cache_entries(verdicts: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Verdicts to be remembered: those that did not come from the cache."""
    return verdicts.where(~F.col("cached")).select(
        "normalized_name",
        "company_type",
        F.col("company_type_confidence").alias("confidence"),
        F.col("company_type_source").alias("source"),
        as_timestamp(as_of).alias("verified_at"),
        "raw_search_snippet",
    )


def confidence_tally(classified: DataFrame) -> DataFrame:
    """How many postings have which confidence."""
    return classified.groupBy("company_type_confidence").agg(F.count("*").alias("postings"))
