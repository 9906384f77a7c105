"""Keyword prefilter, external scores under a budget, enrichment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import rules as R
from siftline.functions import scores as S
from siftline.functions.text import people_search_url

# Thresholds and the daily budget in US dollars.
PREFILTER_MIN = 2.0
FIT_MIN = 40.0
ENRICH_MIN = 70.0
DAILY_BUDGET_USD = 0.50

RESPONSE_SCHEMA = "dedup_key string, response_text string, input_tokens bigint, output_tokens bigint"

# Columns of a response once it is read.
RESPONSE_COLUMNS = ("valid", "response_score", "reasons", "positioning", "cost_units")

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def with_keyword_score(
    postings: DataFrame, profile: R.Profile, min_score: float = PREFILTER_MIN
) -> DataFrame:
    """Add ``keyword_score`` and the flag ``prefilter_passed``; all rows stay."""
    return (
        postings.withColumn("_lowered", F.lower(F.concat_ws(" ", "title", "jd_text", "company")))
        .withColumn("keyword_score", R.keyword_score(F.col("_lowered"), profile))
        .withColumn("prefilter_passed", (F.col("keyword_score") >= min_score).cast("int"))
        .drop("_lowered")
    )


def keyword_prefilter(
    postings: DataFrame, profile: R.Profile, min_score: float = PREFILTER_MIN
) -> DataFrame:
    """Postings that pass; order them by ``keyword_score`` descending, ``seq``."""
    return with_keyword_score(postings, profile, min_score).where("prefilter_passed = 1")


def run_scorer(postings: DataFrame, scorer: Scorer) -> DataFrame:
    """Responses from a user function over Arrow batches (see ``RESPONSE_SCHEMA``)."""
    return postings.mapInPandas(scorer, RESPONSE_SCHEMA)


def read_responses(responses: DataFrame) -> DataFrame:
    """Typed columns of raw scorer output, one row per posting.

    ``valid`` is false where the text is no JSON object or its score no number;
    such a response costs nothing and says nothing.
    """
    v = S.json_object(S.strip_fence(F.col("response_text")))
    return (
        responses.withColumn("_json", v)
        .withColumn("_score", S.score_field(F.col("_json")))
        .withColumn("valid", F.col("_score").isNotNull())
        .select(
            "dedup_key",
            "valid",
            S.clamp_score(F.col("_score")).alias("response_score"),
            F.when(F.col("valid"), S.text_field(F.col("_json"), "reasons")).alias("reasons"),
            F.when(F.col("valid"), S.text_field(F.col("_json"), "positioning")).alias("positioning"),
            F.when(
                F.col("valid"),
                S.response_cost_units(F.col("input_tokens"), F.col("output_tokens")),
            )
            .otherwise(F.lit(0))
            .alias("cost_units"),
        )
    )


def attach_responses(postings: DataFrame, responses: DataFrame) -> DataFrame:
    """Left join of postings with what their responses say (keys are unique)."""
    return postings.join(read_responses(responses), "dedup_key", "left")


# Order numbers are narrowed down by so many ranges at a time.
_RANGES = 1 << 16


def budget_border(priced: DataFrame, units: int, order: str = "seq") -> tuple[float, int] | None:
    """Keyword score and order of the posting whose ``_cost`` crosses the budget.

    The running sum never falls, so one row says all.  It is found on sums: by
    score, then by ranges of the orders that are there, each narrowed to those of
    its rows, until one is left.  Where the border's score has up to 2^16 rows with
    consecutive numbers, that is two passes; 2^32 take three.  No step shuffles
    postings, and none has more than 2^16 ranges.
    """
    scope, left, low, high, score = priced, units, 0, 1, None
    while low < high:
        if score is None:
            key, first = F.col("keyword_score"), F.col("_key").desc()
        else:
            width = -(-(high - low + 1) // _RANGES)
            key, first = F.call_function("div", F.col(order) - F.lit(low), F.lit(width)), F.col("_key").asc()
        sums = scope.groupBy(key.alias("_key")).agg(
            F.sum("_cost").alias("_sum"), F.min(order).alias("_low"), F.max(order).alias("_high")
        )
        running = F.sum("_sum").over(Window.orderBy(first).rowsBetween(Window.unboundedPreceding, 0))
        crossing = (
            sums.select("*", running.alias("_running"))
            .where((F.col("_running") > left) & (F.col("_running") - F.col("_sum") <= left))
            .first()
        )
        if crossing is None:
            return None
        score = crossing["_key"] if score is None else score
        scope, left = scope.where(key == crossing["_key"]), left - (crossing["_running"] - crossing["_sum"])
        low, high = crossing["_low"], crossing["_high"]
    return score, low


def spend_budget(
    attached: DataFrame, budget_usd: float = DAILY_BUDGET_USD, order: str = "seq"
) -> DataFrame:
    """Settle scores of :func:`attach_responses` output within the budget.

    Looks for the border of the budget first, so stage the input where it is
    costly; the postings themselves are then settled in one pass where they lie.
    """
    passed = F.col("prefilter_passed") == 1
    fallback = S.keyword_fallback(F.col("keyword_score"))
    usable = passed & F.coalesce(F.col("valid"), F.lit(False))
    priced = attached.withColumn("_usable", usable).withColumn(
        "_cost", F.when(F.col("_usable"), F.col("cost_units")).otherwise(F.lit(0))
    )
    border = budget_border(priced.where("_usable"), S.usd_to_units(budget_usd), order)
    counted = F.col("_usable")
    if border is not None:
        score, place = border
        counted &= (F.col("keyword_score") > score) | (
            (F.col("keyword_score") == score) & (F.col(order) <= place)
        )
    score = (
        F.when(F.col("_counted") & (F.col("response_score") != 0), F.col("response_score"))
        .when(passed, fallback)
        .otherwise(0.0)
    )
    given = {"match_reasons": "reasons", "positioning_advice": "positioning"}
    return priced.withColumn("_counted", counted).select(
        *[c for c in attached.columns if c not in RESPONSE_COLUMNS],
        score.alias("ai_match_score"),
        *[F.when(F.col("_counted"), F.col(c)).otherwise("").alias(n) for n, c in given.items()],
        F.when(F.col("_counted"), F.col("_cost")).otherwise(F.lit(0)).alias("spent_units"),
    )


def score_postings(
    postings: DataFrame,
    responses: DataFrame | None = None,
    budget_usd: float = DAILY_BUDGET_USD,
    order: str = "seq",
) -> DataFrame:
    """Attach the fit score, reasons, advice and the cost actually spent.

    Prefiltered postings are taken by ``keyword_score`` descending, then
    ``order``, until the money spent exceeds the budget; the posting that
    crosses it still counts.  Whoever gets no usable score, or exactly zero,
    falls back on keywords.  Rows that did not pass the prefilter score 0.
    """
    if responses is not None:
        return spend_budget(attach_responses(postings, responses), budget_usd, order)
    fallback = S.keyword_fallback(F.col("keyword_score"))
    return (
        postings.withColumn(
            "ai_match_score", F.when(F.col("prefilter_passed") == 1, fallback).otherwise(0.0)
        )
        .withColumn("match_reasons", F.lit(""))
        .withColumn("positioning_advice", F.lit(""))
        .withColumn("spent_units", F.lit(0).cast("bigint"))
    )


def read_enrichments(enrichments: DataFrame) -> DataFrame:
    """Typed columns of raw enrichment output; cut-off JSON is repaired.

    A text is taken as it is, else closed and taken, else searched key by key.
    """
    body = F.col("_body")
    found = [F.col(f"_loose_{k}").isNotNull() for k in (*S.ENRICHMENT_FIELDS, S.ADVICE_FIELD)]
    any_found = found[0]
    for f in found[1:]:
        any_found = any_found | f
    frame = enrichments.withColumn("_body", S.strip_fence(F.col("response_text"))).withColumn(
        "_json", F.coalesce(S.json_object(body), S.json_object(S.close_json(body)))
    )
    for k in (*S.ENRICHMENT_FIELDS, S.ADVICE_FIELD):
        frame = frame.withColumn(
            f"_loose_{k}", F.when(F.col("_json").isNull(), S.loose_field(body, k))
        )
    frame = frame.withColumn("valid", F.col("_json").isNotNull() | any_found)
    fields = [
        F.when(
            F.col("valid"),
            F.coalesce(
                F.try_variant_get("_json", f"$.{k}", "string"), F.col(f"_loose_{k}"), F.lit("")
            ),
        ).alias(k if k != S.ADVICE_FIELD else "advice")
        for k in (*S.ENRICHMENT_FIELDS, S.ADVICE_FIELD)
    ]
    cost = S.response_cost_units(F.col("input_tokens"), F.col("output_tokens"))
    return frame.select(
        "dedup_key", "valid", *fields, F.when(F.col("valid"), cost).otherwise(F.lit(0)).alias("cost_units")
    )


def enrich_shortlist(
    shortlist: DataFrame,
    enrichments: DataFrame | None,
    spent: DataFrame,
    budget_usd: float = DAILY_BUDGET_USD,
    min_score: float = ENRICH_MIN,
) -> DataFrame:
    """Fill the company columns of strong shortlisted postings, in rank order.

    ``spent(run_id, spent_units)`` is what scoring used up; enrichment gets the
    rest of the budget.  The shortlist is a handful of rows per run, so plain
    windows do.  Weaker postings stay, with blanks.
    """
    blanks = shortlist
    for k in S.ENRICHMENT_FIELDS:
        blanks = blanks.withColumn(k, F.lit(""))
    if enrichments is None:
        return blanks.withColumn("enrich_units", F.lit(0).cast("bigint"))

    joined = shortlist.join(read_enrichments(enrichments), "dedup_key", "left").join(
        F.broadcast(spent.select("run_id", F.col("spent_units").alias("_scored_units"))),
        "run_id",
        "left",
    )
    usable = (F.col("ai_match_score") >= min_score) & F.coalesce(F.col("valid"), F.lit(False))
    cost = F.when(usable, F.col("cost_units")).otherwise(F.lit(0))
    earlier = (
        Window.partitionBy("run_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.greatest(
        F.lit(0), F.lit(S.usd_to_units(budget_usd)) - F.coalesce(F.col("_scored_units"), F.lit(0))
    )
    counted = usable & (F.coalesce(F.sum("_cost").over(earlier), F.lit(0)) <= left)
    frame = joined.withColumn("_cost", cost).withColumn("_counted", counted)
    for k in S.ENRICHMENT_FIELDS:
        frame = frame.withColumn(k, F.when(F.col("_counted"), F.col(k)).otherwise(""))
    return (
        frame.withColumn(
            "positioning_advice",
            F.when(F.col("_counted") & (F.col("advice") != ""), F.col("advice")).otherwise(
                F.col("positioning_advice")
            ),
        )
        .withColumn("enrich_units", F.when(F.col("_counted"), F.col("_cost")).otherwise(F.lit(0)))
        .select(*blanks.columns, "enrich_units")
    )


def search_address(min_score: float = ENRICH_MIN) -> Column:
    """People-search address of strong postings, blank for the rest."""
    hint = F.coalesce(F.nullif(F.col("team_function"), F.lit("")), F.col("title"))
    return F.when(
        F.col("ai_match_score") >= min_score, people_search_url(F.col("company"), hint)
    ).otherwise("")
