"""Responses, budgets and the shortlist."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from siftline.catalog import twins  # noqa: F401  (adds its common tables)
from siftline.catalog.fixtures import EMPLOYERS, PROFILE, AS_OF
from siftline.catalog.registry import query
from siftline.functions import scores as S
from siftline.operators import scoring as O
from siftline.operators.ranking import top_recommendations, with_ranking_score
from siftline.plans.daily import posting_features
from siftline.session import stage


@query(
    "scorer_responses",
    """SELECT dedup_key, valid, CASE WHEN valid THEN response_score END AS response_score,
       CASE WHEN valid THEN reasons END AS reasons, CASE WHEN valid THEN positioning END AS positioning,
       CASE WHEN valid THEN cost_units ELSE 0 END AS cost_units FROM @response_facts""",
)
def scorer_responses(t):
    return O.read_responses(t.responses)


@query(
    "prefiltered_postings",
    "SELECT dedup_key, seq, keyword_score FROM @features WHERE keyword_score >= 2",
)
def prefiltered_postings(t):
    return O.keyword_prefilter(t.postings, PROFILE).select("dedup_key", "seq", "keyword_score")


_SCORED = ("dedup_key", "keyword_score", "ai_match_score", "match_reasons", "positioning_advice",
           "spent_units")


def _scored_all(t):
    narrow = O.with_keyword_score(t.postings, PROFILE).drop("jd_text")
    return O.spend_budget(stage(O.attach_responses(narrow, t.responses), "attached"))


@query("budgeted_scores", f"SELECT {', '.join(_SCORED)} FROM @scored_all")
def budgeted_scores(t):
    return _scored_all(t).select(*_SCORED)


@query(
    "fallback_scores",
    "SELECT dedup_key, CASE WHEN keyword_score >= 2 THEN LEAST(100.0E0, keyword_score * 5) "
    "ELSE 0.0E0 END AS ai_match_score FROM @features",
)
def fallback_scores(t):
    scored = O.score_postings(O.with_keyword_score(t.postings, PROFILE))
    return scored.select("dedup_key", "ai_match_score")


def _title_scorer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A user's own scorer: fit from the length of the title."""
    for b in batches:
        fit = b["title"].str.len() % 101
        yield pd.DataFrame(
            {
                "dedup_key": b["dedup_key"],
                "response_text": '{"score": ' + fit.astype(str) + ', "reasons": "title"}',
                "input_tokens": 10,
                "output_tokens": 1,
            }
        )


@query(
    "user_scorer",
    """SELECT dedup_key, CAST(length(title) % 101 AS DOUBLE) AS response_score, 'title' AS reasons,
       120 AS cost_units FROM @postings""",
)
def user_scorer(t):
    responses = O.run_scorer(t.postings.select("dedup_key", "title"), _title_scorer)
    return O.read_responses(responses).select(
        "dedup_key", "response_score", "reasons", "cost_units"
    )


@query(
    "enrichment_responses",
    """SELECT dedup_key, valid, company_intro, business_model, market_position, team_function,
       advice, cost_units FROM @enrichment_facts""",
)
def enrichment_responses(t):
    return O.read_enrichments(t.enrichments).select(
        "dedup_key", "valid", "company_intro", "business_model", "market_position",
        "team_function", "advice", "cost_units",
    )


_RANK = "ai_match_score DESC, keyword_score DESC, seq"
_UNCONFIRMED_RANKING = f"""
SELECT *, CASE WHEN ai_match_score >= 40 THEN ai_match_score + {twins.bonus_of('freshness_days')}
       ELSE 0.0E0 END AS ranking_score FROM @scored_all"""


@query(
    "top_recommendations",
    f"""SELECT dedup_key, ranking_score, ai_match_score,
        row_number() OVER (ORDER BY ranking_score DESC, {_RANK}) AS rank
        FROM ({_UNCONFIRMED_RANKING}) r WHERE ai_match_score >= 40
        ORDER BY ranking_score DESC, {_RANK} LIMIT 10""",
)
def top_k(t):
    features = posting_features(t.postings, PROFILE, AS_OF, EMPLOYERS)
    attached = stage(O.attach_responses(features, t.responses), "attached")
    scored = (
        O.spend_budget(attached)
        .withColumn("company_type", F.lit(""))
        .withColumn("company_type_confidence", F.lit("unverified"))
    )
    return top_recommendations(with_ranking_score(scored)).select(
        "dedup_key", "ranking_score", "ai_match_score", "rank"
    )


@query(
    "ranking_scores",
    f"""SELECT dedup_key, CASE WHEN ai_match_score >= 40 THEN ai_match_score
          + CASE WHEN company_type_confidence = 'unverified' THEN 0.0E0
                 WHEN company_type = '외국계' THEN 6.0E0 WHEN company_type = '대기업' THEN 4.0E0
                 WHEN company_type = '스타트업' THEN 2.0E0 ELSE 0.0E0 END
          + {twins.bonus_of('days')} ELSE 0.0E0 END AS ranking_score,
        LEAST(100.0E0, GREATEST(0.0E0, ai_match_score * 2 - 40)) AS clamped
        FROM (SELECT *, {twins.elapsed(twins.parsed('posted_date'))} AS days FROM @seen) s""",
)
def ranking_scores(t):
    from siftline.functions.freshness import freshness_days

    aged = t.seen.withColumn("freshness_days", freshness_days(F.col("posted_date"), AS_OF))
    return with_ranking_score(aged).select(
        "dedup_key", "ranking_score", S.clamp_score(F.col("ai_match_score") * 2 - 40).alias("clamped")
    )


@query(
    "score_updates",
    """SELECT h.dedup_key, COALESCE(s.ai_match_score, h.match_score) AS match_score
       FROM @history h LEFT JOIN @scored_all s ON h.dedup_key = s.dedup_key""",
)
def score_updates(t):
    from siftline.catalog.q_history import kept_history

    scores = _scored_all(t).select("dedup_key", F.col("ai_match_score").alias("score"))
    store = kept_history(t, "match_score")
    store.set_scores(scores, 1)
    return store.read().select("dedup_key", "match_score")
