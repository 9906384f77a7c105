"""Ranking score and the bounded shortlist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.freshness import freshness_bonus
from siftline.functions.scores import employer_bonus
from siftline.operators.scoring import FIT_MIN

# Length of the daily shortlist.
MAX_RECOMMENDATIONS = 10


def ranking_score() -> Column:
    """Fit plus bonuses for a confirmed employer class and for freshness."""
    return (
        F.col("ai_match_score")
        + employer_bonus(F.col("company_type"), F.col("company_type_confidence"))
        + freshness_bonus(F.col("freshness_days"))
    )


def with_ranking_score(scored: DataFrame, min_fit: float = FIT_MIN) -> DataFrame:
    """Only postings that qualify are ranked; the others have 0."""
    fits = F.col("ai_match_score") >= min_fit
    return scored.withColumn("ranking_score", F.when(fits, ranking_score()).otherwise(0.0))


def top_recommendations(
    ranked: DataFrame,
    max_count: int = MAX_RECOMMENDATIONS,
    min_fit: float = FIT_MIN,
    order: str = "seq",
) -> DataFrame:
    """The best ``max_count`` qualifying postings, with their ``rank``.

    Ties keep the order of scoring: fit, then keywords, then arrival.
    """
    best = [
        F.col("ranking_score").desc(),
        F.col("ai_match_score").desc(),
        F.col("keyword_score").desc(),
        F.col(order),
    ]
    top = ranked.where(F.col("ai_match_score") >= min_fit).orderBy(*best).limit(max_count)
    # max_count rows are left, so one partition is right for numbering them.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*best)))
