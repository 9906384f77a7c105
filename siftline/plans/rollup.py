"""Weekly marts from daily states: sums and counts that are kept and merged.

A batch of history rows adds one row per day and group to a table of states, in a
folder of its own that a repeated batch overwrites.  A week's mart then reads the
states of its days, whatever the size of history.  States are sums, so late rows
just add to their day, and a row that changes is taken out as it was (``sign=-1``)
and added as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.freshness import DAY_MICROS, as_timestamp, days_back, parse_instant
from siftline.operators.scoring import FIT_MIN
from siftline.plans.marts import AsOf

# Mart: what it groups by, with the column of history, and the group it leaves out when blank.
MARTS: dict[str, tuple[dict[str, str], str | None]] = {
    "weekly_source": ({"source": "source"}, None),
    "weekly_company_type": ({"company_type": "company_type", "confidence": "company_type_confidence"}, "company_type"),
    "weekly_experience": ({"experience_required": "experience_required"}, "experience_required"),
}
_SUMS = ("n", "passed", "recommended", "score", "scored", "posted", "dated")


def day_states(rows: DataFrame, mart: str, sign: int = 1) -> DataFrame:
    """State of history rows by day of first sight and group of a mart."""
    keys, filled = MARTS[mart]
    posted = F.unix_micros(parse_instant(F.col("posted_date"))).cast("decimal(20,0)")
    values = {
        "n": F.lit(1),
        "passed": (F.col("prefilter_passed") == 1).cast("int"),
        "recommended": (F.col("ai_match_score") >= FIT_MIN).cast("int"),
        "score": F.col("ai_match_score"),
        "scored": F.col("ai_match_score").isNotNull().cast("int"),
        "posted": posted,
        "dated": posted.isNotNull().cast("int"),
    }
    kept = rows if filled is None else rows.where(F.col(filled) != "")
    return kept.groupBy(F.to_date("first_seen").alias("day"), *[F.col(c).alias(k) for k, c in keys.items()]).agg(
        *[(F.lit(sign) * F.coalesce(F.sum(v), F.lit(0))).alias(name) for name, v in values.items()]
    )


def add_states(states: DataFrame, root: str, mart: str, batch: int) -> None:
    """Keep the states of a batch below ``root``; a repeated batch replaces its own."""
    states.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{mart}/batch={int(batch)}")


def read_states(spark: SparkSession, root: str, mart: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{mart}").drop("batch")


def weekly(states: DataFrame, mart: str, as_of: AsOf) -> DataFrame:
    """The mart of the week before ``as_of``, with the columns it has when it is made from history."""
    keys = list(MARTS[mart][0])
    week = states.where(F.col("day") >= days_back(as_of, 7)).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    week = week.where("n > 0")  # groups whose rows have all been taken out
    fit = _mean(F.col("score"), F.col("scored"))
    if mart == "weekly_source":
        clock = F.unix_micros(as_timestamp(as_of)).cast("decimal(20,0)")
        age = (F.col("dated") * clock - F.col("posted")).cast("double") / DAY_MICROS
        return week.select(
            *keys, F.col("n").alias("total"), F.col("passed").alias("passed_prefilter"), "recommended",
            fit.alias("avg_score"), _mean(age, F.col("dated")).alias("avg_posting_days"),
        )
    counted = [*keys, F.col("n").alias("job_count"), fit.alias("avg_ai_score")]
    if mart == "weekly_company_type":
        counted.append(F.round(F.lit(100.0) * F.col("recommended") / F.col("n"), 1).alias("pct_recommended"))
    return week.select(*counted)


def _mean(total: Column, n: Column) -> Column:
    return F.round(F.when(n > 0, total / n), 1)
