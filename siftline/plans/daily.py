"""The daily job: from a batch of postings to a shortlist, history and a run row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from siftline.functions import freshness as D
from siftline.functions import rules as R
from siftline.functions import scores as S
from siftline.functions.text import cut
from siftline.operators import companies as C
from siftline.operators.canonical import merge_cross_platform, with_merge_columns
from siftline.operators.dedup import already_seen, latest_sightings, new_rows, touch
from siftline.operators.history import KeyedHistory
from siftline.operators.ranking import (
    MAX_RECOMMENDATIONS,
    top_recommendations,
    with_ranking_score,
)
from siftline.operators.scoring import (
    DAILY_BUDGET_USD,
    PREFILTER_MIN,
    attach_responses,
    enrich_shortlist,
    score_postings,
    search_address,
    spend_budget,
    with_keyword_score,
)
from siftline.operators.state import apply_updates, first_sight, replace_rows, run_row
from siftline.plans.marts import AsOf
from siftline.schemas import COMPANY_CACHE, SEEN, SEEN_COLUMNS, SOURCE_ORDER, struct_of
from siftline.session import stage as stage_table
from siftline.sources.common import numbered, source_counts, with_dedup_key, zero_result_errors

# Age in days beyond which a posting is dropped.
MAX_AGE_DAYS = 30


@dataclass(frozen=True)
class DailyRun:
    """Everything a run produces.

    ``history`` holds the rows first seen in this run and ``sightings`` the keys
    seen again: both are appended, older history is not rewritten.  ``seen`` is
    the same state as one table.
    """

    scored: DataFrame
    shortlist: DataFrame
    history: DataFrame
    sightings: DataFrame
    seen: DataFrame
    new_companies: DataFrame
    run: DataFrame


def posting_features(
    postings: DataFrame,
    profile: R.Profile,
    as_of: AsOf,
    employer_rules: R.Rules = R.EMPLOYER_RULES,
    min_score: float = PREFILTER_MIN,
) -> DataFrame:
    """All that is ever asked of the job text, in one pass where it lies.

    The text itself is then dropped: no shuffle of the job carries it.
    """
    days = D.effective_freshness_days(F.col("posted_date"), F.col("scraped_at"), as_of)
    keyed = with_merge_columns(postings)
    named = C.with_company_columns(keyed, employer_rules)
    scored = with_keyword_score(named, profile, min_score)
    return (
        scored.withColumn("jd_language", R.text_language(F.col("jd_text")))
        .withColumn("freshness_days", days)
        .withColumn(
            "effective_date", D.effective_date(F.col("posted_date"), F.col("scraped_at"))
        )
        .withColumn("freshness_label", D.freshness_label(F.col("freshness_days")))
        .drop("jd_text")
    )


def _sum_rows(parts: Sequence[DataFrame], run_id: int) -> DataFrame:
    """One row out of several one-row aggregates with different columns."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    totals = [
        (F.max(c) if c == "errors" else F.coalesce(F.sum(c), F.lit(0))).alias(c)
        for c in rows.columns
    ]
    return rows.agg(*totals).withColumn("run_id", F.lit(run_id).cast("bigint"))


def run_daily(
    postings: DataFrame,
    seen: DataFrame,
    cache: DataFrame,
    profile: R.Profile,
    as_of: AsOf,
    run_id: int,
    responses: DataFrame | None = None,
    snippets: DataFrame | None = None,
    enrichments: DataFrame | None = None,
    employer_rules: R.Rules = R.EMPLOYER_RULES,
    sources: Sequence[str] = SOURCE_ORDER,
    max_age_days: int = MAX_AGE_DAYS,
    min_score: float = PREFILTER_MIN,
    budget_usd: float = DAILY_BUDGET_USD,
    max_searches: int = C.MAX_SEARCHES,
    max_recommendations: int = MAX_RECOMMENDATIONS,
    kept_text: int | None = None,
    duration_seconds: float = 0.0,
    stage: Callable[[DataFrame, str], DataFrame] = stage_table,
) -> DailyRun:
    """New keys -> merge -> age cutoff -> employer class -> scores -> shortlist.

    ``stage`` writes an intermediate table once and reads it back.  The tables
    that are needed more than once are staged, the batch first: payloads and
    pages are parsed once, and its later readers take only the columns they need.
    ``kept_text`` cuts the job texts that go into history.
    """
    if "dedup_key" not in postings.columns:
        postings = with_dedup_key(postings)
    postings = stage(postings, "batch")
    features = posting_features(postings, profile, as_of, employer_rules, min_score)
    fresh = numbered(stage(new_rows(features, seen), "fresh"), stage)

    merged = merge_cross_platform(fresh).where(
        D.within_age(F.col("freshness_days"), max_age_days)
    )
    if responses is not None:
        merged = attach_responses(merged, responses)
    kept = stage(merged, "kept")

    verdicts = stage(
        C.company_verdicts(
            kept, cache, snippets, employer_rules, max_searches, order="merge_order"
        ),
        "verdicts",
    )
    settled = (
        score_postings(kept) if responses is None
        else spend_budget(kept, budget_usd, order="merge_order")
    )
    classified = C.classify_postings(settled, verdicts, order="merge_order")
    scored = stage(
        with_ranking_score(classified).withColumn("run_id", F.lit(run_id).cast("bigint")), "scored"
    )

    spent = scored.groupBy("run_id").agg(F.sum("spent_units").alias("spent_units"))
    best = top_recommendations(scored, max_recommendations, order="merge_order")
    shortlist = stage(
        enrich_shortlist(best, enrichments, spent, budget_usd).withColumn(
            "linkedin_search_url", search_address()
        ),
        "shortlist",
    )

    # The shortlist has at most max_recommendations rows, so it is broadcast.
    extra = [*S.ENRICHMENT_FIELDS, "linkedin_search_url"]
    chosen = F.broadcast(
        shortlist.select("dedup_key", *extra, F.col("positioning_advice").alias("_advice"))
    )
    updates = (
        scored.join(chosen, "dedup_key", "left")
        .withColumn("positioning_advice", F.coalesce("_advice", "positioning_advice"))
        .withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in extra})
    )
    first_rows = first_sight(fresh, as_of, keep=["arrival"])
    # The one shuffle of job texts: those of processed postings, by arrival.
    text = F.col("jd_text") if kept_text is None else cut(F.col("jd_text"), kept_text)
    texts = postings.select(F.col("seq").alias("arrival"), text.alias("_text")).join(
        scored.select("arrival"), "arrival", "left_semi"
    )
    history = (
        apply_updates(first_rows, updates, as_of)
        .join(texts, "arrival", "left")
        .withColumn("jd_text", F.coalesce("_text", "jd_text"))
        .select(*SEEN_COLUMNS)
    )
    # Distinct first: it combines before the shuffle, however often a key recurs.
    batch_keys = postings.select("dedup_key").distinct()
    sightings = already_seen(batch_keys, seen).withColumn("seen_at", D.as_timestamp(as_of))

    counts = source_counts(postings, sources)
    metrics = _sum_rows(
        [
            postings.agg(F.count("*").alias("jobs_scraped")),
            scored.agg(
                F.count("*").alias("jobs_new"),
                F.sum("prefilter_passed").alias("jobs_matched"),
                F.sum("prefilter_passed").alias("jobs_prefilter_passed"),
                F.sum("spent_units").alias("units"),
            ),
            shortlist.agg(
                F.count(F.when(F.col("company_intro") != "", 1)).alias("jobs_enriched"),
                F.count("*").alias("jobs_recommended"),
                F.sum("enrich_units").alias("units"),
            ),
            zero_result_errors(counts),
        ],
        run_id,
    )
    run = run_row(
        metrics.withColumn("api_cost_usd", S.usd(F.col("units")))
        .withColumn("run_date", D.as_timestamp(as_of))
        .withColumn("duration_seconds", F.lit(float(duration_seconds)))
    )
    return DailyRun(
        scored=scored,
        shortlist=shortlist,
        history=history,
        sightings=sightings,
        seen=touch(seen, postings, as_of).unionByName(history),
        new_companies=C.cache_entries(verdicts, as_of),
        run=run,
    )


def keep_run(result: DailyRun, history: KeyedHistory, as_of: AsOf, run_id: int) -> None:
    """Add a run to a history that is kept in buckets: its new rows, and a touch for the keys seen again.

    A repeated run replaces its own part; ``seen`` of the next one is ``history.read()``.
    """
    history.insert(result.history, run_id)
    history.touch(result.sightings, as_of, run_id)


def load_state(spark: SparkSession, root: str, before_run: int) -> tuple[DataFrame, DataFrame]:
    """History and employer cache as the runs below ``before_run`` left them.

    A run that is repeated finds the state that it found the first time.  Keys
    seen again have their last sight, and an employer its latest verdict.
    """
    seen, cache = struct_of(SEEN), struct_of(COMPANY_CACHE)
    sight = StructType([seen["dedup_key"], StructField("seen_at", TimestampType())])

    def table(name: str, schema: StructType) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.createDataFrame([], schema)
        stored = StructType([*schema.fields, StructField("batch", LongType())])
        return spark.read.schema(stored).parquet(path).where(F.col("batch") < before_run).drop("batch")

    known = replace_rows(
        spark.createDataFrame([], cache), table("new_companies", cache), "normalized_name", newest="verified_at"
    )
    return latest_sightings(table("history", seen), table("sightings", sight)), known


def save_run(result: DailyRun, root: str, run_id: int) -> None:
    """Append a run below ``root``: one folder per run and table.

    A repeated run overwrites its own folders, and no other run's.
    """
    for name in ("history", "sightings", "new_companies", "run", "shortlist"):
        path = f"{root.rstrip('/')}/{name}/batch={run_id}"
        getattr(result, name).write.mode("overwrite").parquet(path)
