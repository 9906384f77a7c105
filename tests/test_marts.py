"""Marts on empty input, and the daily job's state over two runs."""

import pytest
from pyspark.sql import functions as F

from siftline.functions.rules import Profile
from siftline.plans import marts as M
from siftline.plans.daily import load_state, run_daily, save_run
from siftline.plans.exports import daily_exports, exports_due, write_exports
from siftline.plans.weekly import weekly_report
from siftline.schemas import COMPANY_CACHE, POSTINGS, RUNS, SEEN, struct_of
from siftline.sources.common import with_dedup_key
from tests.conftest import AS_OF


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], struct_of(SEEN)), spark.createDataFrame([], struct_of(RUNS))


def test_empty_week(nothing):
    seen, runs = nothing
    health = M.weekly_health(runs, AS_OF).collect()
    assert len(health) == 1
    assert (health[0].total_scraped, health[0].prefilter_rate, health[0].total_runs) == (None, 0.0, 0)
    assert health[0].failed_sources is None
    trends = M.weekly_trends(seen, runs, AS_OF).collect()
    assert [(r.metric, r.this_week, r.change_pct, r.direction) for r in trends] == [
        (m, 0.0, None, "flat") for m in ("total_scraped", "unique_new", "recommended", "avg_score")
    ]
    assert M.experience_bands(seen, AS_OF).count() == 0
    assert M.skill_mentions(seen, AS_OF, Profile()).dtypes[0] == ("skill", "string")
    assert M.spend_on(runs, AS_OF).collect()[0][0] == 0.0


def test_report_and_exports_skip_empty_sets(nothing, tmp_path):
    seen, runs = nothing
    report = weekly_report(seen, runs, Profile(("a",)), AS_OF)
    assert len(report) == 7
    assert set(write_exports(report, str(tmp_path))) == {"weekly_health", "weekly_trends"}
    assert write_exports(daily_exports(seen, runs, AS_OF), str(tmp_path)) == []


def test_weekly_report_is_due_on_sundays(nothing):
    seen, runs = nothing
    due = {d: len(exports_due(seen, runs, Profile(), f"2024-01-{d} 06:00:00")) for d in (27, 28, 29)}
    assert due == {27: 3, 28: 10, 29: 3}


def posting(seq, source, number, title, company, text, posted="2024-01-30"):
    return (seq, source, number, "u", title, company, "", "", "", posted, "", text)


@pytest.fixture(scope="module")
def batch(spark):
    rows = [
        posting(0, "saramin", "1", "Data Analyst", "Acme Inc.", "sql sql python"),
        posting(1, "wanted", "7", "data analyst", "ACME", "sql"),  # the same opening
        posting(2, "saramin", "1", "Seen twice", "Acme Inc.", "sql"),
        posting(3, "wanted", "8", "Old one", "Beta", "sql", "2023-01-01"),
        posting(4, "wanted", "9", "Senior", "Gamma", "nothing asked for"),
        posting(5, "incruit", "3", "", "", "python global"),
    ]
    df = spark.createDataFrame([r + (None,) for r in rows], POSTINGS)
    return with_dedup_key(df.withColumn("scraped_at", F.lit(AS_OF).cast("timestamp")))


def test_two_runs(spark, nothing, batch, tmp_path):
    seen, _ = nothing
    cache = spark.createDataFrame([], struct_of(COMPANY_CACHE))
    profile = Profile(("sql", "python"), ("global",), ("senior",))
    day1 = run_daily(batch, seen, cache, profile, AS_OF, 1)
    run = day1.run.collect()[0]
    assert (run.jobs_scraped, run.jobs_new, run.jobs_matched, run.jobs_recommended) == (6, 3, 2, 0)
    assert run.errors == "jobkorea: zero results"
    state = {r.dedup_key: r for r in day1.seen.collect()}
    assert set(state) == {"saramin:1", "wanted:7", "wanted:8", "wanted:9", "incruit:3"}
    assert state["saramin:1"].canonical_group_id == "saramin:1+wanted"
    assert state["saramin:1"].ai_match_score == 30.0
    # The loser of the merge and the stale posting keep their defaults.
    for key in ("wanted:7", "wanted:8"):
        assert (state[key].ai_match_score, state[key].canonical_key, state[key].company_type) == (0.0, "", "")
    assert state["incruit:3"].keyword_score == 5.0 and state["wanted:9"].keyword_score == 0.0
    assert day1.sightings.count() == 0

    save_run(day1, str(tmp_path), 1)
    save_run(day1, str(tmp_path), 1)  # a repeated run replaces its own output only
    assert load_state(spark, str(tmp_path), 1)[0].count() == 0  # a repeat finds what the run found
    stored, cache = load_state(spark, str(tmp_path), 2)
    assert stored.count() == 5
    assert {r.normalized_name for r in cache.collect()} == {r.normalized_name for r in day1.new_companies.collect()}

    responses = spark.createDataFrame([], "dedup_key string, response_text string, input_tokens long, output_tokens long")
    day2 = run_daily(batch, stored, cache, profile, "2024-02-01 00:00:00", 2, responses=responses)
    run = day2.run.collect()[0]
    assert (run.run_id, run.jobs_new, run.jobs_recommended, run.api_cost_usd) == (2, 0, 0, 0.0)
    assert day2.sightings.count() == 5 and day2.history.count() == 0
    after = {r.dedup_key: r for r in day2.seen.collect()}
    assert set(after) == set(state)
    assert all(r.last_seen.month == 2 and r.first_seen.month == 1 for r in after.values())
    save_run(day2, str(tmp_path), 2)
    later = {r.dedup_key: (r.first_seen, r.last_seen) for r in load_state(spark, str(tmp_path), 3)[0].collect()}
    assert later == {k: (r.first_seen, r.last_seen) for k, r in after.items()}
    assert day2.new_companies.count() == 0
