"""The plans are the ones the operators were written for."""

import re

import pytest
from pyspark.sql import functions as F

from siftline.catalog.fixtures import AS_OF, EMPLOYERS, PROFILE, Tables
from siftline.operators import canonical, companies, dedup, skew, state
from siftline.plans import marts as M
from siftline.plans.daily import posting_features
from siftline.operators.ranking import top_recommendations

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details(df):
    """Formatted plan, with read schemas and pushed filters in full."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Round|single)", plan(df)))


def test_features_never_shuffle_and_only_keywords_leave_the_jvm(tables):
    """Keywords are found by one automaton in Arrow batches; all other features stay in the JVM."""
    df = posting_features(tables.postings, PROFILE, AS_OF, EMPLOYERS)
    text = plan(df)
    assert text.count("ArrowEvalPython") == 1 == text.count("[pythonUDF0") and "BatchEvalPython" not in text
    assert "Window" not in text and exchanges(df) == 0
    assert "jd_text" not in df.columns


def test_caps_are_cut_before_the_shuffle(tables):
    text = plan(dedup.cap_per_source(tables.postings.select("source", "seq"), 50))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert plan(dedup.keep_first(tables.postings.select("dedup_key", "seq"))).count("WindowGroupLimit") == 2


def test_top_k_does_not_sort_everything(tables):
    ranked = tables.seen.withColumn("merge_order", F.xxhash64("dedup_key"))
    assert "TakeOrderedAndProject" in plan(top_recommendations(ranked, order="merge_order"))
    assert "TakeOrderedAndProject" in plan(M.recommendations_today(tables.seen, AS_OF))


def test_first_patterns_combine_in_hash_maps(tables):
    df = companies.first_patterns(companies.with_company_columns(tables.postings, EMPLOYERS))
    text = plan(df)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "partial_min_by" in text


def test_lookup_scatters_hot_rows_over_the_shuffle(frame):
    facts = frame([(i, "k") for i in range(9)], "seq long, k string")
    dim = frame([("k", 9, "v")], "k string, n long, v string").hint("merge")
    text = plan(skew.lookup(facts, dim, "k", weight="n", spread_by="seq").hint("merge"))
    assert "SortMergeJoin" in text
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len([k for k in keys if "_light_key" in k and "_salt" in k]) == 2


def test_merge_has_one_rule_for_every_group(frame):
    """Map-side aggregates by key and source; no broadcast, no switch by size."""
    df = frame(
        [(i, "s", f"k{i % 3}", i % 5, f"s:{i}") for i in range(30)],
        "seq long, source string, canonical_key string, completeness int, dedup_key string",
    )
    text = canonical.merge_cross_platform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in text
    assert "Aggregate [canonical_key" in text and "source" in text


def test_marts_read_only_their_columns_and_push_filters(spark, tmp_path, tables):
    path = str(tmp_path / "seen")
    tables.seen.write.parquet(path)
    seen = spark.read.parquet(path)
    text = details(M.weekly_source(seen, AS_OF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "source", "prefilter_passed", "ai_match_score", "posted_date", "first_seen",
    }
    assert "GreaterThanOrEqual(first_seen" in text
    assert exchanges(M.weekly_source(seen, AS_OF)) == 1
    trends = M.weekly_trends(seen, tables.runs, AS_OF)
    assert details(trends).count(f"{path}]") == 1


def test_bucketed_keys_are_not_shuffled(spark, tmp_path, tables):
    keys = tables.postings.select("dedup_key")
    for _ in range(2):  # a second run adds to the same buckets
        state.add_keys(keys, "seen_keys", 8, path=str(tmp_path / "keys"))
    try:
        batch = tables.postings.select("dedup_key", "seq").hint("merge")
        fresh = dedup.unseen(batch, spark.table("seen_keys").hint("merge"))
        text = plan(fresh)
        assert "SortMergeJoin" in text
        assert len(re.findall(r"Exchange hashpartitioning\(dedup_key", text)) == 1
        assert fresh.count() == 0
    finally:
        spark.sql("DROP TABLE seen_keys")


def test_timestamps_without_zone_are_pushed_down_too(tables):
    from siftline.sources.common import recent

    assert "GreaterThanOrEqual(ts" in details(recent(tables.events, AS_OF, 10, "ts"))
