"""History as a log-structured table against whole-table transformations, and its plans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftline.operators import dedup, state
from siftline.operators.history import KeyedHistory
from siftline.schemas import SEEN, struct_of
from siftline.session import stage

DAY = "2024-01-{:02d} 00:00:00"


def wide(spark, keys, day, buckets=4):
    base = spark.createDataFrame([(k,) for k in keys], "dedup_key string")
    rows = base.select(
        "dedup_key", F.lit("s").alias("source"), F.lit("1").alias("source_id"), F.upper("dedup_key").alias("title"),
        F.lit("c").alias("company"), F.lit("u").alias("url"),
    )
    return state.first_sight(rows, DAY.format(day)).withColumn("jd_text", F.repeat("dedup_key", 50)).repartition(3)


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(tuple, df.select(columns).collect()))


@pytest.fixture
def store(spark, tmp_path):
    kept = KeyedHistory(spark, str(tmp_path / "kept"), buckets=4)
    kept.insert(wide(spark, [f"k{i}" for i in range(40)], 1), 1)
    return kept


def updates(spark, keys, score):
    return spark.createDataFrame([(k, score, "2024-01-05", f"text of {k}") for k in keys], "dedup_key string, ai_match_score double, posted_date string, jd_text string")


def test_equals_whole_table_transformations(spark, store):
    want = wide(spark, [f"k{i}" for i in range(40)], 1)
    keys = spark.createDataFrame([(f"k{i}",) for i in [*range(30, 50), 30, 30]], "dedup_key string")
    new = updates(spark, ["k1", "k35", "unknown"], 70.0)
    scores = spark.createDataFrame([("k1", 9.0), ("k2", 8.0), ("k3", None), ("unknown", 1.0)], "dedup_key string, score double")

    store.touch(keys, DAY.format(3), 2)
    store.update(new, DAY.format(4), 2, kept_text=6)
    want = state.apply_updates(dedup.touch(want, keys, DAY.format(3)), new, DAY.format(4), kept_text=6)
    assert rows_of(store.read()) == rows_of(want)
    store.set_scores(scores, 3)
    want = state.set_score(want, scores)
    store.insert(wide(spark, ["z1", "z2"], 6), 3)
    want = want.unionByName(wide(spark, ["z1", "z2"], 6))
    assert rows_of(store.read()) == rows_of(want)

    before = rows_of(store.read())
    store.compact(3)
    assert store.change_rows() == 0 and rows_of(store.read()) == before
    # Another session's view, by the files alone.
    again = KeyedHistory(spark, store.root, buckets=4)
    assert (again.generation, again.folded) == (1, 3) and rows_of(again.read()) == before
    store.touch(keys, DAY.format(9), 4)
    store.drop_folded()
    want = dedup.touch(want, keys, DAY.format(9))
    assert rows_of(store.read()) == rows_of(want)
    assert rows_of(KeyedHistory(spark, store.root, buckets=4).read()) == rows_of(want)


def test_a_repeated_run_replaces_its_own(spark, store):
    keys = spark.createDataFrame([("k1",)], "dedup_key string")
    for day in (7, 8):
        store.insert(wide(spark, ["n1"], day), 2)
        store.touch(keys, DAY.format(day), 2)
    seen = {r.dedup_key: r.last_seen for r in store.read().collect()}
    assert len(seen) == 41 == store.read().count()
    assert seen["n1"] == seen["k1"] == datetime(2024, 1, 8)
    store.compact(2)
    with pytest.raises(ValueError):
        store.touch(keys, DAY.format(9), 2)


def test_a_compaction_that_breaks_off_changes_nothing(spark, store, monkeypatch):
    store.touch(spark.createDataFrame([("k1",)], "dedup_key string"), DAY.format(9), 2)
    before = rows_of(store.read())
    monkeypatch.setattr(KeyedHistory, "_open", lambda self: (_ for _ in ()).throw(OSError("lost")))
    write = KeyedHistory._write

    def broken(self, *args, **options):
        write(self, *args, **options)
        raise OSError("lost")

    monkeypatch.setattr(KeyedHistory, "_write", broken)
    with pytest.raises(OSError):
        store.compact(2)
    monkeypatch.undo()
    again = KeyedHistory(spark, store.root, buckets=4)
    assert again.generation == 0 and rows_of(again.read()) == before
    again.compact(2)  # over what the broken one left
    assert again.generation == 1 and rows_of(again.read()) == before


def test_nulls_can_be_given(spark, store):
    store.update(spark.createDataFrame([("k1", None)], "dedup_key string, location string"), DAY.format(2), 2)
    row = store.read().where("dedup_key = 'k1'").first()
    assert row.location is None and row.title == "K1"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_neither_shuffled_nor_sorted(spark, store):
    store.touch(spark.createDataFrame([("k1",)], "dedup_key string"), DAY.format(2), 2)
    store.update(updates(spark, ["k1"], 70.0), DAY.format(4), 2)
    text = plan(store.read())
    assert "jd_text" in text and "ShuffledHashJoin" in text
    assert "Exchange" not in text
    # Only logs are sorted.
    assert text.count("Sort [") == 2
    assert text.index("_rows_0[") < text.index("Sort [") < text.index("_touches[") < text.index("_updates[")
    # New keys: the batch goes to history's buckets.
    batch = stage(spark.range(100).selectExpr("concat('k', id) AS dedup_key", "id AS seq"), "batch")
    fresh = dedup.unseen(batch.hint("merge"), store.keys())
    assert plan(fresh).count("Exchange hashpartitioning") == 1
    assert fresh.count() == 60


def test_columns_not_asked_for_are_not_read(spark, store):
    store.touch(spark.createDataFrame([("k1",)], "dedup_key string"), DAY.format(2), 2)
    assert "jd_text" not in plan(store.read().select("dedup_key", "last_seen"))


def test_default_schema(spark, tmp_path):
    assert KeyedHistory(spark, str(tmp_path / "h"), buckets=2).columns == struct_of(SEEN).fieldNames()
