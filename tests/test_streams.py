"""A stream in several micro-batches ends where one batch does."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftline.operators import dedup
from siftline.streaming import streams

SCHEMA = "seq long, dedup_key string, seen_at timestamp"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    rng = random.Random(6)
    rows = [(i, f"k{rng.randrange(40)}") for i in range(300)]
    root = tmp_path_factory.mktemp("events")
    for n in range(4):
        part = rows[n * 75 : (n + 1) * 75]
        df = spark.createDataFrame(part, "seq long, dedup_key string").withColumn(
            "seen_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 60)
        )
        df.coalesce(1).write.mode("append").parquet(str(root))
    return str(root)


def stream(spark, files):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(files)


def expected(spark, files):
    rows = spark.read.schema(SCHEMA).parquet(files)
    first = dedup.keep_first(rows).select("dedup_key", "seq", F.col("seen_at").alias("first_seen"))
    last = rows.groupBy("dedup_key").agg(F.max("seen_at").alias("last_seen"))
    return {tuple(r) for r in first.join(last, "dedup_key").collect()}


def add_file(spark, folder, rows):
    """Rows (seq, key, minute) as one more file."""
    df = spark.createDataFrame(rows, "seq long, dedup_key string, minute long").select(
        "seq", "dedup_key", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("minute") * 60).alias("seen_at")
    )
    df.coalesce(1).write.mode("append").parquet(folder)


def current(spark, root):
    df = streams.read_history(spark, root, spark.createDataFrame([], SCHEMA).schema)
    return sorted(tuple(r) for r in df.select("dedup_key", "seq", "first_seen", "last_seen").collect())


def batches(root):
    return sorted(int(p.name.partition("=")[2]) for p in Path(root, "history").glob("batch_id=*"))


def test_history_in_bounded_batches(spark, files, tmp_path):
    root = str(tmp_path / "tables")
    streams.keep_history(stream(spark, files), root, str(tmp_path / "c")).awaitTermination()
    want, got = expected(spark, files), current(spark, root)
    assert batches(root) == [-1, 0, 1, 2, 3]
    # File order decides which sighting of a key came first, so compare ends.
    assert len(got) == len(want) and {(r[0], r[3]) for r in got} == {(r[0], r[3]) for r in want}


def test_restart_and_replay(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("files", "tables", "c"))
    add_file(spark, folder, [(1, "a", 0), (2, "b", 1), (3, "a", 2)])
    streams.keep_history(stream(spark, folder), root, checkpoint).awaitTermination()
    add_file(spark, folder, [(4, "a", 5), (5, "c", 6), (6, "c", 7)])
    streams.keep_history(stream(spark, folder), root, checkpoint).awaitTermination()
    once = current(spark, root)
    assert [(r[0], r[1], (r[3] - r[2]).seconds // 60) for r in once] == [("a", 1, 5), ("b", 2, 0), ("c", 5, 1)]
    # The last batch was written but not noted as done: it runs again, from the same state.
    for noted in (".1.crc", "1"):
        Path(checkpoint, "commits", noted).unlink(missing_ok=True)
    streams.keep_history(stream(spark, folder), root, checkpoint).awaitTermination()
    assert current(spark, root) == once and batches(root) == [-1, 0, 1]


def test_no_batch_reads_what_was_written(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("files", "tables", "c"))
    add_file(spark, folder, [(1, "a", 0)])
    streams.keep_history(stream(spark, folder), root, checkpoint).awaitTermination()
    for part in Path(root, "history", "batch_id=0").glob("part-*"):
        part.write_bytes(b"not parquet")
    add_file(spark, folder, [(2, "a", 5), (3, "b", 6)])
    streams.keep_history(stream(spark, folder), root, checkpoint).awaitTermination()
    new = spark.read.schema(SCHEMA).parquet(f"{root}/history/batch_id=1").collect()
    assert [r.dedup_key for r in new] == ["b"]


def test_keys_are_forgotten(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("files", "tables", "c"))

    def run(rows):
        add_file(spark, folder, rows)
        streams.keep_history(stream(spark, folder), root, checkpoint, forget_after=timedelta(minutes=60)).awaitTermination()

    run([(1, "a", 0), (2, "b", 0)])
    run([(3, "b", 50)])  # b is seen again: its timer moves
    run([(4, "c", 100)])  # the watermark passes minute 60, so a goes and b stays
    run([(5, "a", 101), (6, "b", 101)])
    got = [(key, seq) for key, seq, *_ in current(spark, root)]
    assert got == [("a", 1), ("a", 5), ("b", 2), ("c", 4)]


def test_a_history_to_begin_with(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("files", "tables", "c"))
    add_file(spark, folder, [(1, "a", 10), (2, "b", 10)])
    known = spark.sql("SELECT 'a' AS dedup_key, TIMESTAMP '2023-01-01' AS seen_at")
    streams.keep_history(stream(spark, folder), root, checkpoint, known=known).awaitTermination()
    assert [r[:2] for r in current(spark, root)] == [("b", 2)]


def test_first_sightings(spark, files, tmp_path):
    keys = streams.first_sightings(stream(spark, files).select("dedup_key"))
    streams.write_parquet(keys, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = [r.dedup_key for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(set(got)) and len(got) == len(expected(spark, files))


def test_bounded_variant_keeps_watermark(spark, files):
    bounded = streams.first_sightings(stream(spark, files), event_time="seen_at", delay="1 hour")
    assert bounded.isStreaming
    assert "Watermark" in bounded._jdf.queryExecution().analyzed().toString()
