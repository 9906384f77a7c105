"""New-key detection and history upkeep as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siftline.operators.dedup import latest_sightings

_BATCH = "batch_id"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_sightings(
    stream: DataFrame, key: str = "dedup_key", event_time: str | None = None, delay: str = ""
) -> DataFrame:
    """Rows whose key the stream had not shown before.

    Keys are never forgotten, so state grows with the number of keys (use the
    RocksDB store).  With ``event_time`` and ``delay`` state is bounded, and a
    key that comes back later than that is new again.
    """
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def write_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run ``stream`` over all that is available, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


class _Sightings(StatefulProcessor):
    """Whether a key is known, and until when; of a micro-batch's rows only the earliest is held."""

    def __init__(self, columns: list[str], forget_ms: int | None) -> None:
        self.columns, self.forget_ms = columns, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_us long")

    def _remember(self, last_us: int) -> bool:
        """Note a sight; whether the key wasn't known."""
        state = self.last.get()  # each call goes to the store and back
        known = state[0] if state is not None else None
        if known is not None and last_us <= known:
            return False
        self.last.update((last_us,))
        if self.forget_ms is not None:
            if known is not None:
                self.handle.deleteTimer(known // 1000 + self.forget_ms)
            self.handle.registerTimer(last_us // 1000 + self.forget_ms)
        return known is None

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = last = None
        for row in rows:
            if first is None or row["seq"] < first["seq"]:
                first = row
            last = row["last_us"] if last is None else max(last, row["last_us"])
        yield Row(**{c: first[c] for c in self.columns}, last_us=last, new=self._remember(last))

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self._remember(initialState["last_us"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def sightings(
    stream: DataFrame, forget_after: timedelta | None = None, delay: str = "0 seconds", known: DataFrame | None = None
) -> DataFrame:
    """A row per key and micro-batch: the earliest of its rows, ``last_us``, the time of the last, and ``new`` where the key wasn't known.

    Known keys are keyed state; nothing that was written before is read.  With
    ``forget_after`` a key is forgotten when the watermark, ``delay`` behind the
    latest ``seen_at``, has passed its last sight by so long: a timer clears its
    state, and if it comes back it is new.  ``known(dedup_key, seen_at)`` is the
    state to begin with, such as a history that exists.

    Rows need ``dedup_key``, ``seq`` and ``seen_at``.
    """
    columns = stream.columns
    micros = F.unix_micros("seen_at")
    timed = stream if forget_after is None else stream.withWatermark("seen_at", delay)
    rows = timed.select("*", micros.alias("last_us"))
    schema = T.StructType([*stream.schema.fields, T.StructField("last_us", T.LongType()), T.StructField("new", T.BooleanType())])
    start = None
    if known is not None:
        start = known.groupBy("dedup_key").agg(F.max(micros).alias("last_us")).groupBy("dedup_key")
    forget_ms = None if forget_after is None else int(forget_after.total_seconds() * 1000)
    return rows.groupBy("dedup_key").transformWithState(
        _Sightings(columns, forget_ms), schema, "Update", "None" if forget_after is None else "EventTime", start
    )


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
    return spark.read.schema(stored).parquet(path)


def _sighting_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([schema["dedup_key"], T.StructField("seen_at", T.TimestampType())])


def history_writer(root: str, columns: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps the output of :func:`sightings` below ``root``.

    A micro-batch adds its first sightings to ``history`` and the last time of
    each of its keys to ``sightings``, in folders named after the batch.  A
    replayed batch starts from the same state and overwrites its own folders, so
    replays change nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two tables come from one micro-batch; without this its state would be
        # updated twice.
        batch.persist()
        try:
            batch.where("new").select(*columns).write.mode("overwrite").parquet(f"{root}/history/{_BATCH}={batch_id}")
            last = batch.select("dedup_key", F.timestamp_micros("last_us").alias("seen_at"))
            last.write.mode("overwrite").parquet(f"{root}/sightings/{_BATCH}={batch_id}")
        finally:
            batch.unpersist()

    return write


def keep_history(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    forget_after: timedelta | None = None,
    delay: str = "0 seconds",
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Fold all that ``stream`` has available into the history below ``root``.

    How much a micro-batch takes is up to the source, such as its option
    ``maxFilesPerTrigger``.
    """
    spark, schema = stream.sparkSession, stream.schema
    for name, kind in (("history", schema), ("sightings", _sighting_schema(schema))):
        # An empty first folder gives readers a table to find.
        spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{root}/{name}/{_BATCH}=-1")
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)  # the store of keyed state; a query keeps what it was started with
    try:
        return (
            sightings(stream, forget_after, delay, known)
            .writeStream.foreachBatch(history_writer(root, stream.columns))
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STORE, before)


def read_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """History with ``first_seen`` and ``last_seen`` per key.

    A key that was forgotten and came back has a row for each time it was new.
    """
    history = (
        _table(spark, f"{root}/history", schema)
        .drop(_BATCH)
        .withColumnRenamed("seen_at", "first_seen")
        .withColumn("last_seen", F.col("first_seen"))
    )
    return latest_sightings(history, _table(spark, f"{root}/sightings", _sighting_schema(schema)))
