"""Wide history as a log-structured table: bucketed rows, a log of changes, compaction bucket by bucket.

History rows are wide, and a day touches many of them in a column or two.  Here
they are written once, in buckets by ``dedup_key``; a touch, an update or a score
goes to a log of its kind that has the key, the version and the columns given, in
the same buckets.  Reading joins rows and logs within buckets: no row of history is
shuffled or sorted, and no log but by who writes it.  :meth:`KeyedHistory.compact` folds
the logs into a new generation of rows, each bucket by itself.

Below the root lie ``rows-<generation>``, the logs, and ``generations``, with a marker
for each generation that is whole, written last.  Whatever is written lies in a
partition of its version and step, and a run that is repeated replaces its own.
Versions up to the one that a marker names are folded and can't be written again.

A bucket's changes since the last compaction are held in memory while its rows
stream by, so compact before they outgrow a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.functions.freshness import as_timestamp
from siftline.operators.state import update_columns
from siftline.schemas import SEEN, UPDATED_COLUMNS, struct_of

KEY = "dedup_key"
BUCKETS = 200
# The logs, in the order in which changes of one version take effect.
ROWS, TOUCHES, UPDATES, SCORES = range(4)
LOGS = {TOUCHES: "touches", UPDATES: "updates", SCORES: "scores"}


def _quoted(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


class KeyedHistory:
    """History below ``root``; ``buckets`` and ``schema`` are those it was begun with."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = BUCKETS, schema: T.StructType | None = None
    ) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.schema = schema or struct_of(SEEN)
        self.columns = [f.name for f in self.schema.fields]
        self._name = f"siftline_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"
        given = {TOUCHES: ["last_seen"], UPDATES: [*UPDATED_COLUMNS, "match_score", "last_seen"], SCORES: ["match_score"]}
        self._given = {
            log: [c for c in dict.fromkeys(columns) if c in self.columns] for log, columns in given.items()
        }
        self._logs = {log: self._table(name, self._log_fields(log)) for log, name in LOGS.items()}
        self._open()

    def _log_fields(self, log: int) -> list[T.StructField]:
        """The key, and each column that the log may give, boxed, so that a null can be given."""
        boxed = [T.StructField(c, T.StructType([T.StructField("v", self.schema[c].dataType)])) for c in self._given[log]]
        return [self.schema[KEY], *boxed]

    # Tables

    def _folder(self, name: str):
        """The file system's handle and path of a folder below the root."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _table(self, folder: str, fields: Sequence[T.StructField]) -> str:
        """Make the bucketed table at ``folder`` known to the session; files may lie there."""
        name = f"{self._name}_{folder.replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({_quoted(fields)}, version BIGINT, step INT) USING parquet "
                f"PARTITIONED BY (version, step) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.root}/{folder}'"
            )
        # Other sessions may have written since.
        files, path = self._folder(folder)
        files.mkdirs(path)
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(name)
        return name

    def _open(self) -> None:
        files, path = self._folder("generations")
        # A row per compaction.
        markers = (
            self.spark.read.schema("generation int, folded long").parquet(path.toString()).collect() if files.exists(path) else []
        )
        self.generation, self.folded = max(((m["generation"], m["folded"]) for m in markers), default=(0, -1))
        self._rows = self._table(f"rows-{self.generation}", self.schema.fields)

    def _write(self, df: DataFrame, table: str, version: int, step: int, dealt: bool = False) -> None:
        columns = [c for c in self.spark.table(table).columns if c not in ("version", "step")]
        if not dealt:
            df = df.repartition(self.buckets, KEY)  # a file per bucket
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (version = {int(version)}, step = {int(step)}) "
            f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{df}}",
            df=df,
        )

    def _check(self, version: int) -> None:
        if version <= self.folded:
            raise ValueError(f"version {version} is folded; the next is {self.folded + 1}")

    # Writing

    def insert(self, rows: DataFrame, version: int) -> None:
        """Add rows whose keys history lacks: a written table, not one that reads from here."""
        self._check(version)
        self._write(rows, self._rows, version, ROWS)

    def _log(self, changes: DataFrame, given: Mapping[str, Column], version: int, log: int) -> None:
        self._check(version)
        key, *fields = self._log_fields(log)
        cells = [
            (F.struct(given[f.name].cast(f.dataType["v"].dataType).alias("v")) if f.name in given else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in fields
        ]
        self._write(changes.select(key.name, *cells), self._logs[log], version, log)

    def touch(self, keys: DataFrame, as_of: datetime | str | Column, version: int) -> None:
        """Move ``last_seen`` of the rows that have one of ``keys``; others are passed over."""
        self._log(keys.select(KEY).distinct(), {"last_seen": as_timestamp(as_of)}, version, TOUCHES)

    def update(
        self, updates: DataFrame, as_of: datetime | str | Column, version: int, kept_text: int | None = None
    ) -> None:
        """Overwrite the processed columns that ``updates`` has (one row per key)."""
        self._log(updates, update_columns(updates, as_of, kept_text), version, UPDATES)

    def set_scores(self, scores: DataFrame, version: int) -> None:
        """Overwrite ``match_score`` from ``scores(dedup_key, score)`` where there is one."""
        self._log(scores.where("score IS NOT NULL"), {"match_score": F.col("score")}, version, SCORES)

    # Reading

    def keys(self, before: int | None = None) -> DataFrame:
        """The keys of history, or those older than a version, in its buckets: a join leaves them where they are."""
        rows = self.spark.table(self._rows)
        return (rows if before is None else rows.where(F.col("version") < before)).select(KEY)

    def _written(self, log: int) -> bool:
        """Whether the log has anything that no compaction has folded."""
        return bool(self.spark.sql(f"SHOW PARTITIONS {self._logs[log]}").where(f"cast(regexp_extract(partition, 'version=(\\\\d+)', 1) AS long) > {self.folded}").take(1))

    def _unfolded(self, log: int) -> DataFrame:
        return self.spark.table(self._logs[log]).where(F.col("version") > self.folded)

    def changes(self, log: int) -> DataFrame:
        """The last value that a log gave to each of its columns, by key, as (version, value); null where it gave none."""
        last = [F.max_by(F.struct("version", F.col(c)["v"].alias("v")), F.when(F.col(c).isNotNull(), F.col("version"))).alias(c) for c in self._given[log]]
        return self._unfolded(log).groupBy(KEY).agg(*last)

    def read(self) -> DataFrame:
        """History as all versions so far left it."""
        rows = self.spark.table(self._rows).select(*self.columns)
        cells: dict[str, list[Column]] = {}
        for log, name in LOGS.items():
            if self._given[log] and self._written(log):
                # A log is the narrow side; to sort the wide one by key would gain nothing.
                last = self.changes(log).select(KEY, F.struct(*self._given[log]).alias(f"_{name}")).hint("shuffle_hash")
                rows = rows.join(last, KEY, "left")
                for c in self._given[log]:
                    cells.setdefault(c, []).append(F.col(f"_{name}.{c}"))
        return rows.select(*[self._latest(c, cells.get(c, [])).alias(c) for c in self.columns])

    @staticmethod
    def _latest(column: str, given: list[Column]) -> Column:
        """The value of the latest version, of the later log where versions tie, else the row's own."""
        newest, value = F.lit(-1), F.col(column)
        for cell in given:
            version = F.coalesce(cell["version"], F.lit(-2))
            value = F.when(version >= newest, cell["v"]).otherwise(value)
            newest = F.greatest(newest, version)
        return value

    def change_rows(self) -> int:
        """Rows of the logs that no compaction has folded yet."""
        return sum(self._unfolded(log).count() for log in LOGS)

    def compact(self, version: int) -> None:
        """Fold the log up to ``version``, the last one written, into a new generation of rows.

        Every bucket is read and written by itself.  Readers see the old
        generation until the new one is whole; what it replaces stays until
        :meth:`drop_folded`.
        """
        self._check(version)
        generation = self.generation + 1
        fresh = self._table(f"rows-{generation}", self.schema.fields)
        self._write(self.read(), fresh, version, ROWS, dealt=True)
        marker = self.spark.createDataFrame([(generation, int(version))], "generation int, folded long")
        marker.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/generations/marker={generation}")
        self._open()

    def drop_folded(self) -> None:
        """Delete older generations and folded changes; call it when no reader needs them."""
        for generation in range(self.generation):
            name = f"{self._name}_rows_{generation}"
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            files, path = self._folder(f"rows-{generation}")
            files.delete(path, True)
        for log, name in LOGS.items():
            table = self._logs[log]
            folded = self.spark.table(table).where(F.col("version") <= self.folded).select("version", "step").distinct()
            for row in folded.collect():  # a row per run
                self.spark.sql(f"ALTER TABLE {table} DROP PARTITION (version = {row['version']}, step = {row['step']})")
                files, path = self._folder(f"{name}/version={row['version']}")
                files.delete(path, True)
