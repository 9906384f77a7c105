"""What all sources share: column set, sequence numbers, union, counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.functions.freshness import as_timestamp, days_back
from siftline.functions.text import dedup_key
from siftline.operators.dedup import cap_per_source
from siftline.operators.numbering import dense_numbers
from siftline.schemas import POSTING_TEXTS, SOURCE_ORDER
from siftline.session import stage as stage_table

# Rows read per source and run, and days a source looks back.
MAX_PER_SOURCE = 50
RECENT_DAYS = 30

def document_seq(document: Column, position: Column) -> Column:
    """Where a posting stands: document and place in it, as one sortable value of any size."""
    return F.struct(document.cast("bigint").alias("document"), position.cast("bigint").alias("position"))


def as_postings(
    rows: DataFrame, source: str, as_of: datetime | str | Column
) -> DataFrame:
    """Fill in absent columns with blanks and put all into posting order."""
    present = set(rows.columns)
    texts = [
        F.lit(source).alias(c) if c == "source"
        else F.coalesce(F.col(c), F.lit("")).alias(c) if c in present
        else F.lit("").alias(c)
        for c in POSTING_TEXTS
    ]
    return rows.select("seq", *texts, as_timestamp(as_of).alias("scraped_at"))


def with_dedup_key(postings: DataFrame) -> DataFrame:
    return postings.withColumn("dedup_key", dedup_key(F.col("source"), F.col("source_id")))


def union_sources(
    frames: Mapping[str, DataFrame],
    order: Sequence[str] = SOURCE_ORDER,
    max_per_source: int | None = None,
) -> DataFrame:
    """One batch from all sources; ``seq`` follows source order, then position.

    It is a sortable value (rank, document, position); :func:`numbered` makes
    whole numbers of it.
    """
    ranked = [
        _placed(frames[name], rank) for rank, name in enumerate(order) if name in frames
    ]
    batch = ranked[0]
    for frame in ranked[1:]:
        batch = batch.unionByName(frame, allowMissingColumns=True)
    batch = with_dedup_key(batch)
    return batch if max_per_source is None else cap_per_source(batch, max_per_source)


def _placed(frame: DataFrame, rank: int) -> DataFrame:
    """``frame`` with the rank of its source before its own order, which may be plain numbers."""
    own = F.col("seq")
    if not isinstance(frame.schema["seq"].dataType, T.StructType):
        own = document_seq(own, F.lit(0))
    place = F.struct(F.lit(rank).alias("rank"), own["document"].alias("document"), own["position"].alias("position"))
    return frame.withColumn("seq", place)


def numbered(postings: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """``postings`` with ``seq`` as whole numbers from 0 in the order it gave, which goes to ``arrival``.

    Plain numbers are taken as they are.
    """
    placed = postings.withColumn("arrival", F.col("seq"))
    if not isinstance(postings.schema["seq"].dataType, T.StructType):
        return placed
    return dense_numbers(placed.drop("seq"), ["arrival"], "seq", stage)


def recent(
    postings: DataFrame,
    as_of: datetime | str | Column,
    days: int = RECENT_DAYS,
    column: str = "posted_at",
) -> DataFrame:
    """Postings published in the last ``days`` days (a plain comparison, so that
    the reader can skip files and row groups)."""
    return postings.where(F.col(column) >= days_back(as_of, days))


def source_counts(batch: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """Rows per source; sources without rows count 0."""
    names = batch.sparkSession.createDataFrame(
        list(enumerate(order)), "source_rank int, source string"
    )
    counts = batch.groupBy("source").agg(F.count("*").alias("_n"))
    return names.join(counts, "source", "left").select(
        "source_rank", "source", F.coalesce("_n", F.lit(0)).alias("postings")
    )


def zero_result_errors(counts: DataFrame) -> DataFrame:
    """One row: a note per empty source, in source order, joined by ``; ``."""
    note = F.when(
        F.col("postings") == 0,
        F.struct("source_rank", F.concat("source", F.lit(": zero results")).alias("note")),
    )
    notes = F.array_sort(F.collect_list(note))["note"]
    return counts.agg(F.array_join(notes, "; ").alias("errors"))
