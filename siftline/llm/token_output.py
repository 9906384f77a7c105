"""Token ids as Parquet list columns, delta or dictionary encoded.

Texts are dealt out and sorted by doc_id ranges, encoded in the same stage that
writes them, and land in files whose order by part number is the order of ids.
Spark's own writer makes the files, so the commit protocol of the store and
retried tasks are taken care of; ``parquet.block.size`` and the page size
control row groups and pages, and each file carries page indexes.  A reader of
doc_id or n_tokens alone never touches the ids, and a filter on doc_id skips row
groups and pages.

The place of a document in the stream of all ids is a prefix sum in two steps:
inside a part, and over the totals of parts, of which there is a row each.

Defined results: null and empty texts are the end id alone.  A null doc_id comes
first.  Rows that repeat an id stand next to each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm.encoding import encoded

ROW_GROUP_BYTES = 64 << 20
PAGE_BYTES = 1 << 20
TOKENS_SCHEMA = "part int, place long, doc_id long, n_tokens long, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, keeps_blanks: bool = True) -> DataFrame:
    """part, place, doc_id, n_tokens, ids, in ascending order of doc_id over parts and places."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, ids in encoded(batch, tokenizer, keeps_blanks, end_id):
                lengths = np.array([len(x) // 4 for x in ids], np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = np.frombuffer(b"".join(ids), "<i4")
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(np.arange(place, place + len(ids))),
                        batch.column("doc_id").slice(first, len(ids)),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                    ],
                    names=["part", "place", "doc_id", "n_tokens", "ids"],
                )
                place += len(ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(encode, TOKENS_SCHEMA)


def write_tokens(
    tokens: DataFrame, path: str, encoding: str = "delta", row_group: int = ROW_GROUP_BYTES, page: int = PAGE_BYTES
) -> None:
    """Write as Parquet; ``encoding`` of the ids is ``delta`` or ``dictionary``."""
    (
        tokens.write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.block.size", row_group)
        .option("parquet.page.size", page)
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Everything but the ids, which aren't read."""
    return spark.read.parquet(path).drop("ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """The rows with ids_crc32 instead of ids."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            bounds = ids.offsets.to_numpy() * 4
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch(
                [batch.column(c) for c in ("part", "place", "doc_id", "n_tokens")] + [pa.array(crcs, pa.int64())],
                names=["part", "place", "doc_id", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(summed, "part int, place long, doc_id long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with start: the ids of all documents before, in order of part and place."""
    parts = totals.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")
    offsets = parts.select("part", before.alias("offset"))
    here = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place")) - F.col("n_tokens")
    return rows.withColumn("here", here).join(offsets, "part").withColumn("start", F.col("here") + F.col("offset"))
