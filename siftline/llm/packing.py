"""Packing documents into windows of a fixed number of tokens, best fit decreasing.

Overlong documents are cut into full windows first; what remains of each, and
the short documents, are packed by length, longest first, each into the open
window with the least room that holds it.  A segment tree over remaining
capacities finds that window.

Pieces are dealt out by a hash of document and place into groups of about
``GROUP_PIECES``; a group is packed by itself, so that no task sees more than
that, whatever the size of the corpus.  The cost is a few windows per group that
are not full.  Packing needs lengths alone; ids are cut and summed where they
are made.

Defined results: null and empty texts are the end id alone.  Rows that repeat an
id are documents of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.encoding import encoded
from siftline.llm.tables import stage

WINDOW = 2048
GROUP_PIECES = 8192

PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = PIECES_SCHEMA + ", bucket long, place long, offset long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, keeps_blanks: bool = False, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: full windows, then the rest; with their ids if asked for."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = batch.column("doc_id").to_pylist()
            for first, ids in encoded(batch, tokenizer, keeps_blanks, end_id):
                rows = [
                    (doc, a // 4, part, len(all_) // 4)
                    for doc, all_ in zip(docs_[first:], ids, strict=False)
                    for a in range(0, len(all_), 4 * window)
                    for part in (all_[a : a + 4 * window],)
                ]
                columns = [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
                    pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(r[2], "<i4") for r in rows], pa.list_(pa.int32())))
                yield pa.record_batch(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces, PIECES_SCHEMA + ", ids array<int>" * with_ids)


class Capacities:
    """Open windows by remaining room, with the least room that suffices at hand.

    A segment tree: a leaf counts the open windows of one room, an inner node
    those below it.
    """

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._count(room, 1)

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length``."""
        node = length + self.leaves
        while not self.counts[node]:
            # Up until something lies to the right, then one to the right.
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.counts[2 * node])
        return node - self.leaves

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self.open[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset for each of ``lengths``, which fall."""
    rooms, numbers, offsets, used = Capacities(window), [], [], 0
    for length in lengths:
        room = rooms.tightest(length) if length < window else None
        if room is None:
            number, room, used = used, window, used + 1
        else:
            number = rooms.take(room)
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            rooms.put(room - length, number)
    return numbers, offsets


def pack_pieces(pieces: DataFrame, window: int = WINDOW, group: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id, numbered from 0 without gaps, and offset."""
    pieces = stage(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        place, offset = best_fit(rows["length"].tolist(), window)
        return rows.assign(place=place, offset=offset)

    packed = stage(dealt.groupBy("bucket").applyInPandas(pack, PACKED_SCHEMA), "packed")
    used = packed.groupBy("bucket").agg((F.max("place") + 1).alias("used"))
    before = F.sum("used").over(Window.orderBy("bucket")) - F.col("used")
    firsts = used.select("bucket", before.alias("first"))
    return packed.join(firsts, "bucket").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("place")).alias("sequence_id"), "offset"
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    return pack_pieces(cut(docs, tokenizer, end_id, window), window)
