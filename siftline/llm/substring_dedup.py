"""Substring dedup by level-wise doubling.

A word goes when some window of ``WINDOW`` words that covers it also starts in a
document with a smaller id.  Windows are found by length, level by level: half
the final length first, and only around windows that repeat at one length those
of twice the length are looked at, until the final length is reached or no
candidates survive.

Below the final length not every window is needed.  Of the shorter windows that
lie in one window of the final length, the one with the least hash is taken, so
equal long windows choose equal short ones; about two in 27 positions are chosen
at half length, and no repeated long window is without one.

Documents with the same words throughout are settled first: the smallest id of
them stands for all, the others lose every word that a window covers.

Minima and maxima per window are partial aggregates, and handing them back to
positions is a plain join that AQE may split, so a passage may stand in any
share of all documents.  Positions of a document are gathered per document only.

Defined results: null and empty texts have no words, and their digest is that of
the empty text.  A null id is larger than any number.  Rows that repeat an id
take nothing from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.tables import stage
from siftline.llm.words import blocks, split, window_hashes, word_hashes

WINDOW = 50
FIRST = 25
LAST_ID = 2**63 - 1

ANCHORED = "key long, n_words long, words_sha256 string, hashes array<long>, places array<int>"


def lengths(window: int, first: int) -> list[int]:
    """The final length halved until it is at most ``first``, ascending."""
    out = [window]
    while out[0] > first:
        out.insert(0, -(-out[0] // 2))
    return out


def chosen(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the least (the last of equal ones) among some ``width`` neighbours."""
    if width == 1:
        return np.arange(len(hashes))
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    turned = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    return np.unique(np.arange(len(turned)) + width - 1 - turned.argmin(axis=1))


def anchors(words: np.ndarray, starts: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the chosen windows of ``length`` for windows at ``starts``, which ascend."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(np.diff(starts) > 1) + 1
    hashes, places = [], []
    for run in np.split(starts, cuts):
        own = window_hashes(words[run[0] : run[-1] + window], length)
        at = chosen(own, window - length + 1)
        hashes.append(own[at])
        places.append(at + run[0])
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    _, first = np.unique(places, return_index=True)
    return hashes[first], places[first]


def around(places: np.ndarray, length: int, window: int, n_words: int) -> np.ndarray:
    """Starts of the windows that hold one of the shorter ones, ascending."""
    change = np.zeros(n_words + 2, np.int32)
    np.add.at(change, np.maximum(places + length - window, 0), 1)
    np.add.at(change, places + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: max(0, n_words - window + 1)] > 0)


def words_digest(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def _arrays(hashes: list[np.ndarray], places: list[np.ndarray]) -> list[pa.Array]:
    bounds = pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32))
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes]).view(np.int64)
    at = np.concatenate([np.zeros(0, np.int32), *places]).astype(np.int32)
    return [pa.ListArray.from_arrays(bounds, pa.array(flat)), pa.ListArray.from_arrays(bounds, pa.array(at))]


def _first_level(docs: DataFrame, length: int, window: int) -> DataFrame:
    """Words, their digest, and the anchors of every document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                words = split(block)
                own = word_hashes(block.data, words)
                text = block.data.tobytes()
                hashes, places, digests = [], [], []
                for a, b, i, j in zip(block.bounds[:-1], block.bounds[1:], words.bounds[:-1], words.bounds[1:], strict=True):
                    h, p = anchors(own[i:j], np.arange(max(0, j - i - window + 1)), length, window)
                    hashes.append(h)
                    places.append(p)
                    digests.append(words_digest(text[a:b]))
                yield pa.record_batch(
                    [batch.column("key").slice(block.first, block.rows), pa.array(np.diff(words.bounds)), pa.array(digests), *_arrays(hashes, places)],
                    names=["key", "n_words", "words_sha256", "hashes", "places"],
                )

    return docs.select("key", "text").mapInArrow(read, ANCHORED)


def _next_level(candidates: DataFrame, before: int, length: int, window: int) -> DataFrame:
    """The anchors of twice the length around those that survived."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            survived, digests = batch.column("survived"), batch.column("words_sha256")
            for block in blocks(batch.column("text")):
                words = split(block)
                own = word_hashes(block.data, words)
                text, hashes, places = block.data.tobytes(), [], []
                for k in range(block.rows):
                    i, j = words.bounds[k : k + 2]
                    at = np.asarray(survived[block.first + k].values.to_numpy(), np.int64)
                    # Another text under the same id has no say here.
                    if words_digest(text[block.bounds[k] : block.bounds[k + 1]]) != digests[block.first + k].as_py():
                        at = at[:0]
                    h, p = anchors(own[i:j], around(at, before, window, int(j - i)), length, window)
                    hashes.append(h)
                    places.append(p)
                yield pa.record_batch(
                    [batch.column(c).slice(block.first, block.rows) for c in ("key", "words_sha256")] + _arrays(hashes, places),
                    names=["key", "words_sha256", "hashes", "places"],
                )

    return candidates.select("key", "words_sha256", "survived", "text").mapInArrow(
        extend, "key long, words_sha256 string, hashes array<long>, places array<int>"
    )


def _repeated(anchored: DataFrame, last: bool) -> DataFrame:
    """words_sha256, key, survived: places whose windows repeat across ids; at the last level, in a smaller one."""
    at = anchored.select("key", "words_sha256", F.explode(F.arrays_zip("hashes", "places")).alias("w")).select(
        "key", "words_sha256", F.col("w.hashes").alias("hash"), F.col("w.places").alias("place")
    )
    ids = at.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    found = at.join(ids.select("hash", "least"), "hash")
    if last:
        found = found.filter("least < key")
    return found.groupBy("key", "words_sha256").agg(F.collect_list("place").alias("survived"))


def _cut(candidates: DataFrame, window: int) -> DataFrame:
    """words_sha256, n_removed, kept_sha256: without the words that the windows at ``survived`` cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, removed, digests = [], [], []
            for text, digest, places in zip(*(batch.column(c) for c in ("text", "words_sha256", "survived")), strict=True):
                text = (text.as_py() or "").encode()
                words = text.split()
                if words_digest(text) != digest.as_py():
                    continue
                same.append(digest)
                change = np.zeros(len(words) + window + 1, np.int32)
                at = np.asarray(places.values.to_numpy(), np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                keep = np.cumsum(change)[: len(words)] == 0
                removed.append(int(len(words) - keep.sum()))
                digests.append(hashlib.sha256(b" ".join(w for w, k in zip(words, keep, strict=True) if k)).hexdigest())
            yield pa.record_batch(
                [pa.array([d.as_py() for d in same], pa.string()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["words_sha256", "n_removed", "kept_sha256"],
            )

    return candidates.select("words_sha256", "survived", "text").mapInArrow(cut, "words_sha256 string, n_removed long, kept_sha256 string")


def cut_repeats(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per row of ``docs``."""
    levels = lengths(window, first)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("key"), "text")
    rows = stage(_first_level(texts, levels[0], window), "rows")
    narrow = rows.select("key", "n_words", "words_sha256")
    stands = stage(narrow.groupBy("words_sha256").agg(F.min("key").alias("key")), "stands")
    anchored = (
        rows.filter(F.size("hashes") > 0).join(stands, ["words_sha256", "key"], "left_semi").dropDuplicates(["words_sha256"])
    )
    survived = stage(_repeated(anchored, last=len(levels) == 1), "survived")
    for before, length in zip(levels[:-1], levels[1:], strict=True):
        if survived.isEmpty():
            break
        on = [c for c in ("key", "words_sha256") if c in texts.columns]
        # The same join at every size: texts are sorted once, never broadcast against.
        candidates = stage(texts.join(survived.hint("merge"), on), "candidates")
        anchored = stage(_next_level(candidates, before, length, window), "anchored")
        texts = candidates.select("key", "words_sha256", "text")
        survived = stage(_repeated(anchored, last=length == window), "survived")
    on = [c for c in ("key", "words_sha256") if c in texts.columns]
    results = _cut(texts.join(survived.hint("merge"), on), window)
    classes = stage(stands.join(results, "words_sha256", "left"), "classes")
    return _settled(rows.select("key", "n_words", "words_sha256"), classes, window)


def _settled(rows: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    classes = classes.select("words_sha256", F.col("key").alias("least"), "n_removed", "kept_sha256")
    copy = (F.col("key") > F.col("least")) & (F.col("n_words") >= window)
    own = (F.col("key") == F.col("least")) & F.col("n_removed").isNotNull()
    return rows.join(classes, "words_sha256").select(
        F.when(F.col("key") < LAST_ID, F.col("key")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).when(own, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(own, F.col("kept_sha256")).otherwise(F.col("words_sha256")).alias("kept_sha256"),
    )
