"""Trie of the conversations' turns, summed over subtrees by the Euler-tour technique.

Turns are numbered and hashed along their conversations in one range sort.  The
hash of a sequence is a polynomial in two odd bases modulo 2**64, so that of a
rebuilt conversation follows from those of its two parts, and a conversation
that spans partitions is put together from its parts: no task needs a whole one.
A node is a hash; grouping by it gives members and what one turn saves.

A second range sort brings children behind their parent, ordered by conversation.
From a row and its neighbour follows one arc of the tour: what comes after
entering a node, or after leaving a child.  The tour is a list of two arcs per
node, ranked without walking it: arcs lie in blocks by conversation, where most
of their successors lie too, and each block is contracted to its chains, in
pieces of at most ``PIECE`` arcs.  What remains is contracted again; where blocks
don't help, by merging arcs into predecessors that a coin picks, which takes away a
quarter on average.  A list of at most ``LAST_ARCS`` arcs is ranked by one task, and
ranks are handed back level by level.  Ranks are sums of three weights: places,
leaves and savings.  The sum over a subtree is the difference between leaving and
entering its top.

Ids of members that end at a node may be any number: they are joined in chunks by
the tasks of a range sort, and the digest takes chunk after chunk.

Hashes have 128 bits, of which two sequences share all with a chance of about
2**-128 per pair.

Defined results: rows without conv_id belong to no conversation and are left out.
Null turns come first; turns of one number are ordered by the hash of role and
text.  Null roles and texts are empty; repeated rows are turns of their own.
``%`` has the sign of the dividend.  An empty table has no nodes.  Other columns,
whatever their names, are not read; texts of any length are hashed where they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.tables import stage

GROUP = 5  # conversations that share the head of the first of them
MOST = 9  # a head has fewer turns than this

BLOCK = 1 << 18  # arcs contracted at once
PIECE = 1024
LAST_ARCS = 1 << 14
CHUNK_IDS = 4096
SALT_TURNS = 4096  # turns of a conversation that one joined row serves

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
INVERSES = tuple(pow(b, -1, 2**64) for b in BASES)
_DIGIT = 1 << 16
_PLACE_BITS = 33

SCANNED = "part int, row long, conv_id long, at long, bytes long, p1 long, p2 long, q1 long, q2 long"
SPANS = "part int, conv_id long, before long, c1 long, c2 long"
TOUR = (
    "part int, place long, k1 long, k2 long, kind int, id long, conv_id long, saved long, "
    "follow long, closed boolean, parent_id long, parent_conv long"
)
WEIGHTS = ("w_place", "w_leaf", "w_saved")
LEVEL = "arc long, rep long, o_place long, o_leaf long, o_saved long, next long, w_place long, w_leaf long, w_saved long"


class Powers:
    """Powers of a number modulo 2**64, from tables of 2**16 for each 16 bits of the exponent."""

    def __init__(self, base: int) -> None:
        self.base, self.tables = base, []

    def __call__(self, n: np.ndarray) -> np.ndarray:
        out, level = np.ones(len(n), np.uint64), 0
        while len(n) and int(n.max()) >> (16 * level):
            if level == len(self.tables):
                factors = np.full(_DIGIT, pow(self.base, _DIGIT**level, 2**64), np.uint64)
                factors[0] = 1
                self.tables.append(np.cumprod(factors))
            out *= self.tables[level][(n >> (16 * level)) & (_DIGIT - 1)]
            level += 1
        return out


_UP, _DOWN = [Powers(b) for b in BASES], [Powers(b) for b in INVERSES]


def _unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


# Turns


def _scan(turns: DataFrame) -> DataFrame:
    """Each turn's place and hashes along its conversation, as far as that lies in the partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, conv, length, held = TaskContext.get().partitionId(), 0, None, 0, [np.uint64(0)] * 2
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy()
            new = np.ones(n, bool)
            new[1:] = ids[1:] != ids[:-1]
            first = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            goes_on = ids[0] == conv
            at = np.arange(n) - first[run]
            at[run == 0] += length if goes_on else 0
            columns = []
            for lane in (0, 1):
                terms = _unsigned(batch.column(f"d{lane + 1}")) * _UP[lane](at)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
                start = sums[first]
                if goes_on:
                    start[:1] -= held[lane]
                columns.append((sums[1:] - start[run], sums[:-1] - start[run]))
                held[lane] = columns[lane][0][-1]
            conv, length = ids[-1], int(at[-1]) + 1
            yield pa.record_batch(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array((np.int64(part) << _PLACE_BITS) + np.arange(done, done + n)),
                    batch.column("conv_id"),
                    pa.array(at),
                    batch.column("bytes"),
                    *[_signed(columns[lane][which]) for which in (0, 1) for lane in (0, 1)],
                ],
                names=[c.split()[0] for c in SCANNED.split(", ")],
            )
            done += n

    order = ["conv_id", F.col("turn").asc_nulls_first(), "d1", "d2", "row"]
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, SCANNED)


def _spans(rows: DataFrame) -> DataFrame:
    """part, conv_id, before, c1, c2: what conversations have before a partition in which they go on.

    At most a row per partition.
    """
    runs = stage(
        rows.groupBy("part", "conv_id").agg(
            F.count("*").alias("n"), F.max_by("p1", "at").alias("p1"), F.max_by("p2", "at").alias("p2")
        ),
        "runs",
    )
    split = runs.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1")

    def put_together(run: pd.DataFrame) -> pd.DataFrame:
        out, before, held = [], 0, [0, 0]
        for part, conv, n, *sums in run.sort_values("part")[["part", "conv_id", "n", "p1", "p2"]].itertuples(index=False):
            if before:
                out.append((part, conv, before, *[h - (h >> 63 << 64) for h in held]))
            held = [(h + pow(b, before, 2**64) * int(s)) % 2**64 for h, b, s in zip(held, BASES, sums, strict=True)]
            before += int(n)
        return pd.DataFrame(out, columns=["part", "conv_id", "before", "c1", "c2"])

    return runs.join(split.select("conv_id"), "conv_id").groupBy("conv_id").applyInPandas(put_together, SPANS)


def _whole(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """row, conv_id, pos, bytes, p1, p2, q1, q2: along whole conversations."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column("before").to_numpy()
            columns = []
            for name in ("p1", "p2", "q1", "q2"):
                lane = int(name[1]) - 1
                columns.append(_signed(_unsigned(batch.column(f"c{lane + 1}")) + _UP[lane](before) * _unsigned(batch.column(name))))
            pos = pa.array(batch.column("at").to_numpy() + before)
            yield pa.record_batch(
                [batch.column("row"), batch.column("conv_id"), pos, batch.column("bytes"), *columns],
                names=["row", "conv_id", "pos", "bytes", "p1", "p2", "q1", "q2"],
            )

    joined = rows.join(F.broadcast(spans), ["part", "conv_id"], "left").fillna(0, ["before", "c1", "c2"])
    return joined.select("row", "conv_id", "at", "bytes", "p1", "p2", "q1", "q2", "before", "c1", "c2").mapInArrow(
        put, "row long, conv_id long, pos long, bytes long, p1 long, p2 long, q1 long, q2 long"
    )


def _splices(turns: DataFrame, group: int, most: int) -> DataFrame:
    """conv_id, n, h, base, k, b1, b2, o1, o2: how many turns a conversation takes from which other, and the hashes at the seam."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % group
    head = F.when(base != F.col("conv_id"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))).otherwise(F.lit(0))
    convs = stage(convs.withColumn("base", base).withColumn("h", head.cast("long")), "conversations")
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    heads = turns.filter(F.col("pos") < most)
    given = heads.select(F.col("conv_id").alias("base"), (F.col("pos") + 1).alias("k"), F.col("p1").alias("b1"), F.col("p2").alias("b2"))
    own = heads.select("conv_id", F.col("pos").alias("h"), F.col("q1").alias("o1"), F.col("q2").alias("o2"))
    return (
        convs.join(sizes, "base", "left")
        .withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
        .join(given, ["base", "k"], "left")
        .join(own, ["conv_id", "h"], "left")
        .select("conv_id", "n", "h", "base", "k", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("b1", "b2", "o1", "o2")])
    )


def _after_heads(turns: DataFrame, splices: DataFrame) -> DataFrame:
    """Own turns after the head, with hashes and places of the rebuilt conversation."""

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, k, pos = (batch.column(c).to_numpy() for c in ("h", "k", "pos"))
            columns = []
            for name in ("p1", "p2", "q1", "q2"):
                lane = int(name[1]) - 1
                given, own, here = (_unsigned(batch.column(c)) for c in (f"b{lane + 1}", f"o{lane + 1}", name))
                columns.append(_signed(given + _DOWN[lane](h - k) * (here - own)))
            yield pa.record_batch(
                [batch.column("row"), batch.column("conv_id"), pa.array(pos - h + k + 1), batch.column("bytes"), *columns]
                + [pa.array(pos == batch.column("n").to_numpy() - 1)],
                names=["row", "conv_id", "depth", "bytes", "k1", "k2", "p1", "p2", "last"],
            )

    # A long conversation is joined by many rows.
    salts = splices.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SALT_TURNS))))
    salted = turns.withColumn("salt", F.floor(F.col("pos") / SALT_TURNS))
    rows = salted.join(salts.drop("base"), ["conv_id", "salt"]).filter("pos >= h")
    return rows.select("row", "conv_id", "pos", "bytes", "p1", "p2", "q1", "q2", "n", "h", "k", "b1", "b2", "o1", "o2").mapInArrow(
        splice, "row long, conv_id long, depth long, bytes long, k1 long, k2 long, p1 long, p2 long, last boolean"
    )


# Nodes


def _nodes(members: DataFrame, convs: DataFrame) -> DataFrame:
    """id, k1, k2, p1, p2, depth, conv_id, n_convs, saved: one row per node; the root has id -1."""
    found = members.groupBy("k1", "k2").agg(
        F.min("row").alias("id"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        zero.alias("k1"), zero.alias("k2"), F.lit(-1).cast("long").alias("id"), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"),
    )
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    return found.unionByName(root).withColumn("saved", saved).drop("bytes")


def _end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the conversations that end at each node."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
        keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
        new = np.ones(batch.num_rows, bool)
        new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        bounds = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield (int(keys[0][a]), int(keys[1][a])), a, b

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            rows = [
                (*key, ids[i], ",".join(map(str, ids[i : min(i + CHUNK_IDS, b)])))
                for key, a, b in runs(batch)
                for i in range(a, b, CHUNK_IDS)
            ]
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in columns], names=["k1", "k2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, out = None, None, []
        for batch in batches:
            texts = batch.column("ids")
            for found, a, b in runs(batch):
                if found != key:
                    if held is not None:
                        out.append((*key, held.hexdigest()))
                    held, key = None, found
                for i in range(a, b):
                    text = texts[i].as_py()
                    if held is None:
                        held = hashlib.sha256()
                    else:
                        text = "," + text
                    held.update(text.encode())
            if out:
                yield as_batch(out)
                out = []
        if held is not None:
            yield as_batch([*out, (*key, held.hexdigest())])

    def as_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)
        return pa.record_batch([pa.array(c, t) for c, t in columns], names=["k1", "k2", "ends_sha256"])

    order = ["k1", "k2", "conv_id"]
    joined = stage(
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, "k1 long, k2 long, first long, ids string"),
        "chunks",
    )
    dealt = joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


# The tour


def _neighbours(nodes: DataFrame) -> DataFrame:
    """Markers of nodes (kind 0), each before its children (kind 1), with what follows as far as the partition tells."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, held, marker = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if table.num_rows > 1:
                whole = table.to_batches()[0]
                rows, marker = known(whole, whole.num_rows - 1, marker, part, done, False)
                done += whole.num_rows - 1
                held = whole.slice(whole.num_rows - 1)
                yield rows
            elif table.num_rows:
                held = table.to_batches()[0]
        if held is not None:
            yield known(held, 1, marker, part, done, True)[0]

    def known(batch: pa.RecordBatch, n: int, marker: tuple | None, part: int, done: int, last: bool) -> tuple[pa.RecordBatch, tuple | None]:
        k1, k2, kind, ids, conv = (batch.column(c).to_numpy() for c in ("k1", "k2", "kind", "id", "conv_id"))
        follow, there = np.zeros(n, np.int64), np.zeros(n, bool)
        if not last:
            there = (kind[1:] == 1) & (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
            follow[there] = ids[1:][there]
        marks = np.flatnonzero(kind[:n] == 0)
        at = np.searchsorted(marks, np.arange(n), "right") - 1
        parent, parent_conv = np.zeros(n, np.int64), np.zeros(n, np.int64)
        inside = at >= 0
        parent[inside], parent_conv[inside] = ids[marks[at[inside]]], conv[marks[at[inside]]]
        if marker is not None:
            parent[~inside], parent_conv[~inside] = marker
            inside[:] = True
        unknown = ~inside
        rows = pa.record_batch(
            [
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(done, done + n)),
                *[batch.column(c).slice(0, n) for c in ("k1", "k2", "kind", "id", "conv_id", "saved")],
                pa.array(follow, mask=~there),
                pa.array(np.full(n, not last) & ~there),
                pa.array(parent, mask=unknown),
                pa.array(parent_conv, mask=unknown),
            ],
            names=[c.split()[0] for c in TOUR.split(", ")],
        )
        return rows, (int(ids[marks[-1]]), int(conv[marks[-1]])) if len(marks) else marker

    markers = nodes.select("k1", "k2", F.lit(0).alias("kind"), "id", "conv_id", "saved")
    children = nodes.filter("id >= 0").select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).alias("kind"), "id", "conv_id", F.lit(0).cast("long").alias("saved")
    )
    order = ["k1", "k2", "kind", "conv_id"]
    return markers.unionByName(children).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(look, TOUR)


def _tour(rows: DataFrame) -> DataFrame:
    """``rows`` with parents throughout, and arc and next: what comes after entering a node, or after leaving a child."""
    first = F.struct("k1", "k2", "kind", "id")
    mark = F.struct(F.col("id").alias("id"), F.col("conv_id").alias("conv_id"))
    parts = rows.groupBy("part").agg(
        F.min_by(first, "place").alias("first"), F.max_by(mark, F.when(F.col("kind") == 0, F.col("place"))).alias("mark")
    )
    # A row per partition.
    by_part = Window.orderBy("part")
    borders = parts.select(
        "part",
        F.lead("first").over(by_part).alias("after"),
        F.last("mark", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
    )
    goes_on = ~F.col("closed") & F.col("follow").isNull() & (F.col("after.kind") == 1) & (F.col("after.k1") == F.col("k1")) & (F.col("after.k2") == F.col("k2"))
    follow = F.when(goes_on, F.col("after.id")).otherwise(F.col("follow"))
    here = (
        rows.join(F.broadcast(borders), "part")
        .withColumn("follow", follow)
        .withColumn("parent_id", F.coalesce("parent_id", "before.id"))
        .withColumn("parent_conv", F.coalesce("parent_conv", "before.conv_id"))
    )
    enters = F.col("kind") == 0
    arc = 2 * (F.col("id") + 1) + F.col("kind")
    after = F.when(F.col("follow").isNotNull(), 2 * (F.col("follow") + 1)).otherwise(
        2 * (F.when(enters, F.col("id")).otherwise(F.col("parent_id")) + 1) + 1
    )
    return here.select(
        "kind", "id", "parent_id", "parent_conv", arc.alias("arc"), after.alias("next"),
        F.lit(1).cast("long").alias("w_place"),
        (enters & F.col("follow").isNull()).cast("long").alias("w_leaf"),
        F.when(enters, F.col("saved")).otherwise(0).alias("w_saved"),
    )


def contract(arcs: np.ndarray, after: np.ndarray, weights: np.ndarray, piece: int | None) -> dict[str, np.ndarray]:
    """Chains of a block, cut into pieces: for every arc its piece's first one and the weights between; for those the piece's whole.

    ``after`` may name arcs of other blocks; ``weights`` has a row per kind.
    """
    order = np.argsort(arcs, kind="stable")
    arcs, after, weights = arcs[order], after[order], weights[:, order]
    n = len(arcs)
    at = np.minimum(np.searchsorted(arcs, after), n - 1)
    local = arcs[at] == after
    jump, sums = np.arange(n), np.zeros_like(weights)
    jump[at[local]] = np.flatnonzero(local)
    sums[:, at[local]] = weights[:, local]
    index = (jump != np.arange(n)).astype(np.int64)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        sums += sums[:, jump]
        index += index[jump]
        jump = further
    # Along chains; each has its arcs from 0.
    along = np.lexsort([index, jump])
    arcs, after, weights, sums, index = arcs[along], after[along], weights[:, along], sums[:, along], index[along]
    start = np.arange(n) - (index % piece if piece else index)
    ends = np.append(np.flatnonzero(start[1:] != start[:-1]), n - 1)
    tail = np.zeros(n, np.int64)
    tail[start[ends]] = ends
    first = start == np.arange(n)
    whole = sums[:, tail] + weights[:, tail] - sums
    return {
        "arc": arcs, "rep": arcs[start], "offset": sums - sums[:, start], "first": first, "next": after[tail], "whole": whole,
    }


def _contracted(arcs: DataFrame, piece: int | None) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK and piece:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            after = table["next"].fill_null(-1).to_numpy()
            found = contract(table["arc"].to_numpy(), after, np.stack([table[w].to_numpy() for w in WEIGHTS]), piece)
            other = ~found["first"]
            yield pa.record_batch(
                [pa.array(found["arc"]), pa.array(found["rep"]), *map(pa.array, found["offset"])]
                + [pa.array(found["next"], mask=other | (found["next"] < 0)), *[pa.array(w, mask=other) for w in found["whole"]]],
                names=[c.split()[0] for c in LEVEL.split(", ")],
            )

    return arcs.select("arc", "next", *WEIGHTS).mapInArrow(shrink, LEVEL)


def _mated(arcs: DataFrame, turn: int) -> DataFrame:
    """Arcs merged into their predecessors where a coin says so, in the form of ``_contracted``."""
    coin = F.pmod(F.xxhash64("arc", F.lit(turn)), F.lit(2))
    tossed = arcs.select("arc", "next", *WEIGHTS, coin.alias("coin"))
    taken = tossed.filter("coin = 1").select(F.col("arc").alias("next"), F.col("next").alias("beyond"), *[F.col(w).alias(f"t_{w}") for w in WEIGHTS])
    pairs = tossed.filter("coin = 0").join(taken, "next", "left")
    merged = F.col("t_w_place").isNotNull()
    offsets = ["o_place", "o_leaf", "o_saved"]
    zero = F.lit(0).cast("long")
    stay = pairs.select(
        "arc", F.col("arc").alias("rep"), *[zero.alias(o) for o in offsets],
        F.when(merged, F.col("beyond")).otherwise(F.col("next")).alias("next"),
        *[(F.col(w) + F.coalesce(f"t_{w}", zero)).alias(w) for w in WEIGHTS],
    )
    gone = pairs.filter(merged).select(
        F.col("next").alias("arc"), F.col("arc").alias("rep"), *[F.col(w).alias(o) for w, o in zip(WEIGHTS, offsets, strict=True)],
        *[F.lit(None).cast("long").alias(c) for c in ("next", *WEIGHTS)],
    )
    alone = tossed.filter("coin = 1").join(gone.select("arc"), "arc", "left_anti").select(
        "arc", F.col("arc").alias("rep"), *[zero.alias(o) for o in offsets], "next", *WEIGHTS
    )
    return stay.unionByName(gone).unionByName(alone)


def ranks(arcs: DataFrame) -> DataFrame:
    """arc, o_place, o_leaf, o_saved: sums of the weights of all arcs before, along the one list that ``next`` makes."""
    levels, left, before, turn = [], arcs, None, 0
    while True:
        n = left.count()
        if n <= LAST_ARCS:
            break
        if before is not None and 2 * n > before:  # blocks hold too few successors
            level = stage(_mated(left, turn), "mated")
            before = None
        else:
            level = stage(_contracted(left.repartitionByRange("arc"), PIECE), "contracted")
            before = n
        levels.append(level)
        left, turn = level.filter(F.col("arc") == F.col("rep")), turn + 1
    columns = ["arc", "o_place", "o_leaf", "o_saved"]
    found = _contracted(left.coalesce(1), None).select(*columns)
    for level in reversed(levels):
        starts = found.select(F.col("arc").alias("rep"), *[F.col(c).alias(f"s_{c}") for c in columns[1:]])
        found = level.join(starts, "rep").select("arc", *[(F.col(c) + F.col(f"s_{c}")).alias(c) for c in columns[1:]])
    return found


def conversation_trie(conversations: DataFrame, group: int = GROUP, most: int = MOST) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    Every ``group`` conversations share the beginning of the first; with a group of 1 each is as it stands.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    narrow = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        *[F.xxhash64(F.lit(lane), role, text).alias(f"d{lane}") for lane in (1, 2)],
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    scanned = stage(_scan(stage(narrow, "hashed")), "scanned")
    turns = stage(_whole(scanned, stage(_spans(scanned), "spans")), "turns")
    splices = stage(_splices(turns, group, most), "splices")

    own = stage(_after_heads(turns, splices), "own")
    heads = turns.filter(F.col("pos") < most).select(
        F.col("conv_id").alias("base"), "pos", "row", "bytes", "p1", "p2", "q1", "q2"
    )
    given = (
        splices.filter("k > 0").select("conv_id", "base", "k").join(heads, "base").filter("pos < k")
        .select("row", "conv_id", (F.col("pos") + 1).alias("depth"), "bytes",
                F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    )
    nodes = stage(_nodes(own.drop("last").unionByName(given), splices), "nodes")
    short = splices.filter("n <= h").select(F.col("b1").alias("k1"), F.col("b2").alias("k2"), "conv_id")
    ends = stage(own.filter("last").select("k1", "k2", "conv_id").unionByName(short), "ends")

    tour = stage(_tour(stage(_neighbours(nodes), "neighbours")), "tour")
    # Leaving the root is the end of the list.
    last = nodes.filter("id < 0").select(
        F.lit(1).cast("long").alias("arc"), F.lit(None).cast("long").alias("next"), *[F.lit(0).cast("long").alias(w) for w in WEIGHTS]
    )
    ranked = ranks(tour.select("arc", "next", *WEIGHTS).unionByName(last))

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")

    def about(id_: Column, leaves: Column = zero, saved: Column = zero, children: Column = zero, parent: Column = none) -> list[Column]:
        return [id_.alias("id"), leaves.alias("leaves"), saved.alias("saved"), children.alias("children"), parent.alias("parent")]

    sign = F.when(F.col("arc") % 2 == 1, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    sums = ranked.select(*about(F.shiftright("arc", 1) - 1, sign * F.col("o_leaf"), sign * F.col("o_saved")))
    children = tour.filter("kind = 1")
    facts = (
        sums.unionByName(children.select(*about(F.col("id"), parent=F.col("parent_conv"))))
        .unionByName(children.select(*about(F.col("parent_id"), children=F.lit(1).cast("long"))))
        .groupBy("id")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("children").alias("n_children"),
             F.max("parent").alias("parent_conv_id"))
    )
    digests = _end_digests(ends)
    return (
        nodes.select("id", "k1", "k2", "conv_id", "depth", "n_convs")
        .join(facts, "id")
        .join(digests, ["k1", "k2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
