"""Near-dedup by SetSketch registers, banded, judged by likelihood, then verified.

1. Every document becomes the set of its word shingles.  Equal sets fall
   together by digest, and only one of each goes on.
2. A SetSketch of a set has ``REGISTERS`` registers.  Each is the least hash of the
   set under one of as many hash functions, turned into an exponential variable
   and truncated to an integer power of ``BASE``.  Registers of a union are the
   maxima of registers, and two sets agree in a register about as often as their
   Jaccard similarity says.
3. Bands of four registers are keys of 64 bits; sets that share one meet.  With 24
   bands a pair of similarity 0.8 is missed with a chance of 3 in a million.
4. Among those that meet, the joint likelihood of all registers, given both set
   sizes, says which similarities are possible.  Only pairs for which the
   threshold is out of the question are set aside.
5. The others form clusters.  Members of a cluster are compared on full sets, and
   those that are similar make up the components.

No group is held in one task: buckets and clusters are cut into blocks of bounded
size.  No group hands on all its pairs: what hangs together is handed on as a
star, and only parts that don't yet hang together are compared further.

Defined results: null and empty texts, and texts without words, have the empty
set, are linked with nothing, and are kept.  A null doc_id is in the component
of its copies, never names one, and is not kept.  Rows that repeat an id belong to
the components of their own texts, each named by the least id in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.components import components
from siftline.llm.groups import Groups, whole_groups
from siftline.llm.tables import boxed, stage
from siftline.llm.words import LOWER, Block, blocks, mix, split, window_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BAND_ROWS = 4  # registers of 16 bits in a key of 64
BANDS = 24
REGISTERS = BANDS * BAND_ROWS
BASE = 1.001
RATE = 20.0
DOUBT = 12.0  # a pair is set aside when the threshold is exp(12) times less likely than the best estimate
BLOCK_SETS = 4096
BLOCK_SHINGLES = 1 << 20
BLOCK_HEADS = 64
FAR = 8.0  # standard deviations of the number of equal registers

SIGNED_SCHEMA = "doc_id long, text_key binary, n_shingles long, digest binary, sketch array<long>"

_draw = np.random.default_rng(77)
_FACTOR = _draw.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _draw.integers(0, 2**32, REGISTERS, dtype=np.uint32)


def sets_of(block: Block, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row, words in lower case."""
    block = block._replace(data=LOWER[block.data])
    words = split(block)
    hashes = word_hashes(block.data, words)
    windows = window_hashes(hashes, shingle)
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= shingle:
            yield np.unique(windows[a : b - shingle + 1])
        else:
            yield window_hashes(hashes[a:b], int(b - a)) if b > a else windows[:0]


def sketch(members: np.ndarray) -> np.ndarray:
    """The registers of a set of hashes; the elementwise maximum is that of a union."""
    low = np.full(REGISTERS, 2**32 - 1, np.uint32)
    values = (members >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(values), 4096):
        np.minimum(low, (values[a : a + 4096, None] * _FACTOR + _SHIFT).min(axis=0), out=low)
    exponential = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, 65535).astype("<u2")


def digest(members: np.ndarray) -> bytes:
    """128 bits of a set: two sums of its mixed members."""
    with np.errstate(over="ignore"):
        one, two = mix(members), mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        return np.array([one.sum(), two.sum()], "<u8").tobytes()


def _text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text)))


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, and the bands of the sketch; digest is null for the empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for block in blocks(batch.column("text")):
                for members in sets_of(block, shingle):
                    sizes.append(len(members))
                    digests.append(digest(members) if len(members) else None)
                    bands.append(sketch(members).view("<i8") if len(members) else None)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "digest", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), "text").mapInArrow(sign, SIGNED_SCHEMA)


def _chance(x: np.ndarray) -> np.ndarray:
    """Of a register being larger on one side, where that side alone has the share ``x``."""
    return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-12)


def possible(
    sketches: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_size: np.ndarray | int, threshold: float
) -> np.ndarray:
    """For each row, whether similarity ``threshold`` with the other is possible.

    The other is one sketch, or one for each row.  Sizes alone, and far too few
    equal registers, rule out most rows; the others are judged by likelihood.
    """
    other_size = np.broadcast_to(other_size, sizes.shape)
    equal = (sketches == other).sum(axis=1)
    least = REGISTERS * threshold - FAR * math.sqrt(REGISTERS * threshold * (1 - threshold))
    fits = (np.minimum(sizes, other_size) >= threshold * np.maximum(sizes, other_size) - 1e-9) & (equal >= least)
    at = np.flatnonzero(fits)
    if len(at):
        other = other[at] if other.ndim == 2 else other
        larger, smaller = (sketches[at] > other).sum(axis=1), (sketches[at] < other).sum(axis=1)
        fits[at] = likely(larger, smaller, sizes[at], other_size[at], threshold)[0]
    return fits


def likely(
    larger: np.ndarray, smaller: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Whether similarity ``threshold`` is not out of the question, and the likeliest one.

    Counts of registers that are larger, smaller and equal have a joint
    likelihood in the similarity j: shares of the union that one side alone has
    are u - v j and v - u j, where u and v are the shares of the sizes in their sum.
    """
    larger, smaller = larger[:, None], smaller[:, None]
    equal = REGISTERS - larger - smaller
    u = (sizes / (sizes + other_sizes))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0.0, 1.0, 65)[None, :] * most

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = _chance(np.maximum(u - v * j, 0)), _chance(np.maximum(v - u * j, 0))
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    values = likelihood(grid)
    at_least = np.maximum(np.where(grid >= threshold, values, -np.inf).max(axis=1), likelihood(np.minimum(threshold, most))[:, 0])
    j = np.take_along_axis(grid, values.argmax(axis=1)[:, None], axis=1)[:, 0]
    return values.max(axis=1) - at_least <= DOUBT, j


def _registers(column: pa.ChunkedArray) -> np.ndarray:
    bands = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(bands, "<i8").view("<u2").reshape(-1, REGISTERS)


def unite(part: np.ndarray, row: int, near: np.ndarray) -> None:
    """Puts the parts of the rows ``near`` into that of ``row``."""
    hit = np.unique(part[near])
    if len(hit):
        part[np.isin(part, hit)] = part[row]


def stars(ids: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row but the smallest of its part, and the smallest."""
    _, at = np.unique(part, return_inverse=True)
    least = np.full(at.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, at, ids)
    far = ids != least[at]
    return ids[far], least[at][far]


def _meeting_parts(groups: Groups, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stars of rows that hang together by possible similarity, in each group.

    Rows of one label hang together already; only rows of different parts are
    compared.
    """
    ids, sizes, labels = (groups.column(c) for c in ("rep", "n_shingles", "label"))
    regs = _registers(groups.table["sketch"])
    starts, counts = groups.bounds[:-1], np.diff(groups.bounds)
    # Buckets of two, nearly all of them, in one go.
    two = starts[counts == 2]
    near = possible(regs[two], sizes[two], regs[two + 1], sizes[two + 1], threshold)
    out = [(ids[two][near], ids[two + 1][near])]
    for start, count in zip(starts[counts > 2], counts[counts > 2], strict=True):
        own, own_sizes, part = regs[start : start + count], sizes[start : start + count], labels[start : start + count].copy()
        for i in range(count):
            other = np.flatnonzero(part != part[i])
            if not len(other):
                break
            unite(part, i, other[possible(own[other], own_sizes[other], own[i], own_sizes[i], threshold)])
        out.append(stars(ids[start : start + count], part))
    return out


def _meet(met: DataFrame, classes: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """a, b: stars of the members of each group of ``keys`` that may be similar."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, keys):
            for a, b in _meeting_parts(groups, threshold):
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    rows = met.select(*keys, "rep", "label").join(classes, "rep")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(meet, "a long, b long").distinct()


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with label: the component of rep so far."""
    named = components(links).select(F.col("node").alias("rep"), "component")
    return rows.join(named, "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")


def in_blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with blocks, how many blocks their group of ``keys`` has, and block."""
    blocks_ = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_SETS).alias("blocks"))
    return rows.join(blocks_, keys).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))


def crossed(rows: DataFrame) -> DataFrame:
    """``rows`` once for each pair (x, y) of their block with one of the group."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("other", other).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))


def meetings(classes: DataFrame, threshold: float) -> DataFrame:
    """a, b: connects all sets that share a band and may be similar, with few links.

    Buckets are cut into blocks, and the members of a block compared.  Then one
    member of each part that came out, for all blocks of a bucket; buckets that
    are still in parts are compared block by block.
    """
    bucket = ["band", "key"]
    keyed = classes.select("rep", F.posexplode("sketch").alias("band", "key"))
    shared = keyed.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1")
    met = keyed.join(shared, bucket).withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BLOCK_SETS)))
    met = stage(met.withColumn("label", F.col("rep")), "met")
    links = stage(_meet(met, classes, [*bucket, "block"], threshold), "links")

    large = met.filter(f"size > {BLOCK_SETS}").select("rep", *bucket)
    if large.isEmpty():
        return links
    heads = stage(labelled(large, links).groupBy(*bucket, "label").agg(F.min("rep").alias("rep")), "heads")
    links = stage(links.unionByName(_meet(in_blocks(heads, bucket), classes, [*bucket, "block"], threshold)), "links")
    now = stage(labelled(large, links), "labelled")
    apart = now.groupBy(*bucket).agg(F.min("label").alias("p"), F.max("label").alias("q")).filter("p < q").select(*bucket)
    left = stage(crossed(in_blocks(now.join(apart, bucket, "left_semi"), bucket)), "left")
    return stage(links.unionByName(_meet(left, classes, [*bucket, "x", "y"], threshold)), "links")


class Members:
    """Which of some sets hold each member that several of them hold."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, member, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = count[member] > 1
        owner, member = owner[several], (np.cumsum(count > 1) - 1)[member[several]]
        self.n = len(sets)
        self.member, self.of = member, np.searchsorted(owner, np.arange(len(sets) + 1))
        order = np.argsort(member, kind="stable")
        self.owner = owner[order]
        self.lists = np.searchsorted(member[order], np.arange(int((count > 1).sum()) + 1))

    def shared_with(self, row: int) -> np.ndarray:
        """How many members each other set has in common with that of ``row``."""
        own = self.member[self.of[row] : self.of[row + 1]]
        first, lengths = self.lists[own], self.lists[own + 1] - self.lists[own]
        if not len(own):
            return np.zeros(self.n, np.int64)
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(first - ends + lengths, lengths)
        return np.bincount(self.owner[at], minlength=self.n)


def _verified_parts(groups: Groups, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stars of rows that hang together by similarity of their full sets, in each group."""
    ids, sizes, labels = (groups.column(c) for c in ("rep", "n_shingles", "label"))
    members = groups.table["members"].combine_chunks()
    share, out = round(100 * threshold), []
    for start, end in zip(groups.bounds[:-1], groups.bounds[1:], strict=True):
        if end - start < 2:
            continue
        n = sizes[start:end]
        _, part, count = np.unique(labels[start:end], return_inverse=True, return_counts=True)
        # Rows of the label that most have hang together already.
        rows = np.flatnonzero(part != count.argmax())
        held = Members([np.frombuffer(members[k].as_py(), "<u8") for k in range(start, end)])
        for row in rows:
            if (part == part[row]).all():
                break
            both = held.shared_with(row)
            unite(part, row, 100 * both >= share * (n[row] + n - both))
        out.append(stars(ids[start:end], part))
    return out


def _link(rows: DataFrame, full: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """a, b: stars of the members of each group of ``keys`` that are similar."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, keys):
            for a, b in _verified_parts(groups, threshold):
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    joined = rows.select(*keys, "rep", "label").join(full, "rep")
    return joined.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(link, "a long, b long").distinct()


def verified(docs: DataFrame, classes: DataFrame, clusters: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """a, b: connects the members of each cluster as far as their full sets are similar.

    The same three rounds as for buckets: in blocks, one member of each part, and
    block by block where parts are left.
    """
    sized = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).join(
        classes.select("rep", "n_shingles"), "rep"
    )
    totals = sized.groupBy("cluster").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("count"))
    parts = F.ceil(F.greatest(F.col("total") / BLOCK_SHINGLES, F.col("count") / BLOCK_SETS))
    dealt = stage(
        sized.join(totals, "cluster").select(
            "rep", "cluster", parts.alias("blocks"), F.pmod(F.xxhash64("rep"), parts).alias("block"), F.col("rep").alias("label")
        ),
        "dealt",
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                sets = list(sets_of(block, shingle))
                yield pa.record_batch(
                    [
                        pa.array([digest(x) for x in sets], pa.binary()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ],
                    names=["digest", "n_shingles", "members"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = stage(dealt.select("rep").join(classes.select("rep", "digest", "doc_id"), "rep"), "own")
    # The same join at every size: texts are sorted once, never broadcast against.
    needed = texts.join(own.select("doc_id").hint("merge"), "doc_id", "left_semi").select("text")
    if not own.filter("doc_id is null").isEmpty():
        needed = needed.unionByName(texts.filter("doc_id is null").select("text").distinct())
    sets = needed.mapInArrow(members, "digest binary, n_shingles long, members binary")
    # Rows that repeat an id may have other sets.
    full = stage(sets.join(own.select("rep", "digest"), "digest").dropDuplicates(["rep"]).drop("digest"), "full_sets")

    links = stage(_link(dealt, full, ["cluster", "block"], threshold), "links")
    several = dealt.filter("blocks > 1").drop("label")
    if several.isEmpty():
        return links
    heads = stage(labelled(several, links).groupBy("cluster", "label", "blocks").agg(F.min("rep").alias("rep")), "heads")
    heads = heads.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    counted = heads.groupBy("cluster").agg(F.count("*").alias("heads"))
    # As many blocks as before would keep the heads of all blocks apart.
    heads = heads.join(counted, "cluster").withColumn("block", F.pmod("block", F.ceil(F.col("heads") / BLOCK_HEADS)))
    links = stage(links.unionByName(_link(heads, full, ["cluster", "block"], threshold)), "links")
    now = stage(labelled(several, links), "labelled")
    apart = now.groupBy("cluster").agg(F.min("label").alias("p"), F.max("label").alias("q")).filter("p < q").select("cluster")
    left = stage(crossed(now.join(apart, "cluster", "left_semi")), "left")
    return stage(links.unionByName(_link(left, full, ["cluster", "x", "y"], threshold)), "links")


def _grouped(docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """doc_id, text_key, n_shingles, part, component: part numbers the component, which is named by its least id."""
    rows = stage(signed(docs, shingle), "signed")
    # Sets are numbered, as ids may be null or repeated; written once, the numbers are fixed.
    classes = stage(
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    clusters = stage(components(meetings(classes.drop("digest", "doc_id"), threshold)), "clusters")
    named = components(verified(docs, classes.drop("sketch"), clusters, shingle, threshold))
    sets = stage(
        classes.join(named, F.col("rep") == F.col("node"), "left").select(
            F.col("digest").alias("set"), "doc_id", F.coalesce("component", "rep").alias("part")
        ),
        "sets",
    )
    least = sets.groupBy("part").agg(F.min("doc_id").alias("component"))
    smallest = stage(sets.drop("doc_id").join(least, "part"), "named")
    return rows.join(smallest, F.col("digest") == F.col("set"), "left").select("doc_id", "text_key", "n_shingles", "part", "component")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    component = F.coalesce("component", "doc_id")
    return _grouped(docs, shingle, threshold).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one id and text of each component, a null id only where no other is in it."""
    grouped = stage(_grouped(docs, shingle, threshold).filter("part is not null").select("part", "doc_id", "text_key"), "grouped")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("best")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key"))
    gone = grouped.join(grouped.groupBy("part").agg(best), "part").filter(~stays)
    gone = stage(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct(), "gone")
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("gone_id")) & _text_key("doc.text").eqNullSafe(F.col("gone_key"))
    return docs.select(boxed(docs)).join(gone, same, "left_anti").select("doc.*")
