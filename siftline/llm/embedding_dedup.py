"""Near-dedup of embeddings by sorted projection passes.

Each pass hashes every vector by the signs of its products with random directions
and sorts the vectors of its label by the concatenated signs; vectors at a small
angle agree in many leading signs and end up near each other.  Each vector is
compared with the next ones in that order, in double precision, as many as the
window of its label holds, and what proves similar is united; passes differ in
their directions, and the parts found by all of them are united into components.

How many passes a label takes follows from its number of vectors and from the
angles in a sample of it, so that the estimated recall is ``RECALL`` at every
size.  A window holds ``NEIGHBOURS`` vectors; where angles are so even that a
label would take very many passes, a wider one is taken if that is less work in
all.  A label that has no more vectors than a window needs one pass, and is never
cut by the border of a partition.  Signs are taken of vectors less the mean of
the sample, so that vectors to one side of the origin don't share most of them;
comparisons use the vectors as they are.

Inside a task, links become parts by vectorised union, so a pass hands on at
most one row per vector, however dense its surroundings.  The number of links of
a vector is then counted exactly: all vectors it may be linked with are in its
component, whose members are compared block by block; a block pair hands on one
number per vector.  About one isolated pair in a thousand that is just similar
enough is missed; components that were split by a miss stay split.

Equal vectors of a label fall together first and count by their number.

Defined results: vectors that are null, empty, all zero, or hold null or
non-finite components, and vectors with a null label, link with nothing and are
kept.  Vectors of different lengths are never compared.  Rows that repeat an id
count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.components import components
from siftline.llm.groups import Groups, whole_groups
from siftline.llm.tables import stage

THRESHOLD = 0.93
NEIGHBOURS = 64
PASSES = 8  # the least for a label that is larger than a window: links inside clusters don't enter the estimate
WIDEST = 8192  # of windows; well below the rows of a range partition
SORTED_ROW = 256  # comparisons that cost as much as a vector's part in one pass
ROUND = 16  # passes made in one job
RECALL = 0.999
SAMPLE_ROWS = 2048
PART_ROWS = 50_000
BLOCK_ROWS = 1024
CHUNK = 256

PLAN_SCHEMA = "label long, size int, n long, passes long, reach int, centre array<double>"
PASS_SCHEMA = "turn int, label long, size int, reach int, key long, tie long, rep long, vector "


def usable(vector: str) -> str:
    """SQL condition: a vector that can have an angle with another."""
    finite = f"forall({vector}, x -> x is not null and x = x and abs(x) < double('infinity'))"
    return f"{vector} is not null and size({vector}) > 0 and {finite} and exists({vector}, x -> x <> 0)"


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """rep, label, vector, copies: the different vectors of each label, and the rows that share one."""
    return (
        vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
        .filter(f"vec_id is not null and label is not null and {usable('vector')}")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))
    )


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Unit vectors, one per row, in double precision."""
    rows = rows.astype("f8")
    # By the largest component first, so that no square overflows or vanishes.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _directions(turn: int, size: int) -> np.ndarray:
    return np.random.default_rng([turn, size]).standard_normal((size, 64))


def passes_needed(unit: np.ndarray, n: int, threshold: float, reach: int) -> int:
    """Passes that find a pair just at the threshold with a chance of ``RECALL``.

    ``unit`` is a sample of the ``n`` vectors.  Each gets a partner at the threshold,
    in the direction of another.  The two meet in a pass if they agree in as many
    signs as leave room for no more than half of ``reach`` between them.
    Vectors similar to others of the sample are left out: they are joined through
    any of very many.
    """
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, -1)
    alone = np.flatnonzero(cosine.max(axis=1) < threshold)
    if not len(alone):
        return 1

    def agree(a: np.ndarray) -> np.ndarray:
        return 1 - np.arccos(np.clip(a, -1, 1)) / np.pi

    def flat(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)

    centre = unit.mean(axis=0)
    own, other = unit[alone], np.roll(unit, 1, axis=0)[alone]
    across = flat(other - (own * other).sum(axis=1, keepdims=True) * own)
    partner = threshold * own + np.sqrt(1 - threshold * threshold) * across
    residual = flat(own - centre)
    met = agree((residual * flat(partner - centre)).sum(axis=1))
    spread = agree(residual @ flat(unit - centre).T)
    spread[np.arange(len(alone)), alone] = 0
    signs, shared = np.full(len(alone), 64), np.ones_like(spread)
    for k in range(64):
        room = n * shared.sum(axis=1) / max(1, len(unit) - 1) <= reach / 2
        signs[room & (signs == 64)] = k
        if room.all():
            break
        shared *= spread
    # A pair at the border of two range partitions is not compared.
    missed = 1 - np.maximum(met, 0.01) ** signs * (1 - min(0.5, reach / PART_ROWS))
    low, high = 0, 1
    while (missed**high).mean() > 1 - RECALL:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if (missed**middle).mean() <= 1 - RECALL else (middle, high)
    return high


def suited(unit: np.ndarray, n: int, threshold: float, neighbours: int) -> tuple[int, int]:
    """Passes and window of a label that is larger than a window, by the least work."""
    choices, reach = [], neighbours
    while reach <= max(neighbours, min(WIDEST, n // 4)):
        passes = max(PASSES, passes_needed(unit, n, threshold, reach))
        choices.append((passes * (SORTED_ROW + reach), passes, reach))
        reach *= 2
    return min(choices)[1:]


def planned(different: DataFrame, threshold: float, neighbours: int) -> DataFrame:
    """label, size, n, passes, reach, centre of every label."""
    keys = ["label", "size"]
    sizes = stage(different.groupBy(*keys).agg(F.count("*").alias("n")), "sizes")
    small = F.col("n") <= neighbours + 1
    covered = sizes.filter(small).select(
        *keys, "n", F.lit(1).cast("long").alias("passes"), F.lit(neighbours).alias("reach"), F.lit(None).cast("array<double>").alias("centre")
    )
    sample = different.join(sizes.filter(~small), keys).filter(F.pmod(F.xxhash64("rep"), F.col("n")) < SAMPLE_ROWS)

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        unit = unit_rows(np.stack(rows["vector"].to_list()))
        passes, reach = suited(unit, int(rows["n"].iloc[0]), threshold, neighbours)
        return rows[[*keys, "n"]].head(1).assign(passes=passes, reach=reach, centre=[unit.mean(axis=0)])

    made = sample.select(*keys, "n", "vector").groupBy(*keys).applyInPandas(plan, PLAN_SCHEMA)
    return stage(covered.unionByName(made), "plan")


def sorted_keys(vectors: DataFrame, turns: range) -> DataFrame:
    """A row per pass in ``turns`` and vector, with its 64 concatenated signs as one number.

    ``vectors`` has the plan of its label beside each.  Where a window holds the
    label, all signs count as the same and nothing tells its rows apart, so that
    ranges don't cut it.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == size))
                unit = unit_rows(rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
                cut = rows.column("centre").is_valid().to_numpy(zero_copy_only=False)
                unit[cut] -= rows.column("centre").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                passes = rows.column("passes").to_numpy()
                tie = np.where(cut, rows.column("rep").to_numpy(), 0)
                for turn in turns:
                    due = passes > turn
                    if not due.any():
                        break
                    signs = ((unit[due] @ _directions(turn, size) >= 0) & cut[due, None]) @ weights
                    here = rows.filter(pa.array(due))
                    columns = {
                        "turn": pa.array(np.full(len(signs), turn, np.int32)),
                        "key": pa.array((signs ^ np.uint64(1 << 63)).view(np.int64)),
                        "tie": pa.array(tie[due]),
                    }
                    names = ["turn", "label", "size", "reach", "key", "tie", "rep", "vector"]
                    yield pa.record_batch([columns[c] if c in columns else here.column(c) for c in names], names=names)

    columns = vectors.select("rep", "label", "size", "vector", "passes", "reach", "centre")
    return columns.mapInArrow(keys, PASS_SCHEMA + vectors.schema["vector"].dataType.simpleString())


def unite(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the parts of all pairs; ``part`` names a smaller row of the same part, or the row itself."""
    while len(a):
        a, b = part[a], part[b]
        while True:
            up, down = part[a], part[b]
            if (up == a).all() and (down == b).all():
                break
            a, b = up, down
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(part, np.maximum(a, b), np.minimum(a, b))


def neighbour_parts(unit: np.ndarray, threshold: float, neighbours: int) -> np.ndarray:
    """For each row, the first row of its part when rows near in order are compared."""
    part = np.arange(len(unit))
    for a in range(0, len(unit), CHUNK):
        other = unit[a : a + CHUNK + neighbours]
        i, j = np.nonzero(unit[a : a + CHUNK] @ other.T >= threshold)
        near = (j > i) & (j - i <= neighbours)
        unite(part, i[near] + a, j[near] + a)
    while (part[part] != part).any():
        part = part[part]
    return part


def _stars(groups: Groups, start: int, end: int, threshold: float, neighbours: int) -> pa.RecordBatch:
    """a, b of the rows of one group."""
    rows = groups.table["vector"].slice(start, end - start).combine_chunks()
    unit = unit_rows(rows.flatten().to_numpy(zero_copy_only=False).reshape(end - start, -1))
    part = neighbour_parts(unit, threshold, neighbours)
    linked = part != np.arange(len(part))
    ids = groups.table["rep"].slice(start, end - start).to_numpy()
    return pa.record_batch([pa.array(ids[linked]), pa.array(ids[part[linked]])], names=["a", "b"])


def neighbour_links(keyed: DataFrame, parts: int, threshold: float) -> DataFrame:
    """a, b: each vector and the first of its part, pass by pass."""
    keys = ["turn", "label", "size"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in runs(batches, keys):
            reach = groups.column("reach")
            for start, end in zip(groups.bounds[:-1], groups.bounds[1:], strict=True):
                yield _stars(groups, start, end, threshold, int(reach[start]))

    order = [*keys, "key", "tie"]
    return keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "rep").mapInArrow(compare, "a long, b long")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[Groups]:
    """Sorted rows in tables of a batch, each with as many rows before it as the window of the last holds."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        yield Groups(table, np.concatenate([[0], np.flatnonzero(new), [table.num_rows]]))
        held = table.slice(max(0, table.num_rows - table["reach"][-1].as_py()))


def paired_blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with x, y and block: each group cut into blocks, a row for every pair of blocks it is in."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    dealt = stage(rows.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))), "dealt")
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *rows.columns, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block"
    )


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """rep, n_links: the vectors linked with each, all in its component, copies counted.

    Components are cut into blocks; every pair of blocks is compared once and
    hands on a sum per vector.
    """
    paired = paired_blocks(members, ["component"])
    keys = ["component", "x", "y"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, keys):
            ids, copies, block, x, y = (groups.column(c) for c in ("rep", "copies", "block", "x", "y"))
            vectors = groups.table["vector"].combine_chunks()
            width = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            place = np.concatenate([[0], np.cumsum(width)])
            for start, end in zip(groups.bounds[:-1], groups.bounds[1:], strict=True):
                unit = unit_rows(flat[place[start] : place[end]].reshape(end - start, width[start]))
                own, weight = block[start:end], copies[start:end]
                sums = np.zeros(end - start, np.int64)
                for a in range(0, len(unit), CHUNK):
                    near = unit[a : a + CHUNK] @ unit.T >= threshold
                    if x[start] != y[start]:  # what is inside each of two blocks is counted elsewhere
                        near &= own[a : a + CHUNK, None] != own[None, :]
                    else:
                        near[np.arange(len(near)), np.arange(a, a + len(near))] = False
                    sums[a : a + CHUNK] = near @ weight
                yield pa.record_batch([pa.array(ids[start:end]), pa.array(sums)], names=["rep", "links"])

    counted = paired.repartition(*keys).sortWithinPartitions(*keys, "block", "rep").mapInArrow(count, "rep long, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("n_links"))


def all_links(different: DataFrame, threshold: float, neighbours: int) -> DataFrame:
    """a, b: stars that connect what is similar, round by round of passes."""
    table = planned(different, threshold, neighbours)
    most, links = table.agg(F.max("passes")).first()[0] or 1, None
    for first in range(0, most, ROUND):
        # A round's passes at a time, so that the disk holds no more of them.
        due = table.filter(F.col("passes") > first)
        rows = due.agg(F.sum(F.col("n") * F.least(F.col("passes") - first, F.lit(ROUND)))).first()[0] or 0
        keyed = sorted_keys(different.join(due.drop("n"), ["label", "size"]), range(first, first + ROUND))
        found = stage(neighbour_links(keyed, max(1, -(-rows // PART_ROWS)), threshold).distinct(), "links")
        links = found if links is None else links.unionByName(found)
    return links


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    different = stage(distinct_vectors(vectors).withColumn("size", F.size("vector")), "vectors")
    named = stage(components(all_links(different, threshold, neighbours)), "components")
    members = different.join(named, F.col("rep") == F.col("node")).select("component", "rep", "copies", "vector")
    counts = count_links(members, threshold)
    known = (
        different.join(named, F.col("rep") == F.col("node"), "left")
        .join(counts, "rep", "left")
        .select(
            F.col("label").alias("known_label"),
            F.col("vector").alias("known_vector"),
            F.coalesce("component", "rep").alias("component"),
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    component = F.coalesce("component", "vec_id")
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    on = (F.col("label") == F.col("known_label")) & (F.col("vector") == F.col("known_vector"))
    return rows.join(stage(known, "known"), on, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
