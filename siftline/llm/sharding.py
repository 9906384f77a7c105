"""Sharding by jump consistent hashing, in DataFrame functions alone.

A key's shard follows from the key and the number of shards, without a table of
the ring.  The key seeds a generator; each number it gives says at which larger
number of shards the key moves next.  So with one more shard only the keys that
move into it move, about one in the new number.  Keys may be of any type: they
are hashed to 64 bits by the MD5 of their text, and the generator is a linear
congruential one, whose products are made of 16-bit limbs, because whole 64-bit
ones overflow.

A key takes a step for every move, about ln(shards) of them.  ``STEPS`` steps are
tried for all rows, and the rare key that needs more goes on to the end.

Slots number the rows of a shard from 0 without gaps, by key.  They come from one
range sort over shards and keys: the place of a row in its partition, less the
place at which its shard begins there, plus what the shard has in partitions
before.  A shard may so hold any share of all rows and no task numbers a shard
alone; the only table that is summed in order has a row per partition and shard.

Defined results: null text has size 1 and the digest of the empty text.  A null
key is a key of its own, and so is every other; rows that repeat a key share its
shard and have slots of their own.  Other columns, whatever their names, are not
read.  Texts may be of any length; they are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.tables import stage, text_of

STEPS = 48
NO_KEY = "\x00"

# The generator of the published algorithm: 64-bit products with this, plus one.
FACTOR = 2862933555777941757
_LIMBS = [(FACTOR >> (16 * i)) & 0xFFFF for i in range(4)]
_LOW = (1 << 32) - 1
_LIMB = 0xFFFF


def key_halves(key: str | Column) -> tuple[Column, Column]:
    """The upper and lower 32 bits of a key's hash, as whole numbers."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.coalesce(column.cast("string"), F.lit(NO_KEY)).cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state: the halves times ``FACTOR``, plus one, modulo 2**64."""
    m0, m1, m2, m3 = (F.lit(m).cast("long") for m in _LIMBS)

    def limb(c: Column) -> Column:
        return c.bitwiseAND(F.lit(_LIMB))

    t1 = low * m1
    below = low * m0 + F.shiftleft(limb(t1), 16) + F.lit(1)
    above = (
        F.shiftright(below, 32)
        + F.shiftright(t1, 16)
        + low * m2
        + F.shiftleft(limb(low * m3), 16)
        + high * m0
        + F.shiftleft(limb(high * m1), 16)
    )
    return above.bitwiseAND(F.lit(_LOW)), below.bitwiseAND(F.lit(_LOW))


def _jump(state: Column, shards: int) -> Column:
    """One step: from the shard held to the one the key moves to next, if there are so many."""
    high, low = _next(state["high"], state["low"])
    drawn = F.shiftright(high, 1) + F.lit(1)  # of the state's upper 33 bits, less two: 1 to 2**31
    reach = (state["to"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / drawn.cast("double"))
    moved = F.struct(
        state["to"].alias("at"), F.floor(reach).cast("long").alias("to"), high.alias("high"), low.alias("low")
    )
    return F.when(state["to"] < F.lit(shards), moved).otherwise(state)


def jump(key: str | Column, shards: int) -> Column:
    """Struct of ``at``, the key's shard, and ``to``, the first number of shards with which it lies elsewhere, less one."""
    if shards < 1:
        raise ValueError("there must be a shard")
    high, low = key_halves(key)
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"), high.alias("high"), low.alias("low"))

    def steps(state: Column, n: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(n)), state, lambda s, _: _jump(s, shards))

    tried = steps(start, min(STEPS, shards))
    if shards <= STEPS:  # a step moves up by one shard at least
        return tried
    # Held by a lambda, so that it is reckoned once.
    return F.transform(
        F.array(tried), lambda s: F.when(s["to"] < F.lit(shards), steps(s, shards)).otherwise(s)
    )[0]


def in_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id (the key), size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``.

    ``grown_shard`` is the shard with one more of them.
    """
    data = text_of(text).cast("binary")
    hashed = docs.select(F.col(key).alias("doc_id"), (F.octet_length(data).cast("long") + 1).alias("size"), F.crc32(data).alias("text_crc32"))
    hashed = hashed.withColumn("jump", jump("doc_id", shards)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("jump.at").cast("int").alias("shard"),
        # The last step went beyond all shards: to the one added next, or farther.
        F.when(F.col("jump.to") == shards, F.lit(shards)).otherwise(F.col("jump.at")).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["shard", "doc_id", "size", "text_crc32", "row"]  # the row splits a hot key; equal rows are alike otherwise
    placed = stage(
        stage(hashed, "hashed")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        "placed",
    )
    return _numbered(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """``placed`` with slot, from the places in partitions."""
    runs = placed.groupBy("part", "shard").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per partition, and one for each shard that ends inside of one.
    starts = runs.select("part", "shard", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(F.broadcast(starts), ["part", "shard"]).withColumn("slot", F.col("place") + F.col("shift"))
