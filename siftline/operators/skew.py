"""Keyed lookups and running sums that hold when one key has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEYS = 64
_SPREAD = 4096
_BLOCK_BITS = (48, 32, 16)


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    spread_by: str,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join of ``facts`` with ``dim`` (one row per ``key``), skew-proof.

    ``dim[weight]`` says how many fact rows a key has.  The ``hot_keys`` heaviest
    rows of ``dim`` are broadcast: a bounded number, whatever the data.  Fact
    rows they serve, and those without a key, are scattered over the shuffle by
    ``spread_by`` instead of following their key; every other key has at most
    one in ``hot_keys`` of the rows and takes the ordinary shuffled join.
    """
    values = [c for c in dim.columns if c not in (key, weight)]
    packed = F.struct(*values)
    heavy = (
        dim.orderBy(F.col(weight).desc(), F.col(key))
        .limit(hot_keys)
        .select(key, packed.alias("_hot"))
    )
    # Always 0, but not a literal: that would be folded into a filter on the
    # other side, and the salt would drop out of the shuffle key.
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    light = dim.select(F.col(key).alias("_light_key"), zero.alias("_salt"), packed.alias("_light"))
    scattered = F.col("_hot").isNotNull() | F.col(key).isNull()
    salted = (
        facts.join(F.broadcast(heavy), key, "left")
        .withColumn("_light_key", F.when(~scattered, F.col(key)))
        .withColumn(
            "_salt",
            F.when(scattered, F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("int"))
            .otherwise(0),
        )
    )
    found = F.coalesce(F.col("_hot"), F.col("_light"))
    return salted.join(light, ["_light_key", "_salt"], "left").select(
        *facts.columns, *[found[c].alias(c) for c in values]
    )


def preceding_sum(
    df: DataFrame,
    value: Column,
    order: str,
    lead: Sequence[tuple[str, bool]] = (),
    group: Sequence[str] = (),
    name: str = "preceding",
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, as a distributed prefix sum.

    Rows are ordered by the ``lead`` columns (name, descending?) and then by the
    unique whole number ``order``.  A window over the whole group would be one
    task.  Instead the numbers are cut into blocks of 2^16, those into blocks of
    2^32 and of 2^48, and each level is summed within its parent only.  So no
    window partition has more than 2^16 rows, apart from the topmost, which has
    one row per 2^48 numbers and combination of ``lead`` values.
    """
    lead_names = [c for c, _ in lead]
    lead_sort = [F.col(c).desc() if down else F.col(c).asc() for c, down in lead]
    levels = [f"_block_{bits}" for bits in _BLOCK_BITS]
    base = [*group, *lead_names]

    def before(column: str, parts: Sequence[str], sort: Sequence[Column | str]) -> Column:
        w = Window.partitionBy(*parts).orderBy(*sort)
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    rows = df.withColumns(
        {level: F.shiftright(order, bits) for level, bits in zip(levels, _BLOCK_BITS)}
    ).withColumn("_value", value)

    # Totals from the finest blocks up to the coarsest.
    totals = {}
    below, summed = rows, "_value"
    for i in reversed(range(len(levels))):
        below = below.groupBy(*base, *levels[: i + 1]).agg(F.sum(summed).alias("_sum"))
        totals[i], summed = below, "_sum"

    # What lies before each block, from the coarsest down to the finest.
    starts = totals[0].select(
        *base, levels[0], before("_sum", group, [*lead_sort, levels[0]]).alias("_start")
    )
    for i in range(1, len(levels)):
        parent = [*base, *levels[:i]]
        starts = (
            totals[i]
            .withColumn("_within", before("_sum", parent, [levels[i]]))
            .join(starts, parent)
            .select(*parent, levels[i], (F.col("_within") + F.col("_start")).alias("_start"))
        )

    finest = [*base, *levels]
    return (
        rows.join(starts, finest)
        .withColumn(name, F.col("_start") + before("_value", finest, [order]))
        .select(*df.columns, name)
    )
