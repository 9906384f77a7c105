"""Whole numbers from 0 without gaps, in the order of any sortable columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.session import stage as stage_table

_ROW_BITS = 33  # of monotonically_increasing_id


def dense_numbers(
    rows: DataFrame,
    order: Sequence[str],
    name: str = "number",
    stage: Callable[[DataFrame, str], DataFrame] = stage_table,
) -> DataFrame:
    """``rows`` with their places in the order of columns that tell all of them apart.

    Rows are sorted by ranges and written with the partition and the place in it;
    the number is the place and what all earlier partitions hold.  So numbers are
    exact for any count of rows, no task has more than a range, and the one window
    has a row per partition.  ``rows`` is read twice: stage it where it is costly.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), name)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", before.alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        *rows.columns, (F.col("_start") + F.col("_place")).alias(name)
    )
