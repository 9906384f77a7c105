"""Cross-source merge of postings that are the same opening."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import canonical_key
from siftline.operators.skew import preceding_sum

# What a filled column is worth when the best copy is chosen.
COMPLETENESS = (
    ("jd_text", 10),
    ("posted_date", 5),
    ("salary_info", 3),
    ("experience_required", 2),
    ("location", 1),
)

# Completeness (below 2^5) and sequence number share one whole number, so that
# the best copy is a plain max() that combines before the shuffle.
SEQ_BITS = 57
SEQ_MAX = (1 << SEQ_BITS) - 1

# Merged groups come after all postings without a key.
_GROUPS_START = 1 << 60


def completeness() -> Column:
    return reduce(
        add, (F.when(F.col(c) != "", F.lit(w)).otherwise(F.lit(0)) for c, w in COMPLETENESS)
    )


def with_merge_columns(postings: DataFrame) -> DataFrame:
    """Add ``canonical_key`` and ``completeness``; no text is needed after this."""
    return postings.withColumn(
        "canonical_key", canonical_key(F.col("company"), F.col("title"))
    ).withColumn("completeness", completeness())


def _copies(postings: DataFrame) -> DataFrame:
    rank = F.col("completeness").cast("bigint") * (1 << SEQ_BITS) + (F.lit(SEQ_MAX) - F.col("seq"))
    return postings.where(F.col("canonical_key") != "").select(
        "canonical_key", "seq", "source", "dedup_key", rank.alias("rank")
    )


def merge_cross_platform(postings: DataFrame) -> DataFrame:
    """Keep the most complete copy of each canonical key, the earliest on ties.

    Needs ``seq`` (unique, below 2^57), ``source``, ``dedup_key`` and the columns
    of :func:`with_merge_columns`.  Postings with a blank key all stay, and skip
    the shuffle.  Adds

    * ``canonical_group_id``: the winner's key and the other sources that have a
      copy, each once, by their best copy, joined by ``+``; blank when no other
      source has one;
    * ``merge_order``: unkeyed postings first, then groups by first appearance.

    Copies are first brought down to one row per key and source, so a cell has
    at most as many names as there are sources, and a key with any share of all
    rows combines before the shuffle.  All copies are in :func:`group_members`.
    """
    by_source = (
        _copies(postings)
        .groupBy("canonical_key", "source")
        .agg(
            F.max("rank").alias("rank"),
            F.max_by("dedup_key", "rank").alias("dedup_key"),
            F.min("seq").alias("first_seq"),
        )
    )
    best_first = F.sort_array(F.collect_list(F.struct("rank", "source")), asc=False)
    groups = by_source.groupBy("canonical_key").agg(
        best_first.alias("ranked"),
        F.max_by("dedup_key", "rank").alias("winner"),
        F.min("first_seq").alias("first_seq"),
    )
    others = F.slice("ranked", 2, F.size("ranked"))["source"]
    rank = F.col("ranked")[0]["rank"]
    winners = groups.select(
        (F.lit(SEQ_MAX) - rank.bitwiseAND(F.lit(SEQ_MAX))).alias("seq"),
        F.when(F.size("ranked") > 1, F.concat_ws("+", F.col("winner"), F.array_join(others, "+")))
        .otherwise("")
        .alias("canonical_group_id"),
        (F.lit(_GROUPS_START) + F.col("first_seq")).alias("merge_order"),
    )

    merged = postings.where(F.col("canonical_key") != "").join(winners, "seq")
    alone = (
        postings.where(F.col("canonical_key") == "")
        .withColumn("canonical_group_id", F.lit(""))
        .withColumn("merge_order", F.col("seq"))
    )
    return alone.unionByName(merged)


def group_members(postings: DataFrame) -> DataFrame:
    """Every copy of every canonical key with its position, the best copy being 1.

    The long form of ``canonical_group_id``, repeats of a source included.
    Positions are a distributed prefix count, so that a group spreads over tasks.
    """
    ahead = preceding_sum(
        _copies(postings).withColumn("_order", -F.col("rank")),
        F.lit(1),
        order="_order",
        group=["canonical_key"],
        name="_ahead",
    )
    position = (F.col("_ahead") + 1).cast("bigint").alias("position")
    return ahead.select("canonical_key", position, "dedup_key", "source")
