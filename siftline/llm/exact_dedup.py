"""Exact dedup by progressive refinement, in DataFrame functions alone.

Texts are equal when they are identical after deleting white space.  Rows are
grouped by normalised length, the groups of two and more by a hash of the first
characters, and what still has company by the SHA-256 of the full content.  Each
level reads only the rows and columns that the one before left.

A columnar file can't hand out the length or the head of a text without decoding
it, so the one scan of the texts writes all three keys; the digest column, which
stands for the full content, is then read for surviving groups alone, and no
text is ever shuffled.

Groups may be of any size: counts and winners are partial aggregates, and the
joins that hand them back to rows carry nothing that needs a key's rows in one
task, so AQE can split a hot key.

Defined results: null and empty texts are equal to each other and to texts of
white space alone.  A null id is larger than any number.  Rows that repeat an id
and a text are separate rows; exactly one of a group has ``kept``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.tables import SPACE, boxed, stage, text_of

PREFIX = 64


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_of(text), SPACE + "+", "")


def signatures(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """doc_id, row, chars, norm_length, prefix_hash, text_sha256; one scan, written once.

    ``row`` tells rows with equal ids apart; it is fixed by being written.
    """
    norm = docs.select("doc_id", F.length(text_of()).alias("chars"), normalised().alias("norm"))
    return stage(
        norm.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "chars",
            F.length("norm").alias("norm_length"),
            F.xxhash64(F.substring("norm", 1, prefix)).alias("prefix_hash"),
            F.sha2("norm", 256).alias("text_sha256"),
        ),
        "signatures",
    )


def _with_company(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows whose keys occur twice or more."""
    # A written table, so that the join has a shuffle of its own and can split a hot key.
    shared = stage(rows.groupBy(*keys).count().filter("count > 1").select(*keys), f"{name}_keys")
    return stage(rows.join(shared, keys, "left_semi"), name)


def exact_groups(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Of equal texts, the row with the most characters in the original text stays,
    then the one with the smallest doc_id.
    """
    rows = signatures(docs, prefix)
    narrow = rows.select("row", "norm_length", "prefix_hash")
    same_length = _with_company(narrow, ["norm_length"], "same_length")
    same_prefix = _with_company(same_length, ["norm_length", "prefix_hash"], "same_prefix")

    survivors = rows.join(same_prefix.select("row"), "row", "left_semi")
    order = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    groups = stage(
        survivors.groupBy(F.col("text_sha256").alias("digest"))
        .agg(F.count("*").alias("size"), F.min(order).alias("best"))
        .filter("size > 1"),
        "groups",
    )
    alone = F.col("digest").isNull()
    return rows.join(groups, rows.text_sha256 == groups.digest, "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another row of equal text stands for.

    Rows that repeat an id and a text count as one; ids are otherwise taken to
    be distinct.
    """
    gone = stage(
        exact_groups(docs).filter("not kept").select(F.col("doc_id").alias("gone_id"), "keep_id", F.col("text_sha256").alias("gone_sha256")),
        "gone",
    )
    same_id = F.col("gone_id").eqNullSafe(F.col("keep_id"))
    on = F.col("doc.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("sha256") == F.col("gone_sha256"))
    hashed = docs.select(boxed(docs), F.sha2(normalised(), 256).alias("sha256"))
    kept = hashed.join(gone.filter(~same_id), on, "left_anti")
    again = gone.filter(same_id).select("gone_id", "gone_sha256").distinct()
    if not again.isEmpty():
        once = kept.join(again, on, "left_semi").withColumn("id", F.col("doc.doc_id")).dropDuplicates(["id", "sha256"]).drop("id")
        kept = kept.join(again, on, "left_anti").unionByName(once)
    return kept.select("doc.*")
