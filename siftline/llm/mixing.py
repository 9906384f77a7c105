"""Mixing sources to target weights, in DataFrame functions alone.

Every source is due a share of all words by its weight, at most ``most_epochs``
times its own words.  Whole epochs are taken first: a source whose target is 2.4
times its size gives every document twice.  The rest, 0.4 of it, is filled by
Efraimidis-Spirakis sampling: each document draws the exponential key
``-ln(u) / weight`` with its quality as weight, documents are sorted by key
within their source, and a prefix sum of sizes runs up to the budget.  The
document at the border gives its first words only, so that a source meets its
target to the word.

The order is never made for all rows.  Keys fall into bins of about a thousand
rows by a monotone map; sums per bin tell in which bin the budget of a source is
spent; only that bin is sorted.  A source may hold any share of all rows.

Defined results: null sources are a source of their own, the last.  Null and
empty texts have size 0 and give nothing.  Rows that repeat an id are separate
rows, told apart by their place.  The draw depends on seed and doc_id alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.tables import SPACE, WORD, boxed, stage, text_of

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BIN_ROWS = 1000
USUAL_WORD = 5.0


def count_words(text: str | Column = "text") -> Column:
    """Number of runs of non-blank characters.

    Each word and the blanks after it become one mark; blanks before the first
    word are cut off.
    """
    marks = F.regexp_replace(text_of(text), f"{WORD}++{SPACE}*+", "w")
    return F.length(F.regexp_replace(marks, SPACE + "+", "")).cast("long")


def usual_length(chars: Column, words: Column) -> Column:
    """A quality weight in (0, 1]: how near the mean word length is to the usual one."""
    mean = (chars - words + 1) / F.when(words > 0, words)
    return F.coalesce(F.greatest(F.least(mean / USUAL_WORD, USUAL_WORD / mean), F.lit(0.01)), F.lit(0.01))


def draw(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) by seed and id."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(hexed, 16, 10).cast("double") + 0.5) / float(2**48)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target from source, source_size, n_rows.

    Sources are numbered by name, and take the weights in turn.  A source above
    its most keeps that, and what it can't take is shared by weight among the
    others until none is above: sources are filled in ascending order of most
    per weight, so one running sum tells the level of the rest.  The table has
    one row per source, so its windows need no partition.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    named = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * most_epochs)
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    heavy = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    levels = named.withColumn("level", left / heavy)
    open_ = F.col("level") * F.col("w") < F.col("most")
    # The first source in that order that stays below its most has the level of all after it.
    level = F.first(F.when(open_, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("most").cast("double"), F.col("w") * F.coalesce(level, F.lit(0.0)))
    return levels.select(
        "source", "source_size", "n_rows", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: int = 7,
    quality=usual_length,
    whole_documents: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, row: one row per row of ``docs``.

    With ``whole_documents`` the document at the border is taken whole or not at
    all, whichever is nearer.
    """
    counted = docs.select("doc_id", "source", F.length(text_of()).alias("chars"), count_words().alias("size"))
    u = draw(F.col("doc_id"), seed)
    w = quality(F.col("chars"), F.col("size"))
    rows = stage(
        counted.select("doc_id", "source", "size", (-F.log(u) / w).alias("key"), F.monotonically_increasing_id().alias("row")),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = stage(source_targets(sizes, weights, most_epochs), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    due = targets.select(
        F.col("source").alias("due_source"),
        "source_size",
        "target",
        epochs.alias("epochs"),
        (F.round(F.col("target")).cast("long") - epochs * F.col("source_size")).alias("rest"),
        F.ceil(F.col("n_rows") / BIN_ROWS).alias("bins"),
    )
    # exp(-key) falls as keys rise, and spreads them evenly where weights are near 1.
    place = F.floor(F.col("bins") * (1 - F.exp(-F.col("key"))))
    placed = stage(
        rows.join(due, F.col("source").eqNullSafe(F.col("due_source"))).withColumn("bin", place).drop("due_source", "bins"),
        "placed",
    )

    so_far = Window.partitionBy("source").orderBy("bin")
    border = (
        placed.groupBy("source", "bin", "rest")
        .agg(F.sum("size").alias("bin_size"))
        .withColumn("before", F.sum("bin_size").over(so_far) - F.col("bin_size"))
        .filter("before < rest and before + bin_size >= rest")
        .select(F.col("source").alias("border_source"), F.col("bin").alias("border_bin"), "before")
    )
    bordered = stage(
        placed.join(border, F.col("source").eqNullSafe(F.col("border_source")), "left").select(
            "doc_id", "row", "key", "size", "source", "source_size", "target", "epochs", "rest", "bin", "border_bin", "before"
        ),
        "bordered",
    )

    at_border = bordered.filter("bin = border_bin")
    up_to = Window.partitionBy("source").orderBy("key", "doc_id", "row")
    first = F.col("before") + F.sum("size").over(up_to) - F.col("size")
    fills = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("first")))
    if whole_documents:
        fills = F.when(fills * 2 > F.col("size"), F.col("size")).otherwise(0)
    sorted_ = at_border.withColumn("first", first).withColumn("part", fills.cast("long"))
    others = bordered.filter("border_bin is null or bin <> border_bin").withColumn(
        "part", F.when(F.col("bin") < F.col("border_bin"), F.col("size")).otherwise(0).cast("long")
    )
    columns = ["doc_id", "row", "size", "source_size", "target", "epochs", "part"]
    return (
        sorted_.select(*columns)
        .unionByName(others.select(*columns))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
            "row",
        )
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 7
) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows of equal id and size share their number."""
    taken = (
        mix(docs, weights, most_epochs, seed, whole_documents=True)
        .filter("taken > 0")
        .groupBy("doc_id", "size")
        .agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("times"))
    )
    on = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("words") == F.col("size"))
    counted = docs.select(boxed(docs), count_words().alias("words"))
    return counted.join(taken, on).select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")
