"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word begins a suffix: the words from there to the end of its piece, at most
``longest`` of them.  A task sorts pointers to the suffixes of its texts, one
word after the other: the pointers are cut in three by a pivot's word at the
current depth, and the equal part goes on at the next depth, down to the longest
phrase.  Equal parts are what is counted.  So a task hands on each different
suffix once, with its count, whatever its share of the text.

Suffixes are routed to all tasks by their leading word, and by two or more of
them where these are among the ``HOT`` most frequent of a sample.  There they are
sorted again, with their counts for weights, and parts whose suffixes weigh less
than ``least`` together are abandoned before the next depth: no phrase that begins
like them is frequent.  The sample decides where suffixes go and nothing else.
Counts of a phrase that was routed by more words than it has are added up.

Words are 64-bit hashes of language and word, phrases are hashes of these; two of
them share one with a chance of about 2**-64 per pair.  Words in letters travel
once per block and are kept for frequent words alone.  All that follows works on
frequent phrases.

Memory: a block of texts has ``BLOCK_BYTES`` or one text, a route about the
suffixes of ``ROUTE_BYTES`` of text.  Where all phrases with equal scores and
counts at the end of a report don't fit into it, all of them are put in letters
before the last are cut.

Defined results: null text is empty, null language is ``und``.  Repeated rows count
as often as they occur.  Texts of any length are read whole.  Ties are broken by
the phrase.  Other columns, whatever their names, are not read; a table without
frequent phrases gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.tables import stage, text_of
from siftline.llm.words import LOWER, Block, blocks, mix, split, word_hashes
from siftline.operators.skew import lookup

LONGEST = 3
LEAST = 10
COVER = 50  # per cent of a phrase's occurrences inside a longer one that make it part of that
TOP = 2000
SCALE = 1_000_000

BLOCK_BYTES = 4 << 20
ROUTE_BYTES = 16 << 20
HOT = 1024
SAMPLE_ROWS = 16_384
SMALL = 1 << 13  # parts of so few pointers are finished by one sort

END = np.uint64(0)  # no word: the piece is over
_ODD = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"

PIECE_END = np.zeros(256, bool)
PIECE_END[list(b".,;:!?\n\v\f\r")] = True
NO_WORD = PIECE_END.copy()
NO_WORD[list(b" \t")] = True

SUFFIXES, WORDS, TOTAL = 0, 1, 2
ROUTED = "route int, kind int, data binary, words binary, langs array<string>, n long"
FOUND = (
    "kind int, id long, size int, a long, words array<long>, lefts array<long>, rights array<long>, inner array<long>, "
    "lang string, word string"
)


def joined(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Ids of phrases with one more word."""
    return mix(phrase * _ODD + word)


def phrase_id(columns: list[np.ndarray]) -> np.ndarray:
    """Ids of the phrases made of words in ``columns``; a word's is its own."""
    out = columns[0]
    for column in columns[1:]:
        out = joined(out, column)
    return out


# Suffix pointers


def multikey(columns: list[np.ndarray], weights: np.ndarray, least: int = 1, small: int = SMALL) -> np.ndarray:
    """Pointers to rows, those with equal leading words side by side.

    Equal parts that weigh less than ``least`` are abandoned where they show up:
    they count for the words they share, and are not sorted by those that follow.
    """
    waiting, done = [(np.arange(len(weights)), 0)], []
    while waiting:
        rows, depth = waiting.pop()
        if depth == len(columns):
            done.append(rows)
        elif len(rows) <= small:
            done.append(rows[np.lexsort([column[rows] for column in columns[depth:][::-1]])])
        else:
            keys = columns[depth][rows]
            sample = np.sort(keys[:: -(-len(keys) // 15)])
            pivot = sample[len(sample) // 2]
            less, more = keys < pivot, keys > pivot
            equal = rows[~(less | more)]
            waiting += [(rows[less], depth), (rows[more], depth)]
            if weights[equal].sum() >= least:
                waiting.append((equal, depth + 1))
            else:
                done.append(equal)
    return np.concatenate([np.zeros(0, np.int64), *done])


def prefixes(columns: list[np.ndarray], weights: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth (a row of each part with equal leading words, the part's weight)."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    weights = weights[order]
    for column in columns:
        keys = column[order]
        new[1:] |= keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(weights, starts) if len(starts) else weights[:0]
        there = keys[starts] != END
        yield order[starts[there]], sums[there]


def suffixes(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different suffixes and how often each occurs."""
    ones = np.ones(len(columns[0]), np.int64)
    order = multikey(columns, ones)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    starts = np.flatnonzero(new)
    return [c[starts] for c in columns], np.diff(np.append(starts, len(order)))


class Texts:
    """The words of a block of texts."""

    def __init__(self, block: Block, lang_keys: np.ndarray) -> None:
        self.data = LOWER[block.data]
        block = block._replace(data=self.data)
        self.words = split(block, NO_WORD)
        self.row = np.repeat(np.arange(block.rows), np.diff(self.words.bounds))
        ids = mix(word_hashes(self.data, self.words) ^ lang_keys[self.row])
        self.ids = np.where(ids == END, np.uint64(1), ids)

    def columns(self, longest: int) -> list[np.ndarray]:
        """The word at each depth of each suffix."""
        n = len(self.ids)
        piece = np.cumsum(PIECE_END[self.data], dtype=np.int64)[self.words.starts]
        out, together = [self.ids], np.ones(n, bool)
        follows = np.zeros(n, bool)
        follows[:-1] = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])
        for depth in range(1, longest):
            # The word before the one at this depth is there, and one follows it in its piece.
            there = np.zeros(n, bool)
            there[: max(0, n - depth + 1)] = follows[depth - 1 :]
            together = together & there
            column = np.zeros(n, np.uint64)
            column[: max(0, n - depth)] = self.ids[depth:]
            out.append(np.where(together, column, END))
        return out

    def vocabulary(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The different words: ids, letters and a row of each."""
        ids, first = np.unique(self.ids, return_index=True)
        data = self.data.tobytes()
        spans = zip(self.words.starts[first].tolist(), self.words.ends[first].tolist(), strict=True)
        return ids, [data[a:b] for a, b in spans], self.row[first]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Texts, list[str], int]]:
    for batch in batches:
        keys = batch.column("lang_key").to_numpy().view(np.uint64)
        for block in blocks(batch.column("text"), BLOCK_BYTES):
            langs = batch.column("lang").slice(block.first, block.rows).to_pylist()
            yield Texts(block, keys[block.first : block.first + block.rows]), langs, len(block.data)


# Routing


def _hot(rows: DataFrame, longest: int) -> tuple[np.ndarray, int]:
    """Ids of the most frequent words and leading phrases of a sample, and how many routes there should be."""
    spark = rows.sparkSession
    routes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLE_ROWS / max(1, rows.count()))
    sample = rows if share == 1.0 else rows.sample(share, seed=1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _, size in _texts(batches):
            columns, counts = suffixes(texts.columns(longest))
            ids, sums = [np.zeros(1, np.uint64)], [np.array([counts.sum()])]
            order = np.arange(len(counts))  # they are sorted
            for depth, (at, weight) in enumerate(prefixes(columns[:-1], counts, order)):
                often = weight >= max(2, counts.sum() // (16 * routes))
                ids.append(phrase_id([c[at[often]] for c in columns[: depth + 1]]))
                sums.append(weight[often])
            ids, sums = np.concatenate(ids), np.concatenate(sums)
            sizes = np.zeros(len(ids), np.int64)
            sizes[0] = size
            yield pa.record_batch([pa.array(ids.view(np.int64)), pa.array(sums), pa.array(sizes)], names=["id", "n", "bytes"])

    counted = sample.mapInArrow(count, "id long, n long, bytes long").groupBy("id").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    top = counted.orderBy((F.col("id") == 0).desc(), F.col("n").desc()).limit(HOT + 1).collect()
    if not top:
        return np.zeros(0, np.uint64), routes
    routes = max(routes, int(top[0]["bytes"] / share) // ROUTE_BYTES)
    ids = [r["id"] for r in top[1:] if r["n"] * 4 * routes > top[0]["n"]]
    return np.sort(np.array(ids, np.int64).view(np.uint64)), routes


def _among(ids: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(ids), bool)
    return hot[np.minimum(np.searchsorted(hot, ids), len(hot) - 1)] == ids


def route_of(columns: list[np.ndarray], hot: np.ndarray, routes: int) -> np.ndarray:
    """By the leading word, and by one more for as long as the ones before are hot."""
    key, going = columns[0].copy(), np.ones(len(columns[0]), bool)
    for column in columns[1:]:
        going &= (column != END) & _among(key, hot)
        key[going] = joined(key[going], column[going])
    return (mix(key) % np.uint64(routes)).astype(np.int64)


def _by_route(route: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(route, kind="stable")
    cuts = np.flatnonzero(np.diff(route[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(route[part[0]]), part


def _routed(rows: DataFrame, longest: int, hot: np.ndarray, routes: int) -> DataFrame:
    """The different suffixes of each block, its words in letters, and the words of each language."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs, _ in _texts(batches):
            out = []
            columns, counts = suffixes(texts.columns(longest))
            for route, part in _by_route(route_of(columns, hot, routes)):
                out.append((route, SUFFIXES, b"".join(c[part].tobytes() for c in [*columns, counts]), None, None, None))
            ids, letters, row = texts.vocabulary()
            for route, part in _by_route(route_of([ids], hot, routes)):
                words = b" ".join([letters[i] for i in part])
                out.append((route, WORDS, ids[part].tobytes(), words, [langs[r] for r in row[part]], None))
            kinds, lang_of = np.unique(np.array(langs, object), return_inverse=True)
            n = np.bincount(lang_of[texts.row], minlength=len(kinds))
            out += [(k % routes, TOTAL, None, None, [lang], int(n[k])) for k, lang in enumerate(kinds)]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True),
                    [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.int64()],
                    strict=True,
                )],
                names=["route", "kind", "data", "words", "langs", "n"],
            )

    return rows.mapInArrow(read, ROUTED)


# Counting


def _lists(columns: list[np.ndarray], n: int) -> pa.Array:
    """A list array with one value of each column per row."""
    flat = np.stack(columns, axis=1).reshape(-1) if columns else np.zeros(0, np.uint64)
    bounds = np.arange(n + 1, dtype=np.int32) * len(columns)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))


def _phrases(columns: list[np.ndarray], a: np.ndarray) -> pa.RecordBatch:
    """Phrases with their words, the two parts of every cut, and the shorter phrases inside."""
    size, n = len(columns), len(a)
    inner = [
        phrase_id(columns[i : i + length]) for length in range(2, size) for i in range(size - length + 1)
    ]
    nothing = pa.nulls(n, pa.string())
    return pa.record_batch(
        [
            pa.array(np.full(n, SUFFIXES, np.int32)),
            pa.array(phrase_id(columns).view(np.int64)),
            pa.array(np.full(n, size, np.int32)),
            pa.array(a),
            _lists(columns, n),
            _lists([phrase_id(columns[:k]) for k in range(1, size)], n),
            _lists([phrase_id(columns[k:]) for k in range(1, size)], n),
            _lists(inner, n),
            nothing,
            nothing,
        ],
        names=[c.split()[0] for c in FOUND.split(", ")],
    )


def _words(kind: int, ids: list[int | None], a: list[int | None], langs: list[str], words: list[str | None]) -> pa.RecordBatch:
    n = len(langs)
    empty = pa.nulls(n, pa.list_(pa.int64()))
    return pa.record_batch(
        [pa.array(np.full(n, kind, np.int32)), pa.array(ids, pa.int64()), pa.nulls(n, pa.int32()), pa.array(a, pa.int64())]
        + [empty] * 4
        + [pa.array(langs, pa.string()), pa.array(words, pa.string())],
        names=[c.split()[0] for c in FOUND.split(", ")],
    )


def _counted(routed: DataFrame, longest: int, least: int, hot: np.ndarray, routes: int) -> DataFrame:
    """Frequent phrases, and parts of the counts of hot ones; the letters of their words; words per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, vocabulary = [], {}
        for batch in batches:
            for kind, data, words, langs, n in zip(*(batch.column(c) for c in ("kind", "data", "words", "langs", "n")), strict=True):
                if kind.as_py() == SUFFIXES:
                    parts.append(np.frombuffer(data.as_buffer(), np.uint64).reshape(longest + 1, -1))
                elif kind.as_py() == WORDS:
                    ids = np.frombuffer(data.as_buffer(), np.int64).tolist()
                    vocabulary.update(zip(ids, zip(langs.as_py(), words.as_py().split(b" "), strict=True), strict=True))
                else:
                    yield _words(TOTAL, [None], [n.as_py()], langs.as_py(), [None])
        table = np.concatenate([np.zeros((longest + 1, 0), np.uint64), *parts], axis=1)
        parts.clear()  # and the batches they lie in
        columns, weights = list(table[:longest]), table[longest].view(np.int64)
        frequent = hot
        order = multikey(columns, weights, least)
        for depth, (at, a) in enumerate(prefixes(columns, weights, order)):
            own = [c[at] for c in columns[: depth + 1]]
            kept = (a >= least) | _among(phrase_id(own), hot)  # of a hot one, other routes may have the rest
            own, a = [c[kept] for c in own], a[kept]
            if depth == 0:
                frequent = np.sort(np.concatenate([hot, own[0]]))
            if len(a):
                yield _phrases(own, a)
        there = np.array(list(vocabulary), np.int64).view(np.uint64)
        known = [(i, *vocabulary[i]) for i in there[_among(there, frequent)].view(np.int64).tolist()]
        if known:
            ids, langs, words = zip(*known, strict=True)
            yield _words(WORDS, list(ids), [None] * len(ids), list(langs), [w.decode() for w in words])

    return routed.repartitionById(routes, "route").mapInArrow(count, FOUND)


# Scores


def _scored(counts: DataFrame, words: DataFrame, cover: int) -> DataFrame:
    """id, words, lang, a, l, r, score of the phrases of two words and more that no longer one covers."""
    phrases = counts.filter("size > 1")
    cuts = stage(
        phrases.select("id", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "part")).select(
            "id", "a", "k", F.col("part.lefts").alias("left"), F.col("part.rights").alias("right")
        ),
        "cuts",
    )
    known = stage(counts.select("id", "a").join(words, "id", "left"), "known")
    with_left = lookup(
        cuts, known.select(F.col("id").alias("left"), F.col("a").alias("weight"), F.col("a").alias("l"), "lang"), "left", "weight", "id"
    )
    with_both = lookup(
        with_left, known.select(F.col("id").alias("right"), F.col("a").alias("weight"), F.col("a").alias("r")), "right", "weight", "id"
    )
    # Counts have at most 15 digits, so all products are exact.
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    whole = F.lit(SCALE).cast("decimal(7,0)") * (a * a)
    score = F.call_function("div", whole, l * r)
    best = (
        with_both.withColumn("score", score)
        .groupBy("id")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("lang").alias("lang"))
    )
    longer = phrases.select(F.explode("inner").alias("id"), F.col("a").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
    kept = phrases.join(longer, "id", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    return kept.select("id", "words", "a").join(best, "id").select("id", "words", "lang", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover: int = COVER, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to ``longest`` words of every language."""
    if longest < 2:
        raise ValueError("a phrase has two words or more")
    lang = F.coalesce(F.col("lang"), F.lit(UNKNOWN))
    rows = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_key"), text_of().alias("text"))
    hot, routes = _hot(rows, longest)
    found = stage(_counted(_routed(rows, longest, hot, routes), longest, least, hot, routes), "phrases")
    words = found.filter(F.col("kind") == WORDS).select("id", "lang", "word")
    parts = [F.first(c).alias(c) for c in ("size", "words", "lefts", "rights", "inner")]
    counts = stage(
        found.filter(F.col("kind") == SUFFIXES).groupBy("id").agg(F.sum("a").alias("a"), *parts).filter(F.col("a") >= least),
        "counts",
    )
    best_first = [F.col("score").desc(), F.col("a").desc()]
    scored = _scored(counts, words.select("id", "lang"), cover)
    near = F.rank().over(Window.partitionBy("lang").orderBy(*best_first))
    leading = stage(scored.withColumn("near", near).filter(F.col("near") <= top).drop("near"), "leading")

    letters = leading.select("id", F.posexplode("words").alias("at", "word_id")).join(
        words.select(F.col("id").alias("word_id"), "word"), "word_id"
    )
    spelt = letters.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
    phrase = F.concat_ws(" ", F.transform("spelt", lambda w: w["word"]))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best_first, "phrase"))
    totals = found.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("a").alias("n"))
    return (
        leading.join(spelt.select("id", phrase.alias("phrase")), "id")
        .withColumn("rank", rank.cast("long"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
