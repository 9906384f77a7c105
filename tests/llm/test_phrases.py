"""Phrase collocations against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftline.llm import phrases

# Extra columns named like columns that the operator adds.
DOCS = "doc_id long, text string, lang string, id long, word string, n string, rank string, route int, a string"
RESULT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, longest, least, cover, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in frequent.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed, n=120):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "été", "x" * 40, "a-b", "ſ", "\x1c", "des"] + [f"w{i}" for i in range(12)]
    out = []
    for k in range(n):
        words = r.choices(vocabulary, [9] + [2] * (len(vocabulary) - 1), k=r.randrange(60))
        blanks = r.choices([" ", "  ", "\t", ". ", "\n", " ,", "!", " "], [12, 2, 1, 1, 1, 1, 1, 1], k=len(words))
        out.append(("".join(w + b for w, b in zip(words, blanks, strict=True)), r.choice(["en", "en", "de", None, "und", ""])))
    out += [(None, "en"), ("", "de"), (" . ,\t\n", "en"), ("lonely", "zz"), ("hot pair " * 400, "en"), ("to be or " * 3000, "en")]
    return out + [out[3]] * 3  # repeated rows


def frame_of(frame, rows, partitions=3):
    return frame([(k, t, lang, 1, "x", "y", "z", 5, "a") for k, (t, lang) in enumerate(rows)], DOCS, partitions)


@pytest.mark.parametrize("longest, least, cover, top", [(3, 3, 50, 2000), (2, 2, 50, 10), (4, 3, 80, 40)])
def test_collocations(frame, monkeypatch, longest, least, cover, top):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(phrases, "SMALL", 16)  # so that parts are cut by pivots
    rows = texts(longest)
    got = phrases.collocations(frame_of(frame, rows), longest, least, cover, top).select(*RESULT).collect()
    assert sorted(map(tuple, got)) == brute(rows, longest, least, cover, top)


def test_hot_words_are_dealt_out(frame, spark, monkeypatch):
    rows = texts(9) + [(f"hot w{k} hot pair w{k}", "en") for k in range(400)]
    docs = frame_of(frame, rows)
    monkeypatch.setattr(phrases, "SAMPLE_ROWS", 200)
    keyed = docs.selectExpr("lang", "xxhash64(coalesce(lang, 'und')) AS lang_key", "text").fillna("und", ["lang"])
    hot, routes = phrases._hot(keyed, 3)
    assert len(hot) and routes == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = phrases.collocations(docs, least=4).select(*RESULT).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 4, 50, 2000)


def test_products_beyond_64_bits(spark):
    """Counts of 13 digits: scores by whole numbers of any size."""
    a, left, right = 3_000_000_000_001, 3_999_999_999_999, 3_700_000_000_003
    ids = "array(CAST(1 AS BIGINT)) AS words, array(CAST({0} AS BIGINT)) AS lefts, array(CAST({1} AS BIGINT)) AS rights, CAST(array() AS array<bigint>) AS inner"
    counts = spark.sql(
        f"SELECT 9L AS id, 2 AS size, {a}L AS a, {ids.format(1, 2)}"
        f" UNION ALL SELECT 1L, 1, {left}L, {ids.format(0, 0)} UNION ALL SELECT 2L, 1, {right}L, {ids.format(0, 0)}"
    )
    words = spark.sql("SELECT 1L AS id, 'en' AS lang UNION ALL SELECT 2L, 'en'")
    row = phrases._scored(counts, words, 50).first()
    assert (row["l"], row["r"], row["score"]) == (left, right, 10**6 * a * a // (left * right))


def test_no_phrases(spark, frame):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).columns == list(RESULT)
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(frame_of(frame, [(None, None), ("", "en"), ("one two", "en")])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_multikey_counts_prefixes(seed):
    r = np.random.default_rng(seed)
    columns = [r.integers(1, 5, 500, dtype=np.uint64), r.integers(0, 30, 500, dtype=np.uint64), r.integers(0, 30, 500, dtype=np.uint64)]
    columns[2][columns[1] == 0] = 0
    weights, least = r.integers(1, 4, 500), 9
    order = phrases.multikey(columns, weights, least, small=3)
    assert sorted(order) == list(range(500))
    for depth, (at, a) in enumerate(phrases.prefixes(columns, weights, order)):
        want = Counter()
        for row in range(500):
            want[tuple(int(c[row]) for c in columns[: depth + 1])] += int(weights[row])
        want = {k: n for k, n in want.items() if n >= least and k[-1]}
        got = {tuple(int(c[i]) for c in columns[: depth + 1]): int(n) for i, n in zip(at, a, strict=True) if n >= least}
        assert got == want
