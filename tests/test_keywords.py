"""Keywords by one automaton against ``in``, one keyword at a time."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftline.functions.keywords import finder, weight_in, words_in

LETTERS = "abㄱ각 é"


@settings(max_examples=300, deadline=None)
@given(st.text(LETTERS, max_size=40), st.lists(st.text(LETTERS, max_size=4), max_size=12))
def test_finder_is_contains(text, words):
    """Words inside words, overlaps, repeated and empty words."""
    assert finder(words)(text) == [i for i, w in enumerate(words) if w in text]


def test_no_words_and_no_text():
    assert finder([])("abc") == [] and finder(["a"])(None) == [] and finder([""])("") == [0]


@pytest.mark.parametrize("n", [3, 5000])
def test_columns_equal_contains(spark, n):
    r = random.Random(n)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 7))) for _ in range(n)]
    weighted = [(w, r.choice([3.0, 2.0, -5.0])) for w in words]
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randrange(400))) for _ in range(60)] + [None, "", "a" * 100_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = frame.select("id", words_in(F.col("text"), words).alias("found"), weight_in(F.col("text"), weighted).alias("score")).collect()
    for row in got:
        text = texts[row.id]
        found = [i for i, w in enumerate(words) if text is not None and w in text]
        assert list(row.found) == found and row.score == sum(weighted[i][1] for i in found)
    assert len(got) == len(texts)


def test_cost_does_not_grow_with_the_number_of_words():
    """The same texts take about as long with 5,000 keywords, of which they hold the same few, as with 50."""
    r = random.Random(1)
    few = [f"word{i}" for i in range(50)]
    many = few + ["".join(r.choice("qxz0123456789") for _ in range(8)) for _ in range(4950)]
    text = " ".join(r.choice(["word7", "other", "text", "plain"]) for _ in range(20_000))

    def seconds(find):
        best = float("inf")
        for _ in range(5):
            start = time.process_time()
            assert find(text)
            best = min(best, time.process_time() - start)
        return best

    assert seconds(finder(many)) < 5 * seconds(finder(few))


def test_plan_is_one_scan_of_texts(spark):
    """Neither the plan nor its expressions grow with the number of keywords."""
    frame = spark.range(3).select(F.col("id").cast("string").alias("text"))
    plans = [
        weight_plan(frame, [(f"k{i}", 1.0) for i in range(n)])
        for n in (2, 5000)
    ]
    assert len(plans[0]) == len(plans[1]) and "ArrowEvalPython" in plans[0]


def weight_plan(frame, weighted):
    import re

    return re.sub(r"#\d+L?", "", frame.select(weight_in(F.col("text"), weighted))._jdf.queryExecution().executedPlan().toString())
