"""Many keywords found in one pass over a text.

An Aho-Corasick automaton goes through each text once, whatever the number of
keywords; texts come to it in Arrow batches, lower-cased by the JVM.  What a
keyword means is the same as for ``contains``: any place in the text, words or
not.  The empty keyword is in every text, and nothing is in a null text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finder(words: Sequence[str]) -> Callable[[str | None], list[int]]:
    """A function from a text to the ascending positions of the words it holds; a word may be listed twice."""
    places: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(word, []).append(i)
    everywhere = places.pop("", [])
    automaton = ahocorasick.Automaton()
    for word, at in places.items():
        automaton.add_word(word, tuple(at))
    if places:
        automaton.make_automaton()

    def find(text: str | None) -> list[int]:
        if text is None:
            return []
        hits = {at for _, at in automaton.iter(text)} if places else set()
        return sorted([i for at in hits for i in at] + everywhere)

    return find


def _per_text(result: str, type_: pa.DataType, of: Callable[[list[int]], object], words: Sequence[str]):
    words = tuple(words)

    @F.arrow_udf(result)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = finder(words)
        for texts in batches:
            # Text by text, so that a batch of long ones is never held a second time.
            yield pa.array((of(find(text.as_py())) for text in texts), type_)

    return scan


def words_in(text: Column, words: Sequence[str]) -> Column:
    """Positions in ``words`` of those that ``text`` contains, ascending."""
    return _per_text("array<int>", pa.list_(pa.int32()), lambda found: found, words)(text)


def weight_in(text: Column, weighted: Sequence[tuple[str, float]]) -> Column:
    """Sum of the weights of the words that ``text`` contains, added up in their order."""
    weights = [w for _, w in weighted]

    def total(found: list[int]) -> float:
        return float(sum(weights[i] for i in found))

    return _per_text("double", pa.float64(), total, [k for k, _ in weighted])(text)
