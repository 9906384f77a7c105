"""Secret scans: keyword automaton, anchored expressions, checksums.

An Aho-Corasick automaton finds the places of all keywords in one pass over a
text; only there an expression is tried, anchored to the keyword.  Kinds with a
checksum in the token count only where it is right.  Runs of hexadecimal digits
have no keyword: a byte-level run-length test of the whole batch says which
texts hold a run that is long enough, and only those are searched.

One map over the texts, no shuffle; memory is bounded by an Arrow batch.

Defined results: null and empty texts have no spans.  Positions are code points,
the end is exclusive.  Matches of a kind don't overlap, the leftmost wins, and a
match that fails its length test still uses up its characters.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftline.llm.words import blocks

ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

# The expressions of the kinds, and the keywords they begin with.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

# Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "checked")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

Span = tuple[int, int, int]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        found.add_word(word, (0, len(word)))
    found.add_word("akia", (1, 4))
    for word in CHECKED_WORDS:
        found.add_word(word, (3, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """In lower case, character by character."""
    low = text.lower()
    if len(low) != len(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return low


def checksum_holds(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value = zlib.crc32(body.encode())
    digits = ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == check


def keyword_spans(text: str, keywords: ahocorasick.Automaton) -> list[Span]:
    """(start, kind, end) of all kinds that begin with a keyword."""
    hits = sorted((end + 1 - length, kind) for end, (kind, length) in keywords.iter(lowered(text)))
    free, spans = [0] * len(KINDS), []
    for start, kind in hits:
        if start < free[kind]:
            continue
        match = (ASSIGN, ACCESS, None, CHECKED)[kind].match(text, start)
        if not match:
            continue
        free[kind] = match.end()
        if kind == 0 and len(match[2]) < ASSIGN_LENGTH:
            continue
        if kind == 1 and len(match[0]) < ACCESS_LENGTH:
            continue
        if kind == 3 and not checksum_holds(match[1], match[2]):
            continue
        spans.append((start, kind, match.end()))
    return spans


def hex_spans(text: str) -> list[Span]:
    return [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]


_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


def rows_with_hex_run(texts: pa.Array, length: int = HEX_LENGTH) -> np.ndarray:
    """Whether a row holds ``length`` hexadecimal digits in a row."""
    out = np.zeros(len(texts), bool)
    for block in blocks(texts):
        # Any such run covers two neighbouring multiples of half its length.
        step = length // 2
        probes = _HEX_BYTE[block.data[::step]]
        near = np.flatnonzero(probes[:-1] & probes[1:]) * step
        out[block.first + np.searchsorted(block.bounds, near, "right") - 1] = True
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keywords = automaton()
    for batch in batches:
        texts = batch.column("text")
        has_hex = rows_with_hex_run(texts)
        counts, digests, everything = [], [], []
        for text, hexed in zip(texts, has_hex, strict=True):
            text = text.as_py() or ""
            spans = keyword_spans(text, keywords)
            if hexed:
                spans += hex_spans(text)
            spans.sort()
            base = [s for s in spans if s[1] < 3]
            counts.append([sum(s[1] == kind for s in base) for kind in range(3)])
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            everything.append(listed(spans))
        n = np.array(counts, np.int64).reshape(-1, 3)
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(n[:, 2]), pa.array(digests, pa.string()), pa.array(everything, pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the three base kinds, their digest, and all spans as text."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(scan, SCHEMA)
