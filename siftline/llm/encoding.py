"""Token ids of whole texts by a given tokenizer file, for Arrow batches in tasks.

Both vocabularies in use split a text at white space before they merge anything,
so the ids of a text are those of its units, one after the other: a word with
the blanks before it, or a word alone where the tokenizer drops blanks.  They
also split a word between a letter and the punctuation at its end.  Prose
repeats its words, so a worker remembers the ids of units by the units' hashes:
all units of a block are cut, hashed, looked up and put together by numpy, and
only new ones go to the tokenizer.  What is remembered is bounded by the number
of units and of ids; a unit of more than ``LONG`` bytes is never remembered.

Blanks other than space, tab, LF, VT, FF and CR are left inside units, unless
the tokenizer keeps blanks: then a text that holds any of them is encoded as one
piece.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from siftline.llm.words import BLANK, BLOCK_BYTES, Block, Words, blocks, split, word_hashes

MOST_UNITS = 1 << 20  # units a worker remembers; it forgets all and starts again beyond that
MOST_IDS = 8 << 20
LONG = 64
BLOCK_ROWS = 512  # rows whose ids are handed on at once

OTHER_BLANKS = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")


def marked(values: bytes | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


# The first bytes of other blanks in UTF-8.
SUSPECT = marked([0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
LETTER = marked([*range(65, 91), *range(97, 123)])
DIGIT = marked(b"0123456789")
# Between a letter or digit and these, tokenizers always split; an apostrophe is another matter.
MARKS = marked(b".,!?;:*%$&#")


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def without_tails(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of the words without the marks that follow a Latin letter or a digit."""
    at = np.flatnonzero(MARKS[data[ends - 1]])
    if not len(at):
        return ends
    last = np.where(MARKS[data], 0, np.arange(1, len(data) + 1))
    cut = np.maximum.accumulate(last)[ends[at] - 1]
    at, cut = at[cut > starts[at]], cut[cut > starts[at]]
    byte, lead = data[cut - 1], np.where(cut - 1 > starts[at], data[cut - 2], 0)
    # Letters of two bytes from U+00C0 to U+024F, but for the signs of multiplication and division and
    # for the dotted capital I, whose lower case ends in a combining dot.
    two = (byte >= 0x80) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC9) & (byte > 0x8F))
    two &= ~((lead == 0xC3) & ((byte == 0x97) | (byte == 0xB7))) & ~((lead == 0xC4) & (byte == 0xB0))
    good = two | LETTER[byte] | DIGIT[byte]
    out = ends.copy()
    out[at[good]] = cut[good]
    return out


def not_plain(data: np.ndarray) -> np.ndarray:
    """For each byte and one more, the bytes before it that are in no letter of ASCII or Latin-1."""
    second = np.zeros(len(data) + 1, bool)
    second[1:-1] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    plain = LETTER[data] | second[:-1] | second[1:]
    return np.concatenate([[0], np.cumsum(~plain)])


class Encoder:
    """Encodes texts with one tokenizer file; one for each file and worker."""

    def __init__(self, path: str, keeps_blanks: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.keeps_blanks = keeps_blanks
        self.forget()

    def forget(self) -> None:
        # An open table: hash and number of a unit, at the first free slot from that of its hash on.
        self.slots = np.zeros(1 << (2 * MOST_UNITS - 1).bit_length(), np.uint64)
        self.numbers = np.zeros(len(self.slots), np.int32)
        self.units, self.used = 0, 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of units, -1 for unknown ones."""
        found, mask = np.full(len(hashes), -1, np.int64), np.uint64(len(self.slots) - 1)
        slot, at = hashes & mask, np.arange(len(hashes))
        while len(at):
            there = self.slots[slot]
            hit = there == hashes[at]
            found[at[hit]] = self.numbers[slot[hit]]
            on = ~hit & (there != 0)
            at, slot = at[on], (slot[on] + np.uint64(1)) & mask
        return found

    def remember(self, hashes: np.ndarray, first: int) -> None:
        """Enter units, all different and unknown, that are numbered from ``first`` on."""
        mask = np.uint64(len(self.slots) - 1)
        slot, at = hashes & mask, np.arange(len(hashes))
        while len(at):
            free = self.slots[slot] == 0
            self.slots[slot[free]] = hashes[at[free]]
            placed = free & (self.slots[slot] == hashes[at])
            self.numbers[slot[placed]] = first + at[placed]
            at, slot = at[~placed], (slot[~placed] + np.uint64(1)) & mask

    def store(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Add units with their ids; the number of the first of them."""

        def room(held: np.ndarray, needed: int) -> np.ndarray:
            if needed <= len(held):
                return held
            return np.concatenate([held, np.zeros(max(needed, 2 * len(held)) - len(held), held.dtype)])

        first, end = self.units, self.units + len(sizes)
        self.starts, self.sizes = room(self.starts, end), room(self.sizes, end)
        self.ids = room(self.ids, self.used + len(ids))
        self.starts[first:end] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:end] = sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.units, self.used = end, self.used + len(ids)
        return first

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> int:
        """Store the given units; the number of the first of them.

        A word of plain letters is one piece to both tokenizers, so the merges can begin with it at once.
        """
        text, bad = data.tobytes(), not_plain(data)
        letters = starts + (data[starts] == 32) if self.keeps_blanks else starts
        plain = (bad[ends] == bad[letters]) & (ends > letters)
        raw = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        found: list[list[int]] = [[]] * len(raw)
        at = np.flatnonzero(plain).tolist()
        if at:
            joined = b"\0".join([raw[i] for i in at])
            if not self.keeps_blanks:
                joined = joined.decode().lower().encode()
            pieces = joined.decode("latin-1").translate(self.letters).split(self.letters[0])
            merge = self.model.tokenize
            for i, piece in zip(at, pieces, strict=True):
                found[i] = [token.id for token in merge(piece)]
        at = np.flatnonzero(~plain).tolist()
        for i, encoding in zip(at, self.tokenizer.encode_batch_fast([raw[i].decode() for i in at], add_special_tokens=False), strict=True):
            found[i] = encoding.ids
        sizes = np.array([len(x) for x in found], np.int64)
        return self.store(np.array([i for ids in found for i in ids], np.uint32), sizes)

    def whole_rows(self, block: Block) -> np.ndarray:
        """Rows that are one unit, because they hold other blanks."""
        if not self.keeps_blanks or not SUSPECT[block.data].any():
            return np.zeros(0, np.int64)
        text = block.data.tobytes()
        return np.array(
            [k for k, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:], strict=True)) if OTHER_BLANKS.search(text[a:b].decode())],
            np.int64,
        )

    def cut(self, block: Block, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all units of a block, in order."""
        data, bounds, words = block.data, block.bounds, split(block)
        starts, ends = words.starts, words.ends
        cores = without_tails(data, starts, ends) if len(starts) else ends
        if self.keeps_blanks:
            after = np.concatenate([[0], ends])  # where the word before ends, or else the row begins
            begin = np.repeat(bounds[:-1], np.diff(words.bounds))
            starts = np.maximum(after[:-1], begin)
        tails = cores < ends
        place = np.arange(len(starts)) + np.cumsum(tails) - tails
        left, right = (np.empty(len(starts) + int(tails.sum()), np.int64) for _ in range(2))
        left[place], right[place] = starts, cores
        left[place[tails] + 1], right[place[tails] + 1] = cores[tails], ends[tails]
        if not self.keeps_blanks:
            return left, right
        # Blanks at the end of a row are a unit, and so is a whole row.
        last = np.maximum(bounds[:-1], np.concatenate([[0], ends])[words.bounds[1:]])
        more = last < bounds[1:]
        more[whole] = False
        extra = [(last[more], bounds[1:][more])]
        if len(whole):
            own = np.isin(np.searchsorted(bounds, left, "right") - 1, whole)
            left, right = left[~own], right[~own]
            filled = whole[bounds[whole] < bounds[whole + 1]]
            extra.append((bounds[filled], bounds[filled + 1]))
        if any(len(a) for a, _ in extra):
            left, right = (np.concatenate(x) for x in zip((left, right), *extra, strict=True))
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
        return left, right

    def block_ids(self, block: Block, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and for each row and one more where they begin."""
        starts, ends = self.cut(block, whole)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(block.rows + 1, np.int64)
        if self.units + len(starts) > MOST_UNITS or self.used > MOST_IDS:
            self.forget()
        hashes = np.maximum(word_hashes(block.data, Words(starts, ends, block.bounds)), np.uint64(1))
        numbers = self.find(hashes)
        long = ends - starts > LONG
        numbers[long] = -1
        short = np.flatnonzero((numbers < 0) & ~long)
        new, first, inverse = np.unique(hashes[short], return_index=True, return_inverse=True)
        if len(new):
            number = self.learn(block.data, starts[short[first]], ends[short[first]])
            numbers[short] = number + inverse
            if self.units <= MOST_UNITS:
                self.remember(new, number)
        if long.any():
            numbers[long] = self.learn(block.data, starts[long], ends[long]) + np.arange(long.sum())
        sizes = self.sizes[numbers]
        at = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[numbers] - at[:-1], sizes) + np.arange(at[-1])]
        return ids, at[np.searchsorted(starts, block.bounds)]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, as bytes."""
        out = []
        for block in blocks(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts):
            whole = self.whole_rows(block)
            if block.rows == 1 and len(block.data) > 2 * BLOCK_BYTES and not len(whole):
                none = np.zeros(0, np.int64)
                out.append(b"".join(self.block_ids(part, none)[0].astype("<u4").tobytes() for part in sections(block)))
                continue
            ids, bounds = self.block_ids(block, whole)
            data, at = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
            out += [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out


def sections(block: Block) -> Iterator[Block]:
    """A long row in parts of about ``BLOCK_BYTES`` that end where a word does."""
    data, start = block.data, 0
    while start < len(data):
        end = start + BLOCK_BYTES
        while end < len(data) and not (BLANK[data[end]] and not BLANK[data[end - 1]]):
            window = BLANK[data[end - 1 : end + BLOCK_BYTES]]
            ends = np.flatnonzero(window[1:] & ~window[:-1])
            end = end + int(ends[0]) if len(ends) else end + len(window) - 1
        end = min(end, len(data))
        yield Block(block.first, data[start:end], np.array([0, end - start]))
        start = end


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoded(batch: pa.RecordBatch, path: str, keeps_blanks: bool, end_id: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, ids of each row and ``end_id``) for slices of a batch; null texts are empty."""
    key = (path, keeps_blanks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_blanks)
    encoder = _ENCODERS[key]
    end = np.array([end_id], "<u4").tobytes()
    for first in range(0, batch.num_rows, BLOCK_ROWS):
        yield first, [ids + end for ids in encoder.encode(batch.column("text").slice(first, BLOCK_ROWS))]
