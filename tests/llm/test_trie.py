"""The conversation trie against one built in dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, id long, part string, pos string, k string, next string, row string"
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, group=5, most=9):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in found.items()}
    rebuilt = {}
    for c, turns in own.items():
        base, h = c - (abs(c) % group) * (1 if c > 0 else -1), zlib.crc32(str(c).encode()) % most
        rebuilt[c] = turns if base == c else own.get(base, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below, own_bytes = children[node], len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = (len(members[node]) - 1) * own_bytes + sum(saved[x] for x in below)
        ends = sorted(c for c in members[node] if len(rebuilt[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def turns():
    r, out = random.Random(3), []
    texts = ["hi", "é" * 20, "", None, "a much longer text " * 20, "x" * 200_000, "no", "yes"]
    for conv in [*range(-12, 60), 1003, 2**62, 2**62 + 1]:
        if conv in (20, 35):  # heads that are not there
            continue
        for turn in range(r.choice([1, 2, 3, 3, 5, 9, 14])):
            role, text = r.choice(["user", "user", None, "bot"]), r.choice(texts[:3] + texts[6:]) if turn < 3 else r.choice(texts)
            out.append((conv, turn, role, text))
    out += [(100 + 5 * k, t, "user", f"same {t}") for k in range(120) for t in range(3)]  # one hot conversation
    out += [(900 + 5 * k, 0, "sys", "hot") for k in range(150)] + [(900 + 5 * k, 1, "user", f"own {k}") for k in range(150)]
    out += [(3000, k, "user", f"long {k}") for k in range(700)]  # a third of all rows in one conversation
    out += [(5000, 7, "user", "twice")] * 2 + [(5000, None, "user", "no number"), (5005, None, None, None)]
    out += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    return out


def frame_of(frame, rows):
    return frame([(*r, 1, "a", "b", "c", "d", "e") for r in rows], TURNS, 5)


def found(df, **options):
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **options).select(*RESULT).collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_trie(frame, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 64), ("PIECE", 5), ("LAST_ARCS", 30), ("CHUNK_IDS", 7), ("SALT_TURNS", 4)):
            monkeypatch.setattr(prefix_trie, name, value)
    rows = turns()
    assert found(frame_of(frame, rows)) == brute(rows)


def test_conversations_as_they_stand(frame):
    rows = turns()[:300]
    assert found(frame_of(frame, rows), group=1) == brute(rows, group=1)


def test_a_conversation_without_turns(frame):
    rows = [(c, 0, "user", "x") for c in range(1, 5)]  # their head is missing; most lose their only turn
    got = found(frame_of(frame, rows))
    assert got == brute(rows) and got[0][1] == 0


def test_nobody_talks(spark, frame):
    assert found(spark.createDataFrame([], TURNS)) == []
    assert found(frame_of(frame, [(None, 1, "user", "x")])) == []


@pytest.mark.parametrize("seed", range(2))
def test_ranks_of_a_shuffled_list(spark, monkeypatch, seed):
    """Blocks that don't shrink it, so that arcs must be merged by coin."""
    for name, value in (("PIECE", 1), ("LAST_ARCS", 40)):
        monkeypatch.setattr(prefix_trie, name, value)
    merged = []
    whole = prefix_trie._mated
    monkeypatch.setattr(prefix_trie, "_mated", lambda arcs, turn: merged.append(turn) or whole(arcs, turn))
    r = np.random.default_rng(seed)
    arcs = r.permutation(600).tolist()
    weights = r.integers(0, 2**40, (600, 2)).tolist()
    rows = [(a, b, 1, *w) for a, b, w in zip(arcs, [*arcs[1:], None], weights, strict=True)]
    df = spark.createDataFrame(rows, "arc long, next long, w_place long, w_leaf long, w_saved long").repartition(4)
    got = {x["arc"]: (x["o_place"], x["o_leaf"], x["o_saved"]) for x in prefix_trie.ranks(df).collect()}
    before = (0, 0, 0)
    for a, _, *w in rows:
        assert got.pop(a) == before
        before = tuple(x + y for x, y in zip(before, w, strict=True))
    assert not got and merged


def test_powers():
    at = np.array([0, 1, 65535, 65536, 2**33 + 5, 2**40])
    for power, base in zip(prefix_trie._UP, prefix_trie.BASES, strict=True):
        assert power(at).tolist() == [pow(base, int(n), 2**64) for n in at]
    assert len(prefix_trie._UP[0](np.zeros(0, np.int64))) == 0


def test_the_tour_shuffles_no_text(frame):
    df = frame_of(frame, [(1, 0, "user", "x")])
    plan = prefix_trie.conversation_trie(df.select("*", F.lit(1).alias("more")))._jdf.queryExecution().toString()
    assert "text" not in plan
