"""Jump consistent hashing against the published loop."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siftline.llm import sharding

DOCS = "doc_id long, text string, shard string, slot long, size string, jump int, part string, place string, row string"


def jump(key, shards):
    at, to = -1, 0
    while to < shards:
        at, key = to, (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def key_of(value):
    return int(hashlib.md5((sharding.NO_KEY if value is None else str(value)).encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("shards", [1, 2, 8, 47, 48, 49, 5000])
def test_jump(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "STEPS", 3 if shards == 5000 else 48)
    rows = spark.range(-300, 1500).select("id", sharding.jump("id", shards)["at"].alias("at")).collect()
    assert all(r["at"] == jump(key_of(r["id"]), shards) for r in rows)
    if shards <= 48:
        assert set(Counter(r["at"] for r in rows)) == set(range(shards))


def check(rows, got, shards):
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "key" and r["shard"] == jump(key_of(r["doc_id"]), shards)
        assert r["grown_shard"] == jump(key_of(r["doc_id"]), shards + 1)
        assert r["grown_shard"] in (r["shard"], shards)
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    for found in slots.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found)))
        assert [d for _, d in found] == sorted((d for _, d in found), key=lambda d: (d is not None, d or 0))
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    want = Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


@pytest.mark.parametrize("shards", [1, 8])
def test_in_shards(frame, shards):
    rows = [(k, f"text {k} é") for k in range(300)] + [(None, None), (None, ""), (None, "x"), (-5, "y" * 300_000), (2**63 - 1, "")]
    rows += [(7, "again")] * 5 + [(77, f"hot {k % 3}") for k in range(400)]  # repeated rows, and a hot key
    docs = frame([(*r, "a", 1, "b", 2, "c", "d", "e") for r in rows], DOCS, 5)
    found = sharding.in_shards(docs, shards)
    check(rows, found.collect(), shards)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"]
    again = sharding.in_shards(docs.repartition(2), shards)
    assert sorted(map(repr, found.select(columns).collect())) == sorted(map(repr, again.select(columns).collect()))


def test_text_keys(frame):
    rows = frame([("a", "x"), ("b", None), (None, "z")], "url string, text string")
    for r in sharding.in_shards(rows, 8, key="url").collect():
        assert r["shard"] == jump(key_of(r["doc_id"]), 8)


def test_nothing_to_shard(spark):
    assert sharding.in_shards(spark.createDataFrame([], DOCS), 8).count() == 0
    with pytest.raises(ValueError):
        sharding.jump(F.lit(1), 0)


def test_no_python_in_the_plan(frame):
    plan = sharding.in_shards(frame([(1, "x")], "doc_id long, text string"), 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
