"""Operators against brute force on small random tables with hot keys."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siftline.functions import rules as R
from siftline.operators import canonical, companies, dedup, ranking, scoring, skew, state
from siftline.schemas import SEEN, SEEN_COLUMNS, struct_of
from siftline.session import stage
from tests.conftest import AS_OF


def test_keep_first_ignores_partitioning(frame):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaab")) for i in range(200)]
    rng.shuffle(rows)
    want = {k: min(i for i, key in rows if key == k) for k in "ab"}
    for parts in (1, 7):
        got = dedup.keep_first(frame(rows, "seq long, dedup_key string", parts)).collect()
        assert {r.dedup_key: r.seq for r in got} == want


def test_new_rows_is_idempotent(frame):
    batch = frame([(0, "a"), (1, "b"), (2, "a"), (3, "c")], "seq long, dedup_key string")
    seen = frame([("b",)], "dedup_key string")
    fresh = dedup.new_rows(batch, seen)
    assert sorted((r.seq, r.dedup_key) for r in fresh.collect()) == [(0, "a"), (3, "c")]
    again = seen.unionByName(fresh.select("dedup_key"))
    assert dedup.new_rows(batch, again).count() == 0


@pytest.mark.parametrize("hot_keys", [1, 3, 100])
def test_lookup_keeps_every_row_once(frame, hot_keys):
    rng = random.Random(2)
    facts = [(i, rng.choice(["", "", "", "x", "y", "z", "w", None])) for i in range(300)]
    sizes = Counter(k for _, k in facts)
    dim = [(k, n, f"value of {k!r}", None if k == "y" else n) for k, n in sizes.items() if k not in ("w", None)]
    got = skew.lookup(
        frame(facts, "seq long, k string"),
        frame(dim, "k string, n long, v string, maybe long"),
        "k", weight="n", spread_by="seq", hot_keys=hot_keys,
    ).collect()
    values = {k: (v, m) for k, _, v, m in dim}
    assert sorted((r.seq, r.k or "", r.v, r.maybe) for r in got if r.k is not None) == sorted(
        (i, k, *values.get(k, (None, None))) for i, k in facts if k is not None
    )
    assert len(got) == len(facts)


def test_preceding_sum(frame):
    rng = random.Random(3)
    # Numbers that fall into different blocks and superblocks, one of them negative.
    numbers = rng.sample([b + j for b in (-(1 << 33), 0, 1 << 16, 1 << 20, 1 << 32, 5 << 40) for j in range(40)], 200)
    rows = [(rng.choice("gh"), rng.choice([1.0, 2.5]), n, rng.randrange(5)) for n in numbers]
    df = frame(rows, "g string, lead double, o long, v long")
    got = skew.preceding_sum(df, F.col("v"), "o", lead=[("lead", True)], group=["g"]).collect()
    assert len(got) == len(rows)
    for r in got:
        want = sum(v for g, lead, o, v in rows if g == r.g and (-lead, o) < (-r.lead, r.o))
        assert r.preceding == want


def random_postings(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "k1", "k2", ""])
        rows.append((i * 3, rng.choice(["s1", "s2", "s3"]), key, rng.randrange(4)))
    return rows


def merged_by_hand(rows):
    groups, result = defaultdict(list), {}
    for seq, source, key, full in rows:
        if key:
            groups[key].append((-full, seq, source))
        else:
            result[seq] = ""
    for members in groups.values():
        best, *rest = sorted(members)
        others = list(dict.fromkeys(s for _, _, s in rest if s != best[2]))
        result[best[1]] = "+".join([f"{best[2]}:{best[1]}", *others]) if others else ""
    return result, groups


@pytest.fixture(scope="module")
def postings(frame):
    rows = random_postings(150, 4)
    df = frame(rows, "seq long, source string, canonical_key string, completeness int")
    return rows, df.withColumn("dedup_key", F.concat_ws(":", "source", "seq"))


def test_merge_against_brute_force(postings):
    rows, df = postings
    want, _ = merged_by_hand(rows)
    got = canonical.merge_cross_platform(df).collect()
    assert {r.seq: r.canonical_group_id for r in got} == want
    assert len(got) == len(want)
    order = [r.seq for r in sorted(got, key=lambda r: r.merge_order)]
    first = {k: min(s for s, _, key, _ in rows if key == k) for k in ("hot", "k1", "k2")}
    keys = {r.seq: r.canonical_key for r in got}
    assert order == sorted(order, key=lambda s: (keys[s] != "", first.get(keys[s], s)))


def test_members_of_every_group_in_order(postings):
    rows, df = postings
    _, groups = merged_by_hand(rows)
    members = defaultdict(list)
    for r in sorted(canonical.group_members(df).collect(), key=lambda r: r.position):
        members[r.canonical_key].append((r.position, r.dedup_key))
    for key, group in groups.items():
        assert members[key] == [(i + 1, f"{s}:{q}") for i, (_, q, s) in enumerate(sorted(group))]


def test_merge_of_one_key_on_nearly_all_rows(spark):
    """A cell has each source once, however many copies there are."""
    df = spark.range(20_000).selectExpr(
        "id AS seq", "concat('s', id % 3) AS source", "IF(id < 19990, 'hot', concat('k', id)) AS canonical_key",
        "CAST(id % 4 AS INT) AS completeness", "CAST(id AS STRING) AS dedup_key",
    )
    got = {r.canonical_key: r.canonical_group_id for r in canonical.merge_cross_platform(df).collect()}
    assert got["hot"] == "3+s1+s2" and len(got) == 11


def test_completeness_and_keys(frame):
    df = frame(
        [("Foo Inc.", "Dev", "text", "", "1", "", "x"), ("", "Dev", "", "d", "", "e", "")],
        "company string, title string, jd_text string, posted_date string, salary_info string, "
        "experience_required string, location string",
    )
    got = {(r.canonical_key, r.completeness) for r in canonical.with_merge_columns(df).collect()}
    assert got == {("foo|dev", 14), ("", 7)}


COMPANIES = "seq long, company string, jd_text string"


def test_first_posting_decides_for_the_company(frame, spark):
    df = companies.with_company_columns(
        frame(
            [(0, "Acme Inc", "plain"), (1, "ACME", "a startup"), (2, "", "startup"), (3, "", "plain"),
             (4, "Known", "global"), (5, "Glob", "global"), (6, "Third", "startup"), (7, "Fourth", "startup")],
            COMPANIES,
        )
    )
    cache = frame([("known", "일반", "old", "cache")], "normalized_name string, company_type string, confidence string, source string")
    snippets = frame(
        [("", "none"), ("", "Venture fund"), ("glob", ""), ("third", "start"), ("third", "up"), ("fourth", "startup")],
        "normalized_name string, snippet string",
    )
    verdicts = companies.company_verdicts(df, cache, snippets, max_searches=3)
    got = {
        r.seq: (r.company_type, r.company_type_confidence, r.company_type_source)
        for r in companies.classify_postings(df, verdicts).collect()
    }
    nothing = (R.UNCONFIRMED, "unverified", "default")
    refuted = (R.UNCONFIRMED, "unverified", "pattern")
    assert got == {
        0: nothing, 1: nothing,  # the plain first posting counts, not the second
        2: (R.STARTUP, "verified", "tavily"), 3: (R.STARTUP, "verified", "tavily"),
        4: ("일반", "old", "cache"),
        5: refuted, 6: refuted,  # empty evidence, and evidence without the words
        7: (R.STARTUP, "pattern_match", "pattern"),  # beyond the quota
    }
    entries = companies.cache_entries(verdicts, AS_OF).collect()
    assert {r.normalized_name for r in entries} == {"acme", "", "glob", "third", "fourth"}


def scored_by_hand(rows, responses, budget_units):
    spent, result = 0, {}
    stopped = False
    for seq, ks, passed in sorted(rows, key=lambda r: (-r[1], r[0])):
        if not passed:
            result[seq] = 0.0
            continue
        fallback = min(100.0, ks * 5)
        score, cost = responses.get(seq, (None, 0))
        if stopped or score is None:
            result[seq] = fallback
            continue
        result[seq] = float(score) if score else fallback
        spent += cost
        stopped = spent > budget_units
    return result


@pytest.mark.parametrize("budget", [0.0, 0.0005, 0.003, 1.0])
def test_budget_against_brute_force(frame, budget):
    rng = random.Random(5)
    rows = [(i * (1 << 13), rng.choice([0.0, 2.0, 3.0, 6.0])) for i in range(120)]
    rows = [(s, ks, int(ks >= 2)) for s, ks in rows]
    responses = {s: (rng.choice([0, 10, 55, None]), rng.randrange(1, 80) * 8) for s, _, _ in rows if rng.random() < 0.9}
    postings = frame(
        [(s, f"k:{s}", ks, p) for s, ks, p in rows],
        "seq long, dedup_key string, keyword_score double, prefilter_passed int",
    )
    texts = frame(
        [(f"k:{s}", "broken" if v is None else f'{{"score": {v}}}', cost // 8, 0) for s, (v, cost) in responses.items()],
        scoring.RESPONSE_SCHEMA,
    )
    want = scored_by_hand(rows, responses, round(budget * 10_000_000))
    got = scoring.score_postings(postings, texts, budget)
    assert {r.seq: r.ai_match_score for r in got.collect()} == want
    attached = stage(scoring.attach_responses(postings, texts), "attached")
    text = scoring.spend_budget(attached, budget)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" not in text


def test_ranking_and_top_k(frame):
    df = frame(
        [(i, float(s), 3.0, t, c, d) for i, (s, t, c, d) in enumerate(
            [(50, R.FOREIGN, "verified", 1), (60, R.FOREIGN, "unverified", None), (39, R.STARTUP, "verified", 0),
             (60, "", "unverified", 31), (58, R.STARTUP, "pattern_match", 40)])],
        "seq long, ai_match_score double, keyword_score double, company_type string, "
        "company_type_confidence string, freshness_days int",
    )
    ranked = ranking.with_ranking_score(df)
    assert {r.seq: r.ranking_score for r in ranked.collect()} == {0: 66, 1: 60, 2: 0, 3: 60, 4: 60}
    top = ranking.top_recommendations(ranked, 3).orderBy("rank").collect()
    assert [(r.rank, r.seq) for r in top] == [(1, 0), (2, 1), (3, 3)]


def test_enrichment_budget_runs_in_rank_order(frame):
    shortlist = frame(
        [(1, i + 1, f"k{i}", s, "own") for i, s in enumerate([90.0, 80.0, 60.0, 75.0, 71.0])],
        "run_id long, rank int, dedup_key string, ai_match_score double, positioning_advice string",
    )
    texts = frame(
        [("k0", '{"company_intro": "zero", "positioning_advice": ""}', 100, 0),
         ("k1", '{"company_intro": "one", "positioning_advice": "new', 100, 0),
         ("k2", '{"company_intro": "too weak"}', 100, 0),
         ("k3", "unusable", 100, 0),
         ("k4", '{"company_intro": "late"}', 100, 0)],
        scoring.RESPONSE_SCHEMA,
    )
    spent = frame([(1, 9_999_100)], "run_id long, spent_units long")
    got = scoring.enrich_shortlist(shortlist, texts, spent, budget_usd=1.0).orderBy("rank").collect()
    assert [r.company_intro for r in got] == ["zero", "one", "", "", ""]
    assert [r.positioning_advice for r in got] == ["own", "new", "own", "own", "own"]
    assert [r.enrich_units for r in got] == [800, 800, 0, 0, 0]
    plain = scoring.enrich_shortlist(shortlist, None, spent).collect()
    assert {r.company_intro for r in plain} == {""} and len(plain) == 5


def test_updates_leave_identity_alone_and_ignore_unknown_keys(spark, frame):
    seen = state.first_sight(
        frame([(f"s:{i}", "s", str(i), "old title", "c", "u") for i in range(3)],
              "dedup_key string, source string, source_id string, title string, company string, url string"),
        "2024-01-01 00:00:00",
    )
    assert seen.schema.names == list(SEEN_COLUMNS)
    assert [f.dataType for f in seen.schema] == [f.dataType for f in struct_of(SEEN)]
    updates = frame(
        [("s:1", "new title", 70.0, "x" * 6000, "", "~06.30"), ("s:9", "t", 1.0, "", "", "")],
        "dedup_key string, title string, ai_match_score double, jd_text string, effective_date string, posted_date string",
    ).withColumn("scraped_at", F.lit(AS_OF).cast("timestamp"))
    got = {r.dedup_key: r for r in state.apply_updates(seen, updates, AS_OF).collect()}
    cut = state.apply_updates(seen, updates, AS_OF, kept_text=5000).where("dedup_key = 's:1'").first()
    assert len(cut.jd_text) == 5000
    assert set(got) == {"s:0", "s:1", "s:2"}
    hit, miss = got["s:1"], got["s:0"]
    assert (hit.title, hit.match_score, len(hit.jd_text), hit.effective_date) == ("old title", 70.0, 6000, "~06.30")
    assert (hit.first_seen.day, hit.last_seen.day) == (1, 31)
    assert (miss.match_score, miss.company_type_confidence, miss.last_seen.day) == (0.0, "unverified", 1)


def test_replace_rows_and_run_numbers(frame):
    table = frame([("a", 1), ("b", 2)], "k string, v int")
    got = state.replace_rows(table, frame([("b", 3), ("c", 4)], "k string, v int"), "k")
    assert {tuple(r) for r in got.collect()} == {("a", 1), ("b", 3), ("c", 4)}
    rows = [("a", 2, 10), ("a", 3, 20), ("c", 5, 1), ("c", 4, 1), ("b", 9, 0)]
    got = state.replace_rows(
        frame([("a", 1, 99), ("b", 2, 99), ("d", 7, 1)], "k string, v int, at int"),
        frame(rows, "k string, v int, at int"), "k", newest="at",
    )
    assert {(r.k, r.v) for r in got.collect()} == {("a", 3), ("b", 9), ("c", 5), ("d", 7)}
    assert state.next_run_id(frame([(4,), (9,)], "run_id long")).collect()[0][0] == 10
    assert state.next_run_id(frame([(4,)], "run_id long").where("false")).collect()[0][0] == 1
    row = state.run_row(frame([(5, 0, 3)], "run_id long, jobs_new long, jobs_recommended long", 1)).collect()[0]
    assert (row.recommendation_rate, row.errors, row.jobs_scraped) == (0.0, "", 0)
