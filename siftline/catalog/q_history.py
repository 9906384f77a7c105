"""History: new keys, touches, updates, run log, schema growth, streams of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog import twins  # noqa: F401  (adds its common tables)
from siftline.catalog.fixtures import AS_OF, CLOCK, SOURCES
from siftline.catalog.registry import query, stamp, stamp_sql
from siftline.operators import dedup as O
from siftline.operators import state as H
from siftline.operators.history import KeyedHistory
from siftline.plans.marts import spend_on
from siftline.schemas import SEEN
from siftline.session import stage, stage_path
from siftline.sources.common import source_counts, zero_result_errors


def kept_history(t, *columns):
    """The given history, or the key and some columns of it, as a log-structured table."""
    rows = t.history.select("dedup_key", *columns) if columns else t.history
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    store = KeyedHistory(t.spark, stage_path(t.spark, "kept_history"), buckets, rows.schema)
    store.insert(rows, 0)
    return store


@query(
    "keep_first_event",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) e WHERE n = 1""",
)
def keep_first_event(t):
    keyed = t.events.withColumn("dedup_key", F.concat_ws(":", "user_id", "event_type"))
    return O.keep_first(keyed, order="event_id").select(
        "user_id", "event_type", "event_id", "value"
    )


@query(
    "new_keys",
    "SELECT dedup_key, seq FROM @postings WHERE dedup_key NOT IN (SELECT dedup_key FROM @history)",
)
def new_keys(t):
    return O.new_rows(t.postings.select("dedup_key", "seq"), t.history)


@query(
    "known_keys",
    "SELECT dedup_key, seq FROM @postings WHERE dedup_key IN (SELECT dedup_key FROM @history)",
)
def known_keys(t):
    return O.already_seen(t.postings.select("dedup_key", "seq"), t.history)


@query(
    "touched_history",
    f"""SELECT h.dedup_key, {stamp_sql('h.first_seen')}, strftime(CASE WHEN p.dedup_key IS NOT NULL
        THEN {CLOCK} ELSE h.last_seen END, '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM @history h LEFT JOIN @postings p ON h.dedup_key = p.dedup_key""",
)
def touched_history(t):
    store = kept_history(t, "first_seen", "last_seen")
    store.touch(t.postings, AS_OF, 1)
    return store.read().select("dedup_key", stamp("first_seen"), stamp("last_seen"))


@query(
    "sighting_log",
    f"""SELECT h.dedup_key, strftime(GREATEST(h.last_seen, COALESCE(s.seen_at, h.last_seen)),
        '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM @history h LEFT JOIN (SELECT {'{key}'} AS dedup_key, max(ts) AS seen_at
            FROM documents JOIN events ON doc_id = user_id GROUP BY 1) s
        ON h.dedup_key = s.dedup_key""".replace("{key}", "source || ':' || CAST(doc_id AS STRING)"),
)
def sighting_log(t):
    seen_at = t.documents.join(t.events, F.col("doc_id") == F.col("user_id")).select(
        F.concat_ws(":", "source", "doc_id").alias("dedup_key"),
        F.col("ts").cast("timestamp").alias("seen_at"),
    )
    return O.latest_sightings(t.history, seen_at).select("dedup_key", stamp("last_seen"))


_UPDATED = ("location", "salary_info", "posted_date", "ai_match_score", "match_score", "keyword_score",
            "match_reasons", "effective_date", "application_status", "title")


@query(
    "updated_history",
    f"""SELECT h.dedup_key,
        {', '.join(f"CASE WHEN p.dedup_key IS NOT NULL THEN p.{c} ELSE h.{c} END AS {c}"
                   for c in ('location', 'salary_info', 'posted_date', 'ai_match_score',
                             'keyword_score', 'match_reasons', 'effective_date'))},
        CASE WHEN p.dedup_key IS NOT NULL THEN p.ai_match_score ELSE h.match_score END AS match_score,
        h.application_status, h.title, {stamp_sql('h.first_seen')},
        CASE WHEN p.dedup_key IS NOT NULL THEN md5(p.jd_text) ELSE md5(h.jd_text)
        END AS text_md5,
        strftime(CASE WHEN p.dedup_key IS NOT NULL THEN {CLOCK} ELSE h.last_seen END,
                 '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM @history h LEFT JOIN @scored_all p ON h.dedup_key = p.dedup_key""",
)
def updated_history(t):
    from siftline.catalog.q_scores import _scored_all

    # Most postings are not in history: their texts and updates stay where they are.
    known = t.history.select("dedup_key")
    texts = t.postings.select("dedup_key", "jd_text").join(known, "dedup_key", "left_semi")
    updates = _scored_all(t).join(texts, "dedup_key").withColumn("effective_date", F.lit(""))
    store = kept_history(t)
    store.update(updates, AS_OF, 1)
    return store.read().select(
        "dedup_key", *_UPDATED, stamp("first_seen"), F.md5("jd_text").alias("text_md5"),
        stamp("last_seen"),
    )


@query(
    "history_after_days",
    f"""SELECT h.dedup_key, CASE WHEN s.score IS NOT NULL THEN s.score ELSE h.match_score END AS match_score,
        strftime(CASE WHEN p.seq % 10 >= 4 THEN {CLOCK} WHEN p.seq IS NOT NULL AND h.old THEN TIMESTAMP '2024-01-30 00:00:00'
                      ELSE h.last_seen END, '%Y-%m-%d %H:%M:%S') AS last_seen, md5(h.jd_text) AS text_md5
        FROM (SELECT dedup_key, match_score, last_seen, jd_text, true AS old FROM @history
              UNION ALL SELECT dedup_key, 0.0E0, {CLOCK}, '', false FROM @postings
                        WHERE dedup_key NOT IN (SELECT dedup_key FROM @history)) h
        LEFT JOIN @postings p ON h.dedup_key = p.dedup_key
        LEFT JOIN (SELECT doc_id, CASE quality WHEN 1 THEN 80.0E0 ELSE 20.0E0 END AS score FROM labels
                   WHERE quality IS NOT NULL) s ON s.doc_id = p.seq""",
)
def history_after_days(t):
    """Two days of touches, new rows and scores, a compaction between them, and a day that is run twice."""
    columns = ["match_score", "last_seen", "jd_text"]
    store = kept_history(t, *columns)
    batch = t.postings.select("dedup_key", "seq")
    scores = t.read("labels").join(batch, F.col("doc_id") == F.col("seq")).select(
        "dedup_key", F.when(F.col("quality") == 1, 80.0).when(F.col("quality") == 0, 20.0).alias("score")
    )
    store.touch(batch, "2024-01-30 00:00:00", 1)
    store.set_scores(scores.withColumn("score", F.lit(1.0)), 1)
    store.compact(1)
    for _ in range(2):
        fresh = stage(H.first_sight(O.new_rows(t.postings, store.keys(before=2)), AS_OF), "fresh").select("dedup_key", *columns)
        store.insert(fresh, 2)
        store.touch(batch.where("seq % 10 >= 4"), AS_OF, 2)
        store.set_scores(scores, 2)
    return store.read().select("dedup_key", "match_score", stamp("last_seen"), F.md5("jd_text").alias("text_md5"))


@query(
    "unscored_rows",
    "SELECT dedup_key FROM @features WHERE NOT keyword_score >= 2",
)
def unscored_rows(t):
    from siftline.catalog.fixtures import PROFILE
    from siftline.operators.scoring import keyword_prefilter

    passed = keyword_prefilter(t.postings, PROFILE)
    return O.unseen(t.postings, passed).select("dedup_key")


@query(
    "replaced_companies",
    """SELECT normalized_name, company_type, confidence, verified_at FROM (
         SELECT lower(p_brand) AS normalized_name, '외국계' AS company_type, 'verified' AS confidence,
                max(p_size) AS verified_at
         FROM part GROUP BY lower(p_brand)
         UNION ALL
         SELECT lower(p_name), '불확인', 'unverified', max(p_size) FROM part
         WHERE lower(p_name) NOT IN (SELECT lower(p_brand) FROM part) GROUP BY lower(p_name)) c""",
)
def replaced_companies(t):
    def entry(column, kind, confidence):
        return t.read("part").select(
            F.lower(column).alias("normalized_name"),
            F.lit(kind).alias("company_type"),
            F.lit(confidence).alias("confidence"),
            F.col("p_size").alias("verified_at"),
        )

    # Brands and names recur: each table and each update has many rows for a key.
    old = H.replace_rows(
        entry("p_brand", "불확인", "unverified"), entry("p_name", "불확인", "unverified"),
        "normalized_name", newest="verified_at",
    )
    return H.replace_rows(
        old, entry("p_brand", "외국계", "verified"), "normalized_name", newest="verified_at"
    )


@query(
    "first_sights",
    f"""SELECT dedup_key, source, source_id, title, company, url,
        strftime({CLOCK}, '%Y-%m-%d %H:%M:%S') AS first_seen, 0.0E0 AS ai_match_score,
        '' AS canonical_key, 'unverified' AS company_type_confidence, 0 AS prefilter_passed
        FROM @fresh""",
)
def first_sights(t):
    return H.first_sight(O.new_rows(t.postings, t.history), AS_OF).select(
        "dedup_key", "source", "source_id", "title", "company", "url", stamp("first_seen"),
        "ai_match_score", "canonical_key", "company_type_confidence", "prefilter_passed",
    )


@query(
    "schema_growth",
    """SELECT dedup_key, match_score, '' AS location, 0.0E0 AS ranking_score, 'unverified' AS
       company_type_confidence, 0 AS prefilter_passed, 41 - 1 AS n_columns FROM @seen""",
)
def schema_growth(t):
    base = t.seen.select("dedup_key", "source", "match_score")
    grown = H.add_missing_columns(base, SEEN)
    return grown.select(
        "dedup_key", "match_score", "location", "ranking_score", "company_type_confidence",
        "prefilter_passed", F.lit(len(grown.columns)).alias("n_columns"),
    )


@query(
    "run_log",
    f"""SELECT run_id, {stamp_sql('run_date')}, jobs_scraped, jobs_new, jobs_recommended,
        recommendation_rate, api_cost_usd, errors FROM @runs
        UNION ALL
        SELECT (SELECT max(run_id) + 1 FROM @runs), strftime({CLOCK}, '%Y-%m-%d %H:%M:%S'),
               (SELECT count(*) FROM documents), (SELECT count(*) FROM labels), 10,
               10.0E0 / (SELECT count(*) FROM labels), 0.0E0, ''""",
)
def run_log(t):
    counts = (
        t.documents.select(F.lit(1).alias("jobs_scraped"), F.lit(0).alias("jobs_new"))
        .unionByName(t.read("labels").select(F.lit(0).alias("jobs_scraped"), F.lit(1).alias("jobs_new")))
        .agg(F.sum("jobs_scraped").alias("jobs_scraped"), F.sum("jobs_new").alias("jobs_new"))
        .withColumn("jobs_recommended", F.lit(10))
        .withColumn("run_date", F.lit(AS_OF).cast("timestamp"))
    )
    return (
        t.runs.unionByName(H.run_row(H.number_run(counts, t.runs)))
        .select("run_id", stamp("run_date"), "jobs_scraped", "jobs_new", "jobs_recommended",
                "recommendation_rate", "api_cost_usd", "errors")
    )


_NAMES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SOURCES))
_COUNTS = f"""SELECT v.r AS source_rank, v.s AS source, count(p.seq) AS postings
    FROM (VALUES {_NAMES}) v(r, s) LEFT JOIN @postings p ON p.source = v.s GROUP BY v.r, v.s"""


@query("source_counts", _COUNTS)
def count_sources(t):
    return source_counts(t.postings, SOURCES)


@query(
    "source_errors",
    f"""SELECT string_agg(source || ': zero results', '; ' ORDER BY source_rank)
        FILTER (WHERE postings = 0) AS errors FROM ({_COUNTS}) c""",
)
def source_errors(t):
    return zero_result_errors(source_counts(t.postings, SOURCES))


@query(
    "capped_sources",
    """SELECT source, dedup_key, seq FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq)
       AS n FROM @postings) p WHERE n <= 20""",
)
def capped_sources(t):
    return O.cap_per_source(t.postings.select("source", "dedup_key", "seq"), 20)


@query(
    "daily_spend",
    "SELECT COALESCE(sum(api_cost_usd), 0.0E0) AS api_cost_usd FROM @runs "
    "WHERE CAST(run_date AS DATE) = DATE '2024-01-30'",
)
def daily_spend(t):
    return spend_on(t.runs, "2024-01-30 12:00:00")
