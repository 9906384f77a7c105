"""Input tables of the engine, derived from the given tables.

Each is a list of SQL expressions that Spark and DuckDB read alike.  The Spark
side builds data frames from them, the SQL side common table expressions.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.rules import CONGLOMERATE, FOREIGN, STARTUP, Profile
from siftline.operators.state import add_missing_columns
from siftline.schemas import SEEN, SEEN_COLUMNS

AS_OF = "2024-01-31 00:00:00"
CLOCK = f"TIMESTAMP '{AS_OF}'"
RUN_ID = 31

# Words that do occur in the given documents, in the roles of real keywords.
PROFILE = Profile(
    high=("license", "que", "thtion"),
    medium=("thble", "thing", "nicht"),
    negative=("idiot", "stupid", "worthless"),
)
EMPLOYERS = ((FOREIGN, ("der ",)), (STARTUP, ("pour",)), (CONGLOMERATE, ("los",)))
ROLES = (("A", ("thing", "que")), ("B", ("tion",)), ("C", ("nicht",)))
SOURCES = tuple(f"src{i}" for i in range(22))  # two more than the data has

FIRST_LINE = "split_part(text, chr(10), 1)"
FIRST_WORD = f"split_part({FIRST_LINE}, ' ', 1)"
EXPERIENCE = """CASE doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN '신입' WHEN 2 THEN '경력 3년'
    WHEN 3 THEN '5년 이상' WHEN 4 THEN '10년' WHEN 5 THEN '무관' WHEN 6 THEN '6년' ELSE '2~5년' END"""
POSTED = f"""CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 11 = 0 THEN '~06.30(월)'
    WHEN doc_id % 13 = 0 THEN CAST(CAST({CLOCK} - INTERVAL '1' DAY * (doc_id % 45) AS DATE) AS STRING) || 'T10:30:00+09:00'
    WHEN doc_id % 17 = 0 THEN CAST(CAST({CLOCK} - INTERVAL '1' DAY * (doc_id % 45) AS DATE) AS STRING) || ' 01:00:00.5Z'
    ELSE CAST(CAST({CLOCK} - INTERVAL '1' DAY * (doc_id % 45) AS DATE) AS STRING) END"""
KEY = "source || ':' || CAST(doc_id AS STRING)"
SCORE = """CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE)"""

POSTINGS = {
    "seq": "doc_id",
    "source": "source",
    "source_id": "CAST(doc_id AS STRING)",
    "dedup_key": KEY,
    "url": "'https://jobs.example.org/' || CAST(doc_id AS STRING)",
    "title": FIRST_LINE,
    "company": f"""CASE WHEN doc_id % 10 = 9 THEN '' ELSE {FIRST_WORD}
        || CASE WHEN doc_id % 2 = 0 THEN ' Corp.' ELSE ' Inc.' END END""",
    "location": "CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'City' || CAST(doc_id % 7 AS STRING) END",
    "experience_required": EXPERIENCE,
    "salary_info": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE '3000' END",
    "posted_date": POSTED,
    "deadline": "''",
    "jd_text": "text",
    "scraped_at": f"{CLOCK} - INTERVAL '1' HOUR * (doc_id % 72)",
}

RESPONSES = {
    "dedup_key": KEY,
    "response_text": """CASE WHEN event_id % 29 = 0 THEN 'not json'
        WHEN event_id % 13 = 0 THEN '```json' || chr(10) || replace(replace(props, '"k"', '"score"'),
            '}', ', "reasons": "' || event_type || ' license"}') || chr(10) || '```'
        WHEN event_id % 17 = 0 THEN '{"reasons": "none given"}'
        WHEN event_id % 19 = 0 THEN '{"score": null}'
        ELSE replace(replace(props, '"k"', '"score"'),
            '}', ', "reasons": "' || event_type || ' que thing", "positioning": "lead with ' || event_type || '"}') END""",
    "input_tokens": "500 + event_id % 1500",
    "output_tokens": "100 + event_id % 300",
}

# What the response texts above say, for the SQL side.
RESPONSE_FACTS = {
    "dedup_key": KEY,
    "valid": "event_id % 29 <> 0 AND (event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 <> 0)",
    "response_score": f"""CASE WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN 0.0E0
        ELSE LEAST(100.0E0, GREATEST(0.0E0, {SCORE})) END""",
    "reasons": """CASE WHEN event_id % 13 = 0 THEN event_type || ' license'
        WHEN event_id % 17 = 0 THEN 'none given' ELSE event_type || ' que thing' END""",
    "positioning": """CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN ''
        ELSE 'lead with ' || event_type END""",
    "cost_units": "(500 + event_id % 1500) * 8 + (100 + event_id % 300) * 40",
}

ENRICHMENTS = {
    "dedup_key": KEY,
    "response_text": """CASE event_id % 4
        WHEN 0 THEN '{"company_intro": "intro ' || CAST(event_id AS STRING) || '", "team_function": "team/' || event_type || '", "positioning_advice": "stress ' || event_type || '"}'
        WHEN 1 THEN '{"company_intro": "intro ' || CAST(event_id AS STRING) || '", "market_position": "second of ' || event_type
        WHEN 2 THEN 'Sure: "company_intro": "intro ' || CAST(event_id AS STRING) || '", "business_model": "fees" and more'
        ELSE 'no answer' END""",
    "input_tokens": "900 + event_id % 700",
    "output_tokens": "400 + event_id % 900",
}

SEEN_FILLED = {
    "dedup_key": KEY,
    "source": "source",
    "source_id": "CAST(doc_id AS STRING)",
    "title": FIRST_LINE,
    "company": FIRST_WORD,
    "url": "'https://jobs.example.org/' || CAST(doc_id AS STRING)",
    "first_seen": f"{CLOCK} - INTERVAL '1' HOUR * (doc_id % 480)",
    "last_seen": f"{CLOCK} - INTERVAL '1' HOUR * (doc_id % 36) + INTERVAL '1' HOUR * (event_id % 3)",
    "match_score": SCORE,
    "location": "CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'City' || CAST(doc_id % 7 AS STRING) END",
    "experience_required": EXPERIENCE,
    "salary_info": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE '3000' END",
    "posted_date": POSTED,
    "company_type": """CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '외국계' WHEN 2 THEN '대기업'
        WHEN 3 THEN '스타트업' ELSE '불확인' END""",
    "company_type_confidence": """CASE doc_id % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'pattern_match'
        ELSE 'unverified' END""",
    "keyword_score": "CAST(doc_id % 11 AS DOUBLE)",
    "ai_match_score": SCORE,
    "ranking_score": f"{SCORE} + doc_id % 17",
    "match_reasons": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE event_type || ' que thing' END",
    "canonical_key": f"CASE WHEN doc_id % 9 = 0 THEN '' ELSE lower({FIRST_LINE}) END",
    "prefilter_passed": "CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END",
}

SNIPPET_NAME = f"trim(replace(lower({FIRST_WORD}), 'co', ''))"
SNIPPET_TEXT = """item_text || CASE item_id % 3 WHEN 0 THEN ' a Multinational group'
    WHEN 1 THEN ' raised venture funding, conglomerate' ELSE '' END"""

RUNS_SQL = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY day) AS BIGINT) AS run_id, CAST(day AS TIMESTAMP) AS run_date,
       jobs_scraped, jobs_new, jobs_prefilter_passed, LEAST(10, purchases) AS jobs_recommended,
       jobs_prefilter_passed AS jobs_matched, LEAST(3, signups) AS jobs_enriched,
       1.0E0 * LEAST(10, purchases) / jobs_new AS recommendation_rate,
       cents / 10000000.0E0 AS api_cost_usd,
       CASE WHEN EXTRACT(DAY FROM day) % 7 = 0 THEN 'src' || CAST(EXTRACT(DAY FROM day) AS STRING)
           || ': zero results' ELSE '' END AS errors,
       cents / 100000.0E0 AS duration_seconds
FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS jobs_scraped,
             COUNT(DISTINCT user_id) AS jobs_new,
             CAST(SUM(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS BIGINT)
                 AS jobs_prefilter_passed,
             CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
             CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS signups,
             CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM {events} GROUP BY CAST(ts AS DATE)) d
"""


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


_SCORED_DOCS = "documents JOIN events ON doc_id = event_id"
_SEEN_DEFAULTS = {
    name: ("NULL" if default is None else repr(default))
    for name, _, default in SEEN
    if name not in SEEN_FILLED
}
# Conversations stand for postings that history has but a batch does not.
_OLD = {
    "dedup_key": "'conv:' || CAST(conv_id AS STRING)",
    "source": "'conv'",
    "source_id": "CAST(conv_id AS STRING)",
    "title": "'conversation'",
    "company": "''",
    "url": "''",
    "first_seen": f"{CLOCK} - INTERVAL '1' DAY * conv_id",
    "last_seen": f"{CLOCK} - INTERVAL '1' DAY * conv_id",
}
_OLD_DEFAULTS = {
    name: ("NULL" if default is None else repr(default))
    for name, _, default in SEEN
    if name not in _OLD
}

# Common tables of the SQL side.
CTE = {
    "postings": _select(POSTINGS, "documents"),
    "responses": _select(RESPONSES, _SCORED_DOCS),
    "response_facts": _select(RESPONSE_FACTS, _SCORED_DOCS),
    "enrichments": _select(ENRICHMENTS, _SCORED_DOCS),
    "seen": _select({**SEEN_FILLED, **_SEEN_DEFAULTS}, _SCORED_DOCS),
    "history": (
        "SELECT " + ", ".join(SEEN_COLUMNS) + " FROM (" + _select(
            {**SEEN_FILLED, **_SEEN_DEFAULTS},
            _SCORED_DOCS + " WHERE doc_id IN (SELECT doc_id FROM labels)",
        ) + ") UNION ALL SELECT " + ", ".join(SEEN_COLUMNS) + " FROM ("
        + _select({**_OLD, **_OLD_DEFAULTS}, "(SELECT DISTINCT conv_id FROM conversations)") + ")"
    ),
    "runs": RUNS_SQL.replace("{events}", "events"),
    # An employer dimension from the parts table: every fourth first word is known.
    "cache": (
        "SELECT normalized_name, '대기업' AS company_type, 'verified' AS confidence, "
        "'tavily' AS source FROM (SELECT DISTINCT trim(split_part(lower(text), ' ', 1)) AS "
        "normalized_name FROM benchmark)"
    ),
    # Search evidence: benchmark texts, filed under the first word of the document
    # of the same number.
    "evidence": f"SELECT {SNIPPET_NAME} AS normalized_name, item_id, {SNIPPET_TEXT} AS text "
    "FROM documents JOIN (SELECT item_id, text AS item_text FROM benchmark) ON doc_id = item_id",
}


def expand(sql: str) -> str:
    """Put the common tables that ``sql`` names as ``@name`` in front of it."""
    found = []

    def visit(text: str) -> None:
        for name in re.findall(r"@(\w+)", text):
            if name not in found:
                visit(CTE[name])
                found.append(name)

    visit(sql)
    strip = lambda text: re.sub(r"@(\w+)", r"\1", text)
    body = strip(sql).strip()
    if not found:
        return body
    tables = ", ".join(f"{n} AS ({strip(CTE[n])})" for n in found)
    if body.upper().startswith("WITH "):
        return f"WITH {tables}, {body[5:]}"
    return f"WITH {tables} {body}"


class Tables:
    """The given tables of one folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])

    @cached_property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def scored_docs(self) -> DataFrame:
        # Of the text only its first line is ever asked; the join moves no more.
        narrow = self.documents.selectExpr("doc_id", "source", f"{FIRST_LINE} AS text")
        return narrow.join(self.events, F.col("doc_id") == F.col("event_id"))

    @cached_property
    def postings(self) -> DataFrame:
        return self._pick(self.documents, POSTINGS)

    @cached_property
    def responses(self) -> DataFrame:
        return self._pick(self.scored_docs, RESPONSES)

    @cached_property
    def enrichments(self) -> DataFrame:
        return self._pick(self.scored_docs, ENRICHMENTS)

    def _as_seen(self, df: DataFrame) -> DataFrame:
        return add_missing_columns(df, SEEN).select(*SEEN_COLUMNS)

    @cached_property
    def seen(self) -> DataFrame:
        return self._as_seen(self._pick(self.scored_docs, SEEN_FILLED))

    @cached_property
    def history(self) -> DataFrame:
        labelled = self.scored_docs.join(self.read("labels").select("doc_id"), "doc_id", "left_semi")
        old = self.read("conversations").select("conv_id").distinct()
        return self._as_seen(self._pick(labelled, SEEN_FILLED)).unionByName(
            self._as_seen(self._pick(old, _OLD))
        )

    @cached_property
    def runs(self) -> DataFrame:
        return self.spark.sql(RUNS_SQL, events=self.events)

    @cached_property
    def cache(self) -> DataFrame:
        name = F.trim(F.split_part(F.lower("text"), F.lit(" "), F.lit(1)))
        return (
            self.read("benchmark")
            .select(name.alias("normalized_name"))
            .distinct()
            .select(
                "normalized_name",
                F.lit(CONGLOMERATE).alias("company_type"),
                F.lit("verified").alias("confidence"),
                F.lit("tavily").alias("source"),
                F.lit("2024-01-01").cast("timestamp").alias("verified_at"),
                F.lit("").alias("raw_search_snippet"),
            )
        )

    @cached_property
    def snippets(self) -> DataFrame:
        texts = self.read("benchmark").withColumnRenamed("text", "item_text")
        named = self.documents.selectExpr("doc_id", "source", f"{SNIPPET_NAME} AS normalized_name")
        return named.join(texts, F.col("doc_id") == F.col("item_id")).selectExpr(
            "normalized_name", f"{SNIPPET_TEXT} AS snippet"
        )
