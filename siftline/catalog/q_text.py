"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog import twins as X
from siftline.catalog.fixtures import AS_OF, EMPLOYERS, PROFILE, ROLES
from siftline.catalog.registry import query
from siftline.functions import freshness as D
from siftline.functions import rules as R
from siftline.functions import scores as S
from siftline.functions import text as X_
from siftline.operators.scoring import with_keyword_score
from siftline.sources.csv_sink import csv_cells


@query("canonical_keys", "SELECT dedup_key, canonical_key, normalized_name FROM @features")
def canonical_keys(t):
    return t.postings.select(
        X_.dedup_key(F.col("source"), F.col("source_id")).alias("dedup_key"),
        X_.canonical_key(F.col("company"), F.col("title")).alias("canonical_key"),
        X_.normalize_company(F.col("company")).alias("normalized_name"),
    )


_MIXED = "text || repeat('한글 ', CAST(floor(n_chars * (doc_id % 5) / 10) AS INT))"


@query(
    "text_language",
    f"SELECT doc_id, {X.language('t')} AS jd_language FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 "
    f"THEN '' ELSE {_MIXED} END AS t FROM documents) d",
)
def text_language(t):
    mixed = F.expr(f"CASE WHEN doc_id % 7 = 0 THEN '' ELSE {_MIXED} END")
    return t.documents.select("doc_id", mixed.alias("t")).select(
        "doc_id", R.text_language(F.col("t")).alias("jd_language")
    )


@query(
    "freshness",
    f"""SELECT dedup_key, {X.elapsed(X.parsed('posted_date'))} AS posted_days,
        {X.elapsed(X.EFFECTIVE)} AS effective_days, {X.label_of(X.elapsed(X.EFFECTIVE))} AS label,
        {X.bonus_of(X.elapsed(X.EFFECTIVE))} AS bonus, {X.EFFECTIVE_TEXT} AS effective_date,
        (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us({X.parsed('posted_date')})) / 86400000000.0E0 AS age
        FROM @postings""",
)
def freshness(t):
    posted, scraped = F.col("posted_date"), F.col("scraped_at")
    days = D.effective_freshness_days(posted, scraped, AS_OF)
    return t.postings.select(
        "dedup_key",
        D.freshness_days(posted, AS_OF).alias("posted_days"),
        days.alias("effective_days"),
        D.freshness_label(days).alias("label"),
        D.freshness_bonus(days).alias("bonus"),
        D.effective_date(posted, scraped).alias("effective_date"),
        D.age_in_days(D.parse_iso(posted), AS_OF).alias("age"),
    )


_BANDS = X.first_of("experience_required", R.EXPERIENCE_RULES, R.OTHER_BAND)


@query(
    "role_and_band",
    f"""SELECT seq, {X.first_of('lower(title)', ROLES, 'other')} AS role,
        {X.first_of("lower(title || ' ' || jd_text)", R.ROLE_RULES, R.OTHER_ROLE)} AS standard_role,
        {_BANDS} AS band FROM @postings""",
)
def role_and_band(t):
    return t.postings.withColumn("full", F.concat_ws(" ", "title", "jd_text")).select(
        "seq",
        R.role_family(F.col("title"), ROLES, "other").alias("role"),
        R.role_family(F.col("full")).alias("standard_role"),
        R.experience_band(F.col("experience_required")).alias("band"),
    )


@query(
    "employer_pattern",
    f"""SELECT seq, {X.first_of("lower(jd_text || ' ' || company)", EMPLOYERS, '일반')} AS pattern,
        {X.first_of("lower(jd_text || ' ' || company)", R.EMPLOYER_RULES, '일반')} AS standard_pattern
        FROM @postings""",
)
def employer_pattern(t):
    lowered = F.lower(F.concat_ws(" ", "jd_text", "company"))
    return t.postings.select("seq", lowered.alias("_t")).select(
        "seq",
        R.employer_class(F.col("_t"), EMPLOYERS).alias("pattern"),
        R.employer_class(F.col("_t")).alias("standard_pattern"),
    )


@query(
    "keyword_scores",
    "SELECT dedup_key, keyword_score, CASE WHEN keyword_score >= 2 THEN 1 ELSE 0 END AS "
    "prefilter_passed FROM @features",
)
def keyword_scores(t):
    return with_keyword_score(t.postings, PROFILE).select(
        "dedup_key", "keyword_score", "prefilter_passed"
    )


@query(
    "people_search",
    f"""SELECT seq, CASE WHEN ai_match_score >= 70 THEN {X.people_search('company', 'title')}
        ELSE '' END AS linkedin_search_url
        FROM (SELECT p.seq, p.company, p.title, s.ai_match_score FROM @postings p
              JOIN @seen s ON p.dedup_key = s.dedup_key) j""",
)
def people_search(t):
    fit = t.seen.select("dedup_key", "ai_match_score")
    return t.postings.join(fit, "dedup_key").select(
        "seq",
        F.when(
            F.col("ai_match_score") >= 70, X_.people_search_url(F.col("company"), F.col("title"))
        )
        .otherwise("")
        .alias("linkedin_search_url"),
    )


_CUTS = (5000, 2000, 1500, 500, 300)


@query(
    "text_cuts",
    "SELECT seq, " + ", ".join(
        f"length(substring(jd_text, 1, {n})) AS length_{n}, md5(substring(jd_text, 1, {n})) AS md5_{n}"
        for n in _CUTS
    ) + " FROM @postings",
)
def text_cuts(t):
    cuts = {n: X_.cut(F.col("jd_text"), n) for n in _CUTS}
    return t.postings.select(
        "seq",
        *[F.length(c).alias(f"length_{n}") for n, c in cuts.items()],
        *[F.md5(c).alias(f"md5_{n}") for n, c in cuts.items()],
    )


@query(
    "csv_export_cells",
    "SELECT CAST(doc_id AS STRING) AS doc_id, replace(replace(text, chr(10), ' | '), chr(13), '') "
    "AS text, COALESCE(CAST(quality AS STRING), '') AS quality FROM documents LEFT JOIN labels "
    "USING (doc_id)",
)
def csv_export_cells(t):
    joined = t.documents.join(t.read("labels"), "doc_id", "left")
    return csv_cells(joined.select("doc_id", "text", "quality"))


@query(
    "response_costs",
    "SELECT dedup_key, input_tokens * 8 + output_tokens * 40 AS units, "
    "(input_tokens * 8 + output_tokens * 40) / 10000000.0E0 AS usd FROM @responses",
)
def response_costs(t):
    units = S.response_cost_units(F.col("input_tokens"), F.col("output_tokens"))
    return t.responses.select("dedup_key", units.alias("units"), S.usd(units).alias("usd"))
