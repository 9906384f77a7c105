"""SQL twins of the longer operators, as common tables for the oracle side."""

from __future__ import annotations

from siftline.catalog.fixtures import CLOCK, CTE, EMPLOYERS, PROFILE
from siftline.functions.rules import EVIDENCE_WORDS
from siftline.functions.text import EMPLOYER_MARKS, LEGAL_MARKS

SPACE = r"[\s\x{001c}-\x{001f}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
ISO = r"^\d{4}-\d{2}-\d{2}$"


def normalized(expr: str, marks: tuple[str, ...], brackets: bool) -> str:
    e = f"lower({expr})"
    for m in marks:
        e = f"replace({e}, '{m}', '')"
    if brackets:
        e = rf"regexp_replace({e}, '[\[\(（【].*?[\]\)）】]', '', 'g')"
    return f"trim(regexp_replace({e}, '{SPACE}', ' ', 'g'))"


def canonical(company: str = "company", title: str = "title") -> str:
    c = normalized(company, LEGAL_MARKS, True)
    t = normalized(title, LEGAL_MARKS, True)
    return f"CASE WHEN {c} <> '' AND {t} <> '' THEN {c} || '|' || {t} ELSE '' END"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def first_of(text: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN {any_of(text, words)} THEN '{label}'" for label, words in rules)
    return f"CASE {arms} ELSE '{default}' END"


def keyword_score(text: str) -> str:
    terms = " + ".join(
        f"CASE WHEN contains({text}, '{k}') THEN {w}E0 ELSE 0.0E0 END"
        for k, w in PROFILE.weighted()
    )
    return f"GREATEST(0.0E0, {terms})"


def parsed(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{ISO}') THEN TRY_CAST({text} AS TIMESTAMP) END"


def instant(text: str) -> str:
    """Microseconds since 1970 of a date, or of a date-time with an offset."""
    return (
        f"CASE WHEN regexp_matches({text}, '(Z|[+-][0-9:]{{5}})$') THEN epoch_us(TRY_CAST({text} AS TIMESTAMPTZ))"
        f" ELSE epoch_us({parsed(text)}) END"
    )


def elapsed(ts: str) -> str:
    return (
        f"CAST(floor((epoch_us({CLOCK}) - epoch_us({ts})) / 86400000000.0E0) AS BIGINT)"
    )


def label_of(days: str) -> str:
    return f"""CASE WHEN {days} IS NULL THEN 'unknown' WHEN {days} <= 3 THEN '🔴 0-3d'
        WHEN {days} <= 7 THEN '🟠 4-7d' WHEN {days} <= 14 THEN '🟡 8-14d'
        WHEN {days} <= 30 THEN '⚪ 15-30d' ELSE '⚫ >30d' END"""


def bonus_of(days: str) -> str:
    return f"""CASE WHEN {days} IS NULL THEN 0.0E0 WHEN {days} <= 3 THEN 10.0E0 WHEN {days} <= 7
        THEN 8.0E0 WHEN {days} <= 14 THEN 5.0E0 WHEN {days} <= 30 THEN 2.0E0 ELSE 0.0E0 END"""


def language(text: str) -> str:
    hangul = f"length(regexp_replace({text}, '[^가-힣]', '', 'g'))"
    return f"""CASE WHEN {text} = '' THEN 'unknown'
        WHEN CAST({hangul} AS DOUBLE) / length({text}) > 0.3E0 THEN 'Korean' ELSE 'English' END"""


EFFECTIVE = f"COALESCE({parsed('posted_date')}, scraped_at)"
EFFECTIVE_TEXT = (
    "CASE WHEN posted_date <> '' THEN posted_date ELSE strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') END"
)

CTE["features"] = f"""
SELECT *, {canonical()} AS canonical_key,
       CASE WHEN jd_text <> '' THEN 10 ELSE 0 END + CASE WHEN posted_date <> '' THEN 5 ELSE 0 END
         + CASE WHEN salary_info <> '' THEN 3 ELSE 0 END
         + CASE WHEN experience_required <> '' THEN 2 ELSE 0 END
         + CASE WHEN location <> '' THEN 1 ELSE 0 END AS completeness,
       {normalized('company', EMPLOYER_MARKS, False)} AS normalized_name,
       {first_of("lower(jd_text || ' ' || company)", EMPLOYERS, '일반')} AS pattern,
       {keyword_score("lower(title || ' ' || jd_text || ' ' || company)")} AS keyword_score,
       {language('jd_text')} AS jd_language,
       {elapsed(EFFECTIVE)} AS freshness_days,
       {EFFECTIVE_TEXT} AS effective_date
FROM @postings"""

CTE["fresh"] = "SELECT * FROM @features WHERE dedup_key NOT IN (SELECT dedup_key FROM @history)"


def _merge(source: str, name: str) -> None:
    CTE[f"{name}_ranked"] = f"""
SELECT *, row_number() OVER best AS nth, first_value(source) OVER best AS best_source,
       min(seq) OVER (PARTITION BY canonical_key) AS first_seq
FROM @{source} WHERE canonical_key <> ''
WINDOW best AS (PARTITION BY canonical_key ORDER BY completeness DESC, seq)"""
    CTE[f"{name}_others"] = f"""
SELECT canonical_key AS k, string_agg(source, '+' ORDER BY best) AS others
FROM (SELECT canonical_key, source, min(nth) AS best FROM @{name}_ranked
      WHERE source <> best_source GROUP BY canonical_key, source)
GROUP BY canonical_key"""
    CTE[name] = f"""
SELECT * EXCLUDE (nth, best_source, first_seq, k, others),
       CASE WHEN others IS NULL THEN '' ELSE dedup_key || '+' || others END AS canonical_group_id,
       1152921504606846976 + first_seq AS merge_order
FROM @{name}_ranked LEFT JOIN @{name}_others ON canonical_key = k WHERE nth = 1
UNION ALL BY NAME
SELECT *, '' AS canonical_group_id, seq AS merge_order FROM @{source} WHERE canonical_key = ''"""


_merge("features", "merged_all")
_merge("fresh", "merged")
CTE["kept"] = "SELECT * FROM @merged WHERE freshness_days IS NULL OR freshness_days <= 30"

CTE["firsts"] = """
SELECT normalized_name, count(*) AS postings, min(merge_order) AS first_order,
       arg_min(pattern, merge_order) AS pattern FROM @kept GROUP BY normalized_name"""
_confirms = " ".join(
    f"WHEN f.pattern = '{label}' THEN {any_of('lower(s.text)', words)}"
    for label, words in EVIDENCE_WORDS.items()
)
CTE["searched"] = f"""
SELECT f.normalized_name, bool_or(CASE {_confirms} ELSE FALSE END) AS confirmed
FROM @firsts f JOIN @evidence s ON f.normalized_name = s.normalized_name
WHERE f.pattern <> '일반' AND f.normalized_name NOT IN (SELECT normalized_name FROM @cache)
GROUP BY f.normalized_name, f.first_order ORDER BY f.first_order LIMIT 20"""
CTE["verdicts"] = """
SELECT f.normalized_name, f.postings, c.company_type IS NOT NULL AS cached,
       CASE WHEN c.company_type IS NOT NULL THEN c.company_type
            WHEN f.pattern = '일반' THEN '불확인'
            WHEN s.confirmed IS NULL OR s.confirmed THEN f.pattern ELSE '불확인' END AS company_type,
       CASE WHEN c.company_type IS NOT NULL THEN c.confidence
            WHEN f.pattern = '일반' THEN 'unverified'
            WHEN s.confirmed IS NULL THEN 'pattern_match'
            WHEN s.confirmed THEN 'verified' ELSE 'unverified' END AS company_type_confidence,
       CASE WHEN c.company_type IS NOT NULL THEN c.source
            WHEN f.pattern = '일반' THEN 'default'
            WHEN s.confirmed THEN 'tavily' ELSE 'pattern' END AS company_type_source,
       f.pattern
FROM @firsts f LEFT JOIN @cache c ON f.normalized_name = c.normalized_name
LEFT JOIN @searched s ON f.normalized_name = s.normalized_name"""
CTE["classified"] = """
SELECT k.*, v.company_type, v.company_type_confidence, v.company_type_source
FROM @kept k JOIN @verdicts v ON k.normalized_name = v.normalized_name"""


def _score(source: str, name: str, order: str) -> None:
    CTE[f"{name}_priced"] = f"""
SELECT p.*, r.response_score, r.reasons, r.positioning,
       p.keyword_score >= 2 AND COALESCE(r.valid, FALSE) AS usable,
       CASE WHEN p.keyword_score >= 2 AND COALESCE(r.valid, FALSE) THEN r.cost_units ELSE 0 END AS cost
FROM @{source} p LEFT JOIN @response_facts r ON p.dedup_key = r.dedup_key"""
    CTE[f"{name}_counted"] = f"""
SELECT *, usable AND COALESCE(sum(cost) OVER (ORDER BY keyword_score DESC, {order}
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= 5000000 AS counted
FROM @{name}_priced"""
    CTE[name] = f"""
SELECT * EXCLUDE (response_score, reasons, positioning, usable, cost, counted),
       CASE WHEN keyword_score >= 2 THEN 1 ELSE 0 END AS prefilter_passed,
       CASE WHEN counted AND response_score <> 0 THEN response_score
            WHEN keyword_score >= 2 THEN LEAST(100.0E0, keyword_score * 5) ELSE 0.0E0 END
            AS ai_match_score,
       CASE WHEN counted THEN reasons ELSE '' END AS match_reasons,
       CASE WHEN counted THEN positioning ELSE '' END AS positioning_advice,
       CASE WHEN counted THEN cost ELSE 0 END AS spent_units
FROM @{name}_counted"""


_score("features", "scored_all", "seq")
_score("classified", "scored_new", "merge_order")
CTE["ranked"] = f"""
SELECT *, CASE WHEN ai_match_score >= 40 THEN ai_match_score
         + CASE WHEN company_type_confidence = 'unverified' THEN 0.0E0
                WHEN company_type = '외국계' THEN 6.0E0 WHEN company_type = '대기업' THEN 4.0E0
                WHEN company_type = '스타트업' THEN 2.0E0 ELSE 0.0E0 END
         + {bonus_of('freshness_days')} ELSE 0.0E0 END AS ranking_score
FROM @scored_new"""
CTE["top"] = """
SELECT *, row_number() OVER (ORDER BY ranking_score DESC, ai_match_score DESC, keyword_score DESC,
       merge_order) AS rank
FROM @ranked WHERE ai_match_score >= 40
ORDER BY ranking_score DESC, ai_match_score DESC, keyword_score DESC, merge_order LIMIT 10"""
CTE["enrichment_facts"] = """
SELECT source || ':' || CAST(doc_id AS STRING) AS dedup_key, event_id % 4 <> 3 AS valid,
       CASE WHEN event_id % 4 <> 3 THEN 'intro ' || CAST(event_id AS STRING) END AS company_intro,
       CASE WHEN event_id % 4 = 2 THEN 'fees' WHEN event_id % 4 <> 3 THEN '' END AS business_model,
       CASE WHEN event_id % 4 = 1 THEN 'second of ' || event_type WHEN event_id % 4 <> 3 THEN '' END
           AS market_position,
       CASE WHEN event_id % 4 = 0 THEN 'team/' || event_type WHEN event_id % 4 <> 3 THEN '' END
           AS team_function,
       CASE WHEN event_id % 4 = 0 THEN 'stress ' || event_type WHEN event_id % 4 <> 3 THEN '' END AS advice,
       CASE WHEN event_id % 4 <> 3 THEN (900 + event_id % 700) * 8 + (400 + event_id % 900) * 40
            ELSE 0 END AS cost_units
FROM documents JOIN events ON doc_id = event_id"""
CTE["enriched_priced"] = """
SELECT t.*, e.company_intro, e.business_model, e.market_position, e.team_function, e.advice,
       t.ai_match_score >= 70 AND COALESCE(e.valid, FALSE) AS usable,
       CASE WHEN t.ai_match_score >= 70 AND COALESCE(e.valid, FALSE) THEN e.cost_units ELSE 0 END AS cost
FROM @top t LEFT JOIN @enrichment_facts e ON t.dedup_key = e.dedup_key"""
CTE["enriched_counted"] = """
SELECT *, usable AND COALESCE(sum(cost) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING
       AND 1 PRECEDING), 0) <= GREATEST(0, 5000000 - (SELECT sum(spent_units) FROM @scored_new)) AS counted
FROM @enriched_priced"""
CTE["shortlist"] = """
SELECT * EXCLUDE (company_intro, business_model, market_position, team_function, advice, usable,
                  cost, counted, positioning_advice),
       CASE WHEN counted THEN company_intro ELSE '' END AS company_intro,
       CASE WHEN counted THEN business_model ELSE '' END AS business_model,
       CASE WHEN counted THEN market_position ELSE '' END AS market_position,
       CASE WHEN counted THEN team_function ELSE '' END AS team_function,
       CASE WHEN counted AND advice <> '' THEN advice ELSE positioning_advice END AS positioning_advice,
       CASE WHEN counted THEN cost ELSE 0 END AS enrich_units
FROM @enriched_counted"""


def people_search(company: str, hint: str) -> str:
    query = f"{company} || CASE WHEN {hint} <> '' THEN ' ' || {hint} ELSE '' END"
    return (
        "'https://www.linkedin.com/search/results/people/?keywords=' || "
        f"replace(url_encode({query}), '%2F', '/') || '&origin=GLOBAL_SEARCH_HEADER'"
    )
