"""Scores, response parsing, costs and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.rules import CONGLOMERATE, FOREIGN, STARTUP
from siftline.functions.text import strip

# Bonus per confirmed employer class.
EMPLOYER_BONUS = {FOREIGN: 6.0, CONGLOMERATE: 4.0, STARTUP: 2.0}

# Price of a million tokens in US dollars is 0.80 read and 4.00
# written.  Costs are whole tenths of a millionth of a dollar, so that running
# totals are exact whatever the order of addition.
INPUT_UNITS, OUTPUT_UNITS = 8, 40
UNITS_PER_USD = 10_000_000

# Keys of an enrichment response.
ENRICHMENT_FIELDS = (
    "company_intro", "products_services", "business_model", "vision_goals",
    "ideal_candidate", "market_position", "team_function",
)
ADVICE_FIELD = "positioning_advice"

_OBJECT = r"(?s)^\s*\{.*\}\s*$"
_FENCE = "```"


def clamp_score(c: Column) -> Column:
    """Into 0..100; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), c)))


def keyword_fallback(keyword_score: Column) -> Column:
    """The score used where no usable external score exists."""
    return clamp_score(keyword_score * 5)


def employer_bonus(employer: Column, confidence: Column) -> Column:
    chain = F.when(confidence == "unverified", F.lit(0.0))
    for label, bonus in EMPLOYER_BONUS.items():
        chain = chain.when(employer == label, F.lit(bonus))
    return chain.otherwise(F.lit(0.0))


def strip_fence(text: Column) -> Column:
    """Body of a fenced block; NULL for a fence without a body."""
    t = strip(text)
    after_first_line = F.regexp_extract(t, r"(?s)^[^\n]*\n(.*)$", 1)
    body = strip(F.regexp_replace(after_first_line, r"(?s)^(.*)```.*$", "$1"))
    return F.when(~t.startswith(_FENCE), t).when(t.contains("\n"), body)


def json_object(text: Column) -> Column:
    """VARIANT of a text that is one JSON object as a whole, else NULL."""
    return F.when(text.rlike(_OBJECT), F.try_parse_json(text))


def text_field(v: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))


def score_field(v: Column) -> Column:
    """Number under ``score``; 0 when the key is missing, NULL when unusable."""
    present = F.try_variant_get(v, "$.score", "variant").isNotNull()
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(
        F.when(present, F.try_variant_get(v, "$.score", "double")).otherwise(F.lit(0.0))
    )


def close_json(text: Column) -> Column:
    """Close an open string and the open braces of a cut-off JSON text."""
    t = F.regexp_replace(text, r"\s+$", "")
    quotes = F.length(t) - F.length(F.replace(t, F.lit('"'), F.lit("")))
    opened = F.length(F.replace(t, F.lit("}"), F.lit(""))) - F.length(
        F.replace(t, F.lit("{"), F.lit(""))
    )
    closed = F.concat(
        t,
        F.when(quotes % 2 == 1, F.lit('"')).otherwise(F.lit("")),
        F.repeat(F.lit("}"), F.greatest(opened, F.lit(0))),
    )
    return F.when(t.endswith("}"), t).otherwise(closed)


def loose_field(text: Column, name: str) -> Column:
    """Value of ``"name": "..."`` wherever it stands; NULL when it does not."""
    pattern = rf'"{name}"\s*:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
    raw = F.regexp_extract(text, pattern, 1)
    plain = F.replace(F.replace(raw, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    return F.when(text.rlike(pattern), plain)


def response_cost_units(input_tokens: Column, output_tokens: Column) -> Column:
    return input_tokens.cast("bigint") * INPUT_UNITS + output_tokens.cast("bigint") * OUTPUT_UNITS


def usd(units: Column) -> Column:
    return units / F.lit(float(UNITS_PER_USD))


def usd_to_units(dollars: float) -> int:
    return round(dollars * UNITS_PER_USD)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; 0 without a positive denominator."""
    return F.round(
        F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0)), digits
    )


def change_pct(now: Column, before: Column) -> Column:
    return F.when(before > 0, F.round(F.lit(100.0) * (now - before) / before, 1))


def direction(now: Column, before: Column) -> Column:
    return (
        F.when(now > before, F.lit("up"))
        .when(now < before, F.lit("down"))
        .otherwise(F.lit("flat"))
    )
