"""Name normalisation, keys, truncation, URL encoding and CSV cells."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form marks removed, as substrings and in this order, from
# the two halves of a canonical key.
LEGAL_MARKS = (
    "(주)", "㈜", "주식회사", "inc.", "inc", "corp.", "corp",
    "ltd.", "ltd", "co.", "co,", "co", "llc", "gmbh", "s.a.",
    "株式会社", "有限公司",
)

# The shorter list used for the employer dimension key.
EMPLOYER_MARKS = (
    "(주)", "㈜", "주식회사", "inc.", "inc", "corp.", "corp",
    "ltd.", "ltd", "co.", "co", "llc", "gmbh",
)

# An opening and a closing bracket of any kind, shortest span.
# (?d) keeps the dot from matching only a line feed.
BRACKETED = r"(?d)[\[\(（【].*?[\]\)）】]"

# Everything Unicode calls white space (Java's \s is ASCII only).
SPACE = r"[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# The address of the people search.
PEOPLE_SEARCH_HEAD = "https://www.linkedin.com/search/results/people/?keywords="
PEOPLE_SEARCH_TAIL = "&origin=GLOBAL_SEARCH_HEADER"


def strip(c: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def _without(c: Column, marks: Iterable[str]) -> Column:
    return reduce(lambda rest, mark: F.replace(rest, F.lit(mark), F.lit("")), marks, c)


def normalize_text(c: Column) -> Column:
    """Lower case, legal marks and bracketed spans removed, blanks squeezed."""
    return squeeze(F.regexp_replace(_without(F.lower(c), LEGAL_MARKS), BRACKETED, ""))


def normalize_company(c: Column) -> Column:
    """Key of the employer dimension; bracketed spans stay."""
    return squeeze(_without(F.lower(c), EMPLOYER_MARKS))


def canonical_key(company: Column, title: Column) -> Column:
    """``company|title`` after normalisation; blank when either half is blank."""
    # nullif() and concat() evaluate each half once; comparing and then joining
    # would do the whole chain of replacements twice.
    halves = [F.nullif(normalize_text(c), F.lit("")) for c in (company, title)]
    return F.coalesce(F.concat(halves[0], F.lit("|"), halves[1]), F.lit(""))


def dedup_key(source: Column, source_id: Column) -> Column:
    return F.concat_ws(":", source, source_id)


def cut(c: Column, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(c, 1, n)


def percent_encode(c: Column) -> Column:
    """RFC 3986 percent encoding that leaves ``/`` and ``~`` as they are."""
    e = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        e = F.replace(e, F.lit(found), F.lit(wanted))
    return e


def people_search_url(company: Column, hint: Column) -> Column:
    """Search address for people at ``company``, narrowed by a team or title."""
    query = F.when(hint != "", F.concat(company, F.lit(" "), hint)).otherwise(company)
    return F.concat(F.lit(PEOPLE_SEARCH_HEAD), percent_encode(query), F.lit(PEOPLE_SEARCH_TAIL))


def csv_cell(c: Column) -> Column:
    """One-line text form of a value; NULL becomes blank."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" | ")), F.lit("\r"), F.lit(""))
