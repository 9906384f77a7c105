"""Dates as postings carry them: ISO text, epoch digits, or anything at all."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# Label and bonus per age in whole days.
FRESHNESS_LABELS = (
    (3, "\U0001f534 0-3d"),
    (7, "\U0001f7e0 4-7d"),
    (14, "\U0001f7e1 8-14d"),
    (30, "⚪ 15-30d"),
)
STALE_LABEL, UNKNOWN_LABEL = "⚫ >30d", "unknown"
FRESHNESS_BONUS = ((3, 10.0), (7, 8.0), (14, 5.0), (30, 2.0))

_EXTENDED = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?)?$"
_ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"
_LAST_EPOCH_SECOND = 253_402_300_799  # end of the year 9999


def as_timestamp(as_of: datetime | str | Column) -> Column:
    """The fixed clock as a column, read in the session time zone."""
    if isinstance(as_of, Column):
        return as_of
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp")


def days_back(as_of: datetime | str | Column, n: int) -> Column:
    """The day ``n`` days before that of ``as_of``.

    Compared with a timestamp it means midnight, whichever timestamp type the
    column has: Spark widens the date, not the column, so filters are pushed down.
    """
    return F.date_sub(F.to_date(as_timestamp(as_of)), n)


def parse_iso(text: Column) -> Column:
    """ISO date or date-time without an offset; NULL for all else, never an error.

    The shape is checked first: a bare cast also takes ``2024`` or ``10:00``.
    """
    extended = F.regexp_replace(F.regexp_replace(text, ",", "."), r"([T ]\d{2})$", "$1:00")
    return F.when(text.rlike(_EXTENDED), extended.try_cast("timestamp")).when(
        text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    )


def parse_instant(text: Column) -> Column:
    """As :func:`parse_iso`, and also date-times with ``Z`` or an offset of hours and minutes."""
    zoned = F.when(text.rlike(_ZONED), F.regexp_replace(text, ",", ".").try_cast("timestamp"))
    return F.coalesce(zoned, parse_iso(text))


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp; a fraction only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)


def epoch_to_iso(text: Column) -> Column:
    """All-digit text is epoch seconds and becomes ISO text; else unchanged."""
    seconds = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    return F.when(
        seconds <= _LAST_EPOCH_SECOND, iso_text(F.timestamp_seconds(seconds))
    ).otherwise(text)


def elapsed_days(ts: Column, as_of: datetime | str | Column) -> Column:
    """Whole days from ``ts`` to ``as_of``, rounded down (the future is negative)."""
    return F.floor((F.unix_micros(as_timestamp(as_of)) - F.unix_micros(ts)) / DAY_MICROS)


def age_in_days(ts: Column, as_of: datetime | str | Column) -> Column:
    """Age with its fraction."""
    return (F.unix_micros(as_timestamp(as_of)) - F.unix_micros(ts)) / DAY_MICROS


def freshness_days(posted: Column, as_of: datetime | str | Column) -> Column:
    return elapsed_days(parse_iso(posted), as_of)


def effective_freshness_days(
    posted: Column, scraped_at: Column, as_of: datetime | str | Column
) -> Column:
    """Age of the first readable date of the two; NULL when neither is."""
    return elapsed_days(F.coalesce(parse_iso(posted), scraped_at), as_of)


def effective_date(posted: Column, scraped_at: Column) -> Column:
    """The posted text unless blank (readable or not), else the collection time."""
    return F.coalesce(F.nullif(posted, F.lit("")), iso_text(scraped_at), F.lit(""))


def freshness_label(days: Column) -> Column:
    chain = F.when(days.isNull(), F.lit(UNKNOWN_LABEL))
    for limit, label in FRESHNESS_LABELS:
        chain = chain.when(days <= limit, F.lit(label))
    return chain.otherwise(F.lit(STALE_LABEL))


def freshness_bonus(days: Column) -> Column:
    chain = F.when(days.isNull(), F.lit(0.0))
    for limit, bonus in FRESHNESS_BONUS:
        chain = chain.when(days <= limit, F.lit(bonus))
    return chain.otherwise(F.lit(0.0))


def within_age(days: Column, max_days: int = 30) -> Column:
    """Undated postings stay."""
    return days.isNull() | (days <= max_days)
