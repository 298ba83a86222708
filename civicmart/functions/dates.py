"""Calendar and time-zone column functions (all JVM-side, whole-stage-codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_DAY = "yyyy-MM-dd"
# Accepts a fraction of 1 to 9 digits, or none; anything else is rejected (ANSI error).
UTC_TEXT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]'Z'"


def round_to_day(ts) -> Column:
    """Nearest calendar day; noon and later goes to the next day (``ROUND(d, 'DDD')``)."""
    return F.to_date(F.timestamp_add("HOUR", F.lit(12), as_col(ts)))


def week_ending_saturday(d) -> Column:
    """Label of the Sunday-to-Saturday week holding ``d``: the closing Saturday (``W-SAT``)."""
    return F.next_day(F.date_sub(F.to_date(as_col(d)), 1), "Sat")


def fiscal_year(d) -> Column:
    """Fiscal year of a date: October starts the next year. Null stays null."""
    c = F.to_date(as_col(d))
    return fiscal_year_of(F.year(c), F.month(c))


def fiscal_year_of(year, month) -> Column:
    """Fiscal year from calendar year and month columns (October starts the next year)."""
    y, m = as_col(year), as_col(month)
    return y + F.when(m >= 10, F.lit(1)).otherwise(F.lit(0))


def fiscal_month(month) -> Column:
    """Fiscal month from a calendar month number: October = 1 ... September = 12."""
    m = as_col(month)
    return F.when(m >= 10, m - 9).otherwise(m + 3)


# English month abbreviations (the ``MMM`` pattern in an English locale).
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_name(month) -> Column:
    """Three-letter English month abbreviation of a month number (Jan ... Dec).

    An array lookup rather than formatting a constructed date per row; null stays null and
    a month outside 1..12 is an error under ANSI mode, as for an invalid date."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS]), as_col(month).cast("int"))


def month_end(year, month) -> Column:
    """Last day of the month (a DATE)."""
    return F.last_day(F.make_date(as_col(year), as_col(month), F.lit(1)))


def month_end_text(year, month) -> Column:
    """Last day of the month as ``yyyy-MM-dd`` text."""
    return F.date_format(month_end(year, month), ISO_DAY)


def previous_month(year: int, month: int) -> tuple[int, int]:
    """Driver-side parameter arithmetic: the month before (year, month), rolling the year."""
    first = _dt.date(year, month, 1) - _dt.timedelta(days=1)
    return first.year, first.month


def resolve_year_month(year: int | None = None, month: int | None = None, today: _dt.date | None = None) -> tuple[int, int]:
    """Job parameter defaults: the current year and/or month when not given (driver side;
    queries never read ``current_date()``, so they stay reproducible)."""
    today = today or _dt.date.today()
    return (year or today.year, month or today.month)


def iso_text(ts) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text; null stays null; fraction dropped."""
    return F.date_format(as_col(ts), ISO_SECONDS)


def iso_week_label(d) -> Column:
    """``yyyy-MM-ddT00:00:00.000`` label of a date."""
    return F.concat(F.date_format(as_col(d), ISO_DAY), F.lit("T00:00:00.000"))


def parse_utc_text(text) -> Column:
    """Strictly parse ``yyyy-MM-ddTHH:mm:ss[.fraction]Z`` text to a wall-clock UTC TIMESTAMP_NTZ.

    Empty or null text gives null; malformed text raises under ANSI mode.
    """
    t = F.nullif(as_col(text), F.lit(""))
    return F.when(t.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(
        F.to_timestamp_ntz(t, F.lit(UTC_TEXT_PATTERN))
    )


def utc_to_local(c, tz: str = "US/Central", from_text: bool = True) -> Column:
    """UTC time (text in the catalog's format, or a zone-less timestamp) to local wall-clock
    text ``yyyy-MM-ddTHH:mm:ss``, daylight saving aware; fraction truncated; null -> null.

    ``convert_timezone`` works on TIMESTAMP_NTZ and does not depend on the session zone.
    """
    ts = parse_utc_text(c) if from_text else as_col(c).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts), ISO_SECONDS)


def parse_ts(text, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP_NTZ with an explicit pattern (or Spark's default ISO parsing)."""
    c = as_col(text)
    return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)


def local_minute_stamp(ts, tz: str = "US/Central") -> Column:
    """Instant (TIMESTAMP) -> local text at minute precision: ``yyyy-MM-ddTHH:mm:00.000``."""
    local = F.from_utc_timestamp(as_col(ts), tz)
    return F.date_format(local, "yyyy-MM-dd'T'HH:mm':00.000'")
