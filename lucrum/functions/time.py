"""Date and time functions (X1, X2, X8-X13) as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_date_of(text) -> Column:
    """Calendar date written in an ISO-8601 string.

    The date cast of the raw text keeps the writer's local date and ignores the
    offset, so ``2026-04-25T23:30-04:00`` gives 2026-04-25 although the instant
    falls on 04-26 in UTC. Applied to a timestamp it gives the session-zone date.
    Malformed text gives null.
    """
    return _c(text).try_cast("date")


def month_start(d) -> Column:
    """First day of the month of a date or timestamp: one sortable key that is
    equivalent to equality on YEAR() and MONTH() (X2)."""
    return F.trunc(_c(d).cast("date"), "month")


def wall_clock(ts, zone: str, of: str = "UTC") -> Column:
    """The wall clock in ``zone`` when it is ``ts`` in ``of`` (X13): timestamp_ntz to
    timestamp_ntz, whatever the session's time zone."""
    return F.convert_timezone(F.lit(of), F.lit(zone), _c(ts))


def parse_instant(text) -> Column:
    """ISO-8601 text, with ``Z`` or an offset, to an instant.

    Malformed text gives null rather than an error."""
    return F.try_to_timestamp(_c(text))


# Formats used for file names and window labels.
DAY_STAMP = "yyyyMMdd"
WINDOW_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"


def format_ts(ts, fmt: str = WINDOW_STAMP) -> Column:
    """Format an instant."""
    return F.date_format(_c(ts), fmt)


def day_floor(ts) -> Column:
    """Truncate to midnight."""
    return F.date_trunc("DAY", _c(ts))


def plus_days(ts, days) -> Column:
    """``ts + days`` (X11); ``days`` may be a column or an int."""
    d = days if isinstance(days, Column) else F.lit(int(days))
    return _c(ts) + F.make_dt_interval(d)


def earliest(a, b) -> Column:
    """``min(a, b)`` of two instants."""
    return F.least(_c(a), _c(b))


def default(x, fallback) -> Column:
    """Value or a default when absent."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(_c(x), fb)
