"""Report windows and policy date arithmetic (U10-U12, U25, U27).

Window helpers work on Python dates at the job boundary, so plans receive
literals that Catalyst folds and pushes into the scan. Column helpers are
plain built-ins and stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline.functions.memo import column_memo

# Fixed value: end date standing for "still in force".
OPEN_END = dt.date(2099, 12, 31)

# Fixed value: zone whose calendar day the scheduled jobs run on.
REPORT_ZONE = "Australia/Sydney"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- windows (Python, at the boundary) -------------------------------------

def today_in(zone: str = REPORT_ZONE, now: dt.datetime | None = None) -> dt.date:
    """Calendar date in ``zone`` at ``now`` (default: the current instant)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    return now.astimezone(ZoneInfo(zone)).date()


def rolling_days(today: dt.date, back: int = 8, until: int = 1) -> tuple[dt.date, dt.date]:
    """Inclusive window ``[today - back, today - until]``."""
    return today - dt.timedelta(days=back), today - dt.timedelta(days=until)


def until_yesterday(start: dt.date, today: dt.date) -> tuple[dt.date, dt.date]:
    return start, today - dt.timedelta(days=1)


def last_month_end(today: dt.date) -> dt.date:
    return today.replace(day=1) - dt.timedelta(days=1)


def until_last_month_end(start: dt.date, today: dt.date) -> tuple[dt.date, dt.date]:
    return start, last_month_end(today)


def month_ends(start: dt.date, end: dt.date) -> list[dt.date]:
    """The last days of all months that end in ``[start, end]``."""
    out, month = [], start.replace(day=1)
    while True:
        month = (month + dt.timedelta(days=31)).replace(day=1)
        if month - dt.timedelta(days=1) > end:
            return out
        out.append(month - dt.timedelta(days=1))


# --- columns ----------------------------------------------------------------

@column_memo
def day_of(ts: Column | str) -> Column:
    return F.to_date(_c(ts))


def day_in_zone(ts: Column | str, zone: str = REPORT_ZONE) -> Column:
    """Calendar day in ``zone`` of a zone-less timestamp recorded in UTC.

    ``convert_timezone`` works on the zone-less value directly, so the result
    does not depend on the session time zone.
    """
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts)))


@column_memo
def day_between(ts: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """``date(ts) between lo and hi`` (inclusive).

    Catalyst rewrites this into ``ts >= lo and ts < hi + 1 day`` and pushes
    the range to the Parquet reader (row-group skipping); see the plan tests.
    """
    return F.to_date(_c(ts)).between(F.lit(lo), F.lit(hi))


@column_memo
def month_start(d: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_c(d), "MM")


@column_memo
def week_start(d: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(_c(d), "week")


@column_memo
def first_renewal_date(start: Column | str, renewal: Column | str) -> Column:
    """Recorded renewal moved to the year after the start year.

    ``renewal + (year(start) - year(renewal) + 1) years``; a Feb 29 result
    clamps to Feb 28. Only years move, so a start on Dec 31 with a renewal
    recorded on Jan 1 gives a "first renewal" one day after the start, as
    upstream does.
    """
    start, renewal = _c(start), _c(renewal)
    return F.add_months(renewal, (F.year(start) - F.year(renewal) + 1) * 12)


@column_memo
def plus_days(d: Column | str, days: Column | str) -> Column:
    """``d + days``; a bigint day count is narrowed to int first."""
    return F.date_add(_c(d), _c(days).cast("int"))


@column_memo
def open_end(end: Column | str, sentinel: dt.date = OPEN_END) -> Column:
    """Null end date -> the "in force" sentinel."""
    return F.coalesce(_c(end), F.lit(sentinel))
