"""Right-censored policy lifecycle flags (U13-U18).

Every flag is three-valued: 1, 0, or null when the outcome is not yet
observable at ``report_end``. ``sum(flag)`` counts events and
``count(flag)`` counts the observable base, so a flag must never be
coalesced to 0.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.dates import first_renewal_date, open_end, plus_days

# Mid-term cancellation horizons in days.
MTC_HORIZONS = (30, 60, 90)

# Output flag names, in report order.
FLAG_COLUMNS = ("coolingoff_cancelled", "mtc_30d", "mtc_60d", "mtc_90d", "renewed", "retained")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(cond: Column) -> Column:
    """``if(cond, 1, 0)``: an unknown condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def cancelled_within(start: Column | str, end: Column | str, report_end: Column,
                     days: Column | int) -> Column:
    """1 if the policy ended within ``days`` of its start, 0 if not; null
    while fewer than ``days`` days have passed since the start."""
    start, end = _c(start), _c(end)
    days = F.lit(days) if isinstance(days, int) else days
    observable = F.datediff(report_end, start) >= days
    return F.when(observable, _flag(F.datediff(end, start) <= days))


def renewed(end: Column | str, first_renewal: Column | str, renewal_plus_cooloff: Column | str,
            report_end: Column) -> Column:
    """1 if the policy is still in force after the first renewal's cooling-off
    period; observable once that period is over and only for policies that
    reached the renewal date."""
    end, fr, frp = _c(end), _c(first_renewal), _c(renewal_plus_cooloff)
    return F.when((report_end > frp) & (end >= fr), _flag(end > frp))


def retained(end: Column | str, renewal_plus_cooloff: Column | str, report_end: Column) -> Column:
    """Like ``renewed`` without the "reached the renewal date" condition."""
    end, frp = _c(end), _c(renewal_plus_cooloff)
    return F.when(report_end > frp, _flag(end > frp))


@lru_cache(maxsize=64)
def lifecycle_columns(report_end: dt.date, start: str, end: str, renewal: str,
                      cooloff: str) -> tuple[tuple[str, Column], ...]:
    """(name, Column) pairs added by ``with_lifecycle_flags``, built once per
    argument set (Columns are unresolved expressions, reusable by any plan)."""
    asof = F.lit(report_end)
    fr = first_renewal_date(start, renewal)
    frp = plus_days(fr, cooloff)
    cols = [("first_renewal_date", fr), ("first_renewal_date_plus_coolingoff", frp),
            ("coolingoff_cancelled", cancelled_within(start, end, asof, F.col(cooloff)))]
    for days in MTC_HORIZONS:
        cols.append((f"mtc_{days}d", cancelled_within(start, end, asof, days)))
    cols.append(("renewed", renewed(end, "first_renewal_date", "first_renewal_date_plus_coolingoff", asof)))
    cols.append(("retained", retained(end, "first_renewal_date_plus_coolingoff", asof)))
    return tuple(cols)


def with_lifecycle_flags(df: DataFrame, report_end: dt.date, *, start: str = "start_date",
                         end: str = "end_date", renewal: str = "recorded_renewal_date",
                         cooloff: str = "coolingoff_days") -> DataFrame:
    """Add ``first_renewal_date``, ``first_renewal_date_plus_coolingoff`` and
    the six flags. ``end`` must already be open-ended (see ``open_end``)."""
    cols = lifecycle_columns(report_end, start, end, renewal, cooloff)
    df = df.withColumns(dict(cols[:2]))
    return df.withColumns(dict(cols[2:]))


def dated_outcomes(start: str = "start_date", end: str = "end_date", renewal: str = "recorded_renewal_date",
                   cooloff: str = "coolingoff_days") -> list[tuple[str, Column, Column]]:
    """Per flag of FLAG_COLUMNS: (name, first report day on which it is known, its value from then on).

    A policy's dates settle every flag once and for all: it is null on report days before its day and has
    one value after. A null day is a flag that never becomes known.
    """
    s, e = F.col(start), F.col(end)
    fr = first_renewal_date(start, renewal)
    over = plus_days(fr, cooloff)

    def within(days: Column) -> tuple[Column, Column]:
        return plus_days(s, days), _flag(F.datediff(e, s) <= days)

    out = [("coolingoff_cancelled", *within(F.col(cooloff)))]
    out += [(f"mtc_{days}d", *within(F.lit(days))) for days in MTC_HORIZONS]
    settled = F.date_add(over, 1)
    out.append(("renewed", F.when(e >= fr, settled), _flag(e > over)))
    out.append(("retained", settled, _flag(e > over)))
    return out


__all__ = [
    "FLAG_COLUMNS", "MTC_HORIZONS", "cancelled_within", "dated_outcomes", "open_end", "renewed", "retained",
    "with_lifecycle_flags",
]
