"""Cohort aggregation over three-valued flags (U19-U21).

One pass, one shuffle: a hash aggregate with partial (map-side) and final
stages, so a hot cohort costs one partial row per map task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.lifecycle import dated_outcomes
from cohortline.functions.memo import column_memo

# Per flag, the output names of its base (observable count) and
# of its complement (base minus events), where the dashboard reports them.
BASE_NAMES = {
    "coolingoff_cancelled": "coolingoff_base",
    "mtc_30d": "mtc_30d_base",
    "mtc_60d": "mtc_60d_base",
    "mtc_90d": "mtc_90d_base",
    "renewed": "renewal_reached",
    "retained": "retention_base",
}
COMPLEMENT_NAMES = {"renewed": "lapsed", "retained": "churned"}
RATE_NAMES = {
    "coolingoff_cancelled": "coolingoff_cancel_rate",
    "mtc_30d": "mtc_30d_rate",
    "mtc_60d": "mtc_60d_rate",
    "mtc_90d": "mtc_90d_rate",
    "renewed": "renewal_rate",
    "retained": "retention_rate",
}
DEFAULT_FLAGS = tuple(BASE_NAMES)


@column_memo
def flag_sum(flag: str) -> Column:
    """Events: ``sum(flag)`` (null when no row is observable)."""
    return F.sum(F.col(flag))


@column_memo
def flag_base(flag: str) -> Column:
    """Observable base: ``count(flag)`` (non-null rows)."""
    return F.count(F.col(flag))


@column_memo
def flag_rate(flag: str) -> Column:
    """``sum / base`` as double; null for an empty base."""
    return F.try_divide(flag_sum(flag).cast("double"), flag_base(flag))


def cohort_counts(df: DataFrame, keys: Sequence[str], flags: Sequence[str] = DEFAULT_FLAGS,
                  count_name: str = "purchased") -> DataFrame:
    """Per group: row count, and per flag events, complement (where named)
    and base, in the dashboard's column order."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for f in flags:
        base = BASE_NAMES[f]
        if f in COMPLEMENT_NAMES:
            aggs += [flag_sum(f).alias(f),
                     (flag_base(f) - flag_sum(f)).alias(COMPLEMENT_NAMES[f]),
                     flag_base(f).alias(base)]
        else:
            aggs += [flag_sum(f).alias(f), flag_base(f).alias(base)]
    return df.groupBy(*keys).agg(*aggs)


def cohort_rates(df: DataFrame, keys: Sequence[str], flags: Sequence[str] = DEFAULT_FLAGS,
                 count_name: str = "purchase_cnt") -> DataFrame:
    """Per group: row count, per-flag event sums, then per-flag rates."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    aggs += [flag_sum(f).alias(f) for f in flags]
    aggs += [flag_rate(f).alias(RATE_NAMES[f]) for f in flags]
    return df.groupBy(*keys).agg(*aggs)


# --- many report days from one scan -----------------------------------------------

#: Stands for "before any report day".
ALWAYS = dt.date(1000, 1, 1)


def cohort_changes(df: DataFrame, keys: Sequence[str], entry: Column | None = None, **columns: str) -> DataFrame:
    """``(*keys, day, n, <flag>_base, <flag>_events)``: what a cohort's counts change by on each day.

    A policy is counted from the day ``entry`` (always, by default; never if null), and a flag of it from the
    later of that day and the first report day that knows the flag. The sums up to and with a
    day are the counts of a report of that day, so the table answers any report day and can be
    stored: a policy adds up to seven rows before the partial aggregate, cohorts x days rows after it.
    ``columns`` name the date columns, as in ``with_lifecycle_flags``; ``df`` needs no flags.
    """
    since = F.lit(ALWAYS) if entry is None else entry
    outcomes = dated_outcomes(**columns)
    changes = [F.struct(since.alias("day"), F.lit("").alias("flag"), F.lit(0).alias("event"))]
    changes += [F.struct(F.when(known.isNotNull() & since.isNotNull(), F.greatest(known, since)).alias("day"),
                         F.lit(name).alias("flag"), event.alias("event")) for name, known, event in outcomes]
    rows = df.select(*keys, F.inline(F.array(*changes))).where(F.col("day").isNotNull())
    aggs = [F.count(F.when(F.col("flag") == "", 1)).alias("n")]
    for name, *_ in outcomes:
        own = F.col("flag") == name
        aggs += [F.count(F.when(own, 1)).alias(f"{name}_base"),
                 F.coalesce(F.sum(F.when(own, F.col("event"))), F.lit(0)).alias(f"{name}_events")]
    return rows.groupBy(*keys, "day").agg(*aggs)


def counts_asof(changes: DataFrame, keys: Sequence[str], ends: Sequence[dt.date]) -> DataFrame:
    """``(*keys, report_end, n, <flag>_base, <flag>_events)`` for every report day of ``ends``.

    Prefix sums of :func:`cohort_changes`. A cohort appears from the first report day on
    that counts a policy of it. The changes of a cohort between two report days are one row before the window.
    """
    ends = sorted(set(ends))
    if not ends:
        raise ValueError("give at least one report day")
    measures = [c for c in changes.columns if c not in {*keys, "day"}]
    days = F.array(*(F.lit(e) for e in ends))
    at = F.size(F.filter(days, lambda e: e < F.col("day")))
    steps = (changes.withColumn("__at", at).where(F.col("__at") < len(ends))
             .groupBy(*keys, "__at").agg(*(F.sum(m).alias(m) for m in measures)))
    line = Window.partitionBy(*keys).orderBy("__at")
    until = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = steps.select(*keys, "__at", *(F.sum(m).over(until).alias(m) for m in measures),
                          F.coalesce(F.lead("__at").over(line), F.lit(len(ends))).alias("__next"))
    each = summed.withColumn("__at", F.explode(F.sequence("__at", F.col("__next") - 1)))
    return each.select(*keys, F.element_at(days, F.col("__at") + 1).alias("report_end"), *measures).where("n > 0")


def _known(flag: str, value: Column) -> Column:
    """A sum over no known flag is null, as ``sum`` of nulls is."""
    return F.when(F.col(f"{flag}_base") > 0, value)


def cohort_rates_asof(changes: DataFrame, keys: Sequence[str], ends: Sequence[dt.date],
                      flags: Sequence[str] = DEFAULT_FLAGS, count_name: str = "purchase_cnt") -> DataFrame:
    """``cohort_rates`` with a ``report_end`` column: one row per cohort and report day."""
    events = {f: F.col(f"{f}_events") for f in flags}
    return counts_asof(changes, keys, ends).select(
        *keys, "report_end", F.col("n").alias(count_name), *(_known(f, e).alias(f) for f, e in events.items()),
        *(_known(f, e.cast("double") / F.col(f"{f}_base")).alias(RATE_NAMES[f]) for f, e in events.items()))


def cohort_counts_asof(changes: DataFrame, keys: Sequence[str], ends: Sequence[dt.date],
                       flags: Sequence[str] = DEFAULT_FLAGS, count_name: str = "purchased") -> DataFrame:
    """``cohort_counts`` with a ``report_end`` column: one row per cohort and report day."""
    out = [F.col("n").alias(count_name)]
    for f in flags:
        events, base = F.col(f"{f}_events"), F.col(f"{f}_base")
        out.append(_known(f, events).alias(f))
        if f in COMPLEMENT_NAMES:
            out.append(_known(f, base - events).alias(COMPLEMENT_NAMES[f]))
        out.append(base.alias(BASE_NAMES[f]))
    return counts_asof(changes, keys, ends).select(*keys, "report_end", *out)
