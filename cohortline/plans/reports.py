"""The reports (R1-R9), composed from the operators.

Each function returns a lazy DataFrame; nothing runs until the caller acts
on it. The shuffles of each report are listed in README ("Designed for
scale") and visible in ``docs/plans/``; the planner broadcasts a dimension
(channel, calendar) below its size threshold and shuffles it beyond.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.dates import day_of
from cohortline.functions.keys import bare_policy_id, prefixed_policy_id, strip_prefix, visit_id, visitor_id
from cohortline.functions.lifecycle import with_lifecycle_flags
from cohortline.operators.cohorts import (
    cohort_changes, cohort_counts, cohort_counts_asof, cohort_rates, cohort_rates_asof,
)
from cohortline.operators.dedup import first_hit
from cohortline.operators.hits import (
    CAR_HOME_PAGES, PURCHASE_PAGES, first_visit, purchase_hits, with_custom_channel, with_default_channel,
    with_visit,
)
from cohortline.operators.keyfilter import keep_keys
from cohortline.operators.load import replace_window
from cohortline.operators.policies import attribute, in_scope, policy_base, with_fiscal_week
from cohortline.operators.reconcile import reconcile
from cohortline.sources.schemas import VISIT_DAY
from cohortline.sources.tables import Inputs

POLICY_ORDER_COLUMNS = (
    "date_time", "product", "pid", "adobe_id", "visitor_id", "visit_num", "visit_referrer",
    "utm_param", "default_channel", "default_channel_detail", "custom_channel", "device_type",
    "os_type", "os_version",
)

# Tiebreaks that make every first-hit order total: hit id, then the rows that
# a hit fanned out to (visit attributes, channel).
HIT_TIEBREAK = ("event_id",)
CHANNEL_TIEBREAK = ("event_id", "channel_name")
VISIT_TIEBREAK = ("event_id", "os_version", "device_type", "os_type", "default_channel")


# --- R1 / R2: policy orders ---------------------------------------------------

#: Windows of up to so many days have their visits filtered by the hits' visit ids.
PRUNE_DAYS = 62


def window_visits(inputs: Inputs, hits: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """The visits that hits of ``[lo, hi]`` (with ``visitor_id`` and ``visit_num``) can belong to.

    All of them and few others: where the visits have a day partition, only its days from
    ``inputs.visit_lookback`` days before the window are read, and with ``inputs.prune_visits`` those with
    another id are dropped by a bitmap of the hits' visit ids, before anything is shuffled.
    """
    visits = inputs.visits
    if VISIT_DAY in visits.columns:
        day, first = F.col(VISIT_DAY), lo - dt.timedelta(days=inputs.visit_lookback)
        visits = visits.where(day.between(F.lit(first), F.lit(hi)) | day.isNull())
    if inputs.prune_visits and (hi - lo).days < PRUNE_DAYS:
        ids = hits.select(visit_id(F.col("visitor_id"), "visit_num").alias("__id"))
        visits = keep_keys(visits, "visit_id", ids, "__id")
    return visits


def policy_orders(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    """One attributed row per policy id purchased in ``[lo, hi]``.

    Shuffles: hits and visits on the visit key (left join; the visits are
    reduced to their earliest row per id on the way, with the join's own
    partitioning), then the join output on ``pid`` (first hit, with a partial
    per-key limit before it).
    """
    h = with_default_channel(purchase_hits(inputs.hits, lo, hi), inputs.marketing_channel)
    a = h.select(
        "event_id", "date_time",
        F.lower("evar7").alias("product"),
        prefixed_policy_id("evar7", "post_evar61").alias("pid"),
        F.col("mcvisid").alias("adobe_id"),
        visitor_id("post_visid_high", "post_visid_low").alias("visitor_id"),
        "visit_num", "visit_referrer",
        F.col("post_evar46").alias("utm_param"),
        "default_channel",
        F.col("va_closer_detail").alias("default_channel_detail"),
    )
    # The ids are taken from the hits alone, without their channels.
    ids = purchase_hits(inputs.hits, lo, hi).select(visitor_id("post_visid_high", "post_visid_low").alias("visitor_id"), "visit_num")
    visits = first_visit(window_visits(inputs, ids, lo, hi))
    a = with_visit(a, visits, visitor="visitor_id", spread_nulls_by=["event_id"])
    a = with_custom_channel(a)
    a = first_hit(a, ["pid"], ["date_time", "start_time"], VISIT_TIEBREAK)
    return a.select(*POLICY_ORDER_COLUMNS)


def daily_refresh(inputs: Inputs, target: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """The stored policy orders after the daily run: window replaced."""
    return replace_window(target, policy_orders(inputs, lo, hi), "date_time", lo, hi)


# --- shared: first purchase hit per raw policy id ------------------------------

def first_purchase_hits(inputs: Inputs, lo: dt.date, hi: dt.date,
                        pages: Sequence[str] = PURCHASE_PAGES,
                        calendar_days: bool = False, channel: bool = True) -> DataFrame:
    """Purchase hits with their default channel, first hit per raw ``evar61``.

    The dedup key is the raw id while the filter is on the persisted one, so
    all hits without a raw id collapse into one row (kept as upstream). With
    ``calendar_days`` the hit day must also be a calendar day of the window.
    Without ``channel`` the channel dimension is not joined and the channel
    name is null (a report that does not show it skips the join).
    """
    h = purchase_hits(inputs.hits, lo, hi, pages)
    if calendar_days:
        h = with_fiscal_week(h.withColumn("__day", day_of("date_time")), inputs.calendar,
                             "__day", lo, hi, week_col=None).drop("__day")
    if channel:
        h = with_default_channel(h, inputs.marketing_channel, out="channel_name")
    else:
        h = h.withColumn("channel_name", F.lit(None).cast("string"))
    h = first_hit(h, ["evar61"], ["date_time"], CHANNEL_TIEBREAK)
    return h.select(
        F.lower("evar7").alias("product"),
        F.col("post_evar61").alias("policy_id"),
        F.col("mcvisid").alias("adobe_id"),
        "date_time", "visit_num", "channel_name",
        F.col("va_closer_detail").alias("channel_detail"),
        "visit_referrer",
        F.col("post_evar46").alias("utm_param"),
        "pagename", "event_id", "evar61",
    )


# --- R3 / R4: purchases by channel -------------------------------------------

def purchases_by_default_channel(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    return (first_purchase_hits(inputs, lo, hi)
            .groupBy("product", "channel_name")
            .agg(F.count(F.lit(1)).alias("purchase_cnt")))


def channel_assignment(hits: DataFrame) -> DataFrame:
    """First purchase hits with their custom channel."""
    return with_custom_channel(hits, channel="channel_name")


def purchases_by_custom_channel(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    return (channel_assignment(first_purchase_hits(inputs, lo, hi))
            .groupBy("product", "custom_channel")
            .agg(F.count(F.lit(1)).alias("purchase_cnt")))


# --- R5: reconciliation ------------------------------------------------------

def bq_policies(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    """Distinct (product, bare pid) of in-scope policies purchased in the window."""
    p = inputs.policies.where(F.col("policy_purchase_date").between(F.lit(lo), F.lit(hi))
                              & in_scope("car_home_retail_travel"))
    return p.select(bare_policy_id("source_product", "policy_identifier").alias("pid"),
                    F.lower("source_product").alias("product")).distinct()


def callcentre_policies(inputs: Inputs) -> DataFrame:
    """Both call-centre lists, bare ids, duplicates kept (union all)."""
    car = inputs.callcentre_car.select(F.lit("car").alias("product"),
                                       strip_prefix("policy_id").alias("pid"))
    home = inputs.callcentre_home.select(F.lit("home").alias("product"),
                                         strip_prefix("policy_id").alias("pid"))
    return car.unionByName(home)


def web_policies(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    """(bare pid, product) of the first purchase hits."""
    return first_purchase_hits(inputs, lo, hi, channel=False).select(F.col("policy_id").alias("pid"), "product")


def reconciliation(inputs: Inputs, lo: dt.date, hi: dt.date) -> DataFrame:
    """Policy-master purchases vs web purchases, by product. The call-centre
    list is matched on pid alone, as upstream."""
    return reconcile(bq_policies(inputs, lo, hi), web_policies(inputs, lo, hi),
                     callcentre_policies(inputs), on=("pid", "product"), member_on="pid",
                     left_distinct=True)


# --- R6 / R9: scheduled retention (policy master x stored policy orders) -----

def scheduled_retention_base(inputs: Inputs, orders: DataFrame, start: dt.date,
                             end: dt.date) -> DataFrame:
    """CAR/HOME policies started in ``[start, end]`` joined to their policy
    order on the prefixed identifier, with lifecycle flags as of ``end``."""
    p = inputs.policies.where(F.col("start_date_est").between(F.lit(start), F.lit(end))
                              & in_scope("car_home"))
    o = orders.select("pid", "utm_param", "custom_channel", "default_channel",
                      "default_channel_detail")
    joined = attribute(policy_base(p), o, on=[("policy_identifier", "pid")])
    return with_lifecycle_flags(joined, end)


def retention_monthly(inputs: Inputs, orders: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return cohort_rates(scheduled_retention_base(inputs, orders, start, end),
                        ["product", "start_month", "custom_channel"])


def retention_dashboard(inputs: Inputs, orders: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return cohort_counts(scheduled_retention_base(inputs, orders, start, end),
                         DASHBOARD_KEYS)


DASHBOARD_KEYS = ("product", "purchase_month", "start_month", "utm_param", "custom_channel", "default_channel")


def scheduled_changes(inputs: Inputs, orders: DataFrame, start: dt.date, last: dt.date, keys: Sequence[str]) -> DataFrame:
    """Dated changes of the scheduled retention cohorts for any report end from ``start`` to ``last``.

    A policy counts from its start date on, as the reports' window ends with the report end.
    """
    p = inputs.policies.where(F.col("start_date_est").between(F.lit(start), F.lit(last)) & in_scope("car_home"))
    o = orders.select("pid", "utm_param", "custom_channel", "default_channel", "default_channel_detail")
    joined = attribute(policy_base(p), o, on=[("policy_identifier", "pid")])
    return cohort_changes(joined, keys, entry=F.col("start_date"))


def retention_monthly_asof(inputs: Inputs, orders: DataFrame, start: dt.date, ends: Sequence[dt.date]) -> DataFrame:
    """``retention_monthly`` for every report end, from one scan of the policies and the orders."""
    keys = ["product", "start_month", "custom_channel"]
    return cohort_rates_asof(scheduled_changes(inputs, orders, start, max(ends), keys), keys, ends)


def retention_dashboard_asof(inputs: Inputs, orders: DataFrame, start: dt.date, ends: Sequence[dt.date]) -> DataFrame:
    """``retention_dashboard`` for every report end, from one scan of the policies and the orders."""
    return cohort_counts_asof(scheduled_changes(inputs, orders, start, max(ends), DASHBOARD_KEYS), DASHBOARD_KEYS, ends)


# --- R7 / R8: manual retention (policy master x first web hit) ---------------

def manual_retention_base(inputs: Inputs, start: dt.date, end: dt.date) -> DataFrame:
    """Retail CAR/HOME policies purchased on a calendar day of the window,
    with flags as of ``end``, joined on (bare pid, product) to the first
    purchase hit (car/home pages) with its custom channel."""
    p = with_fiscal_week(inputs.policies.where(in_scope("car_home_retail")), inputs.calendar,
                         "policy_purchase_date", start, end, week_col="purchase_week")
    b = with_lifecycle_flags(policy_base(p, bare_pid=True, extra=[F.col("purchase_week")]), end)
    g = channel_assignment(first_purchase_hits(inputs, start, end, CAR_HOME_PAGES,
                                               calendar_days=True))
    g = g.select("product", F.col("policy_id").alias("pid"), "custom_channel")
    return b.join(g, ["pid", "product"], "inner")


def retention_weekly(inputs: Inputs, start: dt.date, end: dt.date) -> DataFrame:
    return cohort_rates(manual_retention_base(inputs, start, end),
                        ["product", "purchase_week", "custom_channel"])


def retention_monthly_manual(inputs: Inputs, start: dt.date, end: dt.date) -> DataFrame:
    return cohort_rates(manual_retention_base(inputs, start, end),
                        ["product", "purchase_month", "custom_channel"])
