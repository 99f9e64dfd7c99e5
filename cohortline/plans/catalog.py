"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver tables through ``test_inputs`` (adapter views
over ``events`` and ``orders``) and runs over them whole. Operator-level
keys exercise one operator each; report keys run a full report.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.dates import (
    REPORT_ZONE, day_in_zone, first_renewal_date, last_month_end, month_start, plus_days, rolling_days, today_in,
    until_last_month_end, until_yesterday,
)
from cohortline.functions.keys import bare_policy_id, prefixed_policy_id, visit_id, visitor_id
from cohortline.functions.urls import url_host
from cohortline.operators.cohorts import cohort_changes, cohort_counts, cohort_rates, cohort_rates_asof
from cohortline.operators.dedup import first_hit
from cohortline.operators.hits import purchase_hits, with_custom_channel, with_default_channel, with_visit
from cohortline.operators.load import dedup_target, full_refresh, publish_window
from cohortline.operators.policies import (
    attribute, in_scope, policies_with_flags, policy_base, with_fiscal_week,
)
from cohortline.operators.ranking import write_ordered
from cohortline.operators.reconcile import matched, unmatched
from cohortline.plans import jobs
from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.session import checkpoint_dir
from cohortline.sources.tables import Inputs, test_inputs

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return test_inputs(spark, sf_dir)


# --- operator-level queries -----------------------------------------------------

def q_first_hit(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    h = purchase_hits(i.hits, *P.PURCHASE_WINDOW)
    h = first_hit(h, ["post_evar61"], ["date_time"], R.HIT_TIEBREAK)
    return h.select("event_id", "date_time", F.lower("evar7").alias("product"),
                    F.col("post_evar61").alias("policy_id"))


def q_first_hit_raw_key(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return R.first_purchase_hits(i, *P.PURCHASE_WINDOW).select(
        "event_id", "date_time", "product", "policy_id", F.col("evar61").alias("raw_policy_id"))


def q_purchase_hits(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return purchase_hits(i.hits, *P.PURCHASE_WINDOW).select(
        "event_id", "date_time", "evar7", "post_evar61", "pagename")


def q_default_channel(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return with_default_channel(i.hits, i.marketing_channel).select(
        "event_id", "va_closer_id", "default_channel")


def q_custom_channel(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    h = with_default_channel(i.hits, i.marketing_channel).withColumnRenamed("post_evar46", "utm_param")
    return with_custom_channel(h).select(
        "event_id", "visit_referrer", "utm_param", "default_channel", "custom_channel")


def q_url_host(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return i.hits.select("event_id", "visit_referrer", url_host("visit_referrer").alias("referrer_host"))


def q_policy_key_prefix(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return i.hits.select("event_id", "evar7", "post_evar61",
                         prefixed_policy_id("evar7", "post_evar61").alias("pid"))


def q_policy_key_strip(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return i.policies.select("policy_identifier", "source_product",
                             bare_policy_id("source_product", "policy_identifier").alias("pid"))


def q_visit_key(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    v = visitor_id("post_visid_high", "post_visid_low")
    return i.hits.select("event_id", v.alias("visitor_id"), visit_id(v, "visit_num").alias("visit_id"))


def q_visit_enrichment(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    v = visitor_id("post_visid_high", "post_visid_low")
    h = i.hits.select("event_id", "post_visid_high", "post_visid_low", "visit_num",
                      visit_id(v, "visit_num").alias("visit_id"))
    return with_visit(h, i.visits, spread_nulls_by=["event_id"]).select(
        "event_id", "visit_id", "device_type", "os_type", "os_version", "start_time")


def q_first_renewal(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    p = i.policies.select(
        "policy_identifier",
        F.col("start_date_est").alias("start_date"),
        F.col("renewal_date_est").alias("recorded_renewal_date"),
        first_renewal_date("start_date_est", "renewal_date_est").alias("first_renewal_date"),
        "cooling_off_days",
    )
    return p.select("policy_identifier", "start_date", "recorded_renewal_date", "first_renewal_date",
                    plus_days("first_renewal_date", "cooling_off_days")
                    .alias("first_renewal_date_plus_coolingoff"))


def _all_flags(i: Inputs) -> DataFrame:
    return policies_with_flags(i.policies, P.LIFECYCLE_REPORT_END)


def q_lifecycle_flags(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return _all_flags(i).select("policy_identifier", "product", "start_date", "end_date",
                                "coolingoff_cancelled", "mtc_30d", "mtc_60d", "mtc_90d",
                                "renewed", "retained")


def q_cohort_rates(spark, sf_dir):
    return cohort_rates(_all_flags(_inputs(spark, sf_dir)), ["product", "start_month"])


def q_cohort_rates_asof(spark, sf_dir):
    """The cohort rates of every month end, from one scan of the policies."""
    keys = ["product", "start_month"]
    changes = cohort_changes(policy_base(_inputs(spark, sf_dir).policies), keys)
    return cohort_rates_asof(changes, keys, P.ASOF_ENDS)


def q_retention_monthly_asof(spark, sf_dir):
    """The scheduled retention report as of every month end."""
    i = _inputs(spark, sf_dir)
    return R.retention_monthly_asof(i, R.policy_orders(i, *P.BACKFILL_WINDOW), P.RETENTION_START, P.ASOF_ENDS)


def q_dashboard_asof(spark, sf_dir):
    """The dashboard as of every month end."""
    i = _inputs(spark, sf_dir)
    return R.retention_dashboard_asof(i, R.policy_orders(i, *P.BACKFILL_WINDOW), P.RETENTION_START, P.ASOF_ENDS)


def q_cohort_counts_by_product(spark, sf_dir):
    return cohort_counts(_all_flags(_inputs(spark, sf_dir)), ["product"])


def q_replace_window(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    target = R.policy_orders(i, *P.BACKFILL_WINDOW)
    return R.daily_refresh(i, target, *P.DAILY_WINDOW)


def q_report_windows(spark, sf_dir):
    """Calendar days with their membership in the jobs' windows at a fixed instant."""
    i = _inputs(spark, sf_dir)
    today = today_in(REPORT_ZONE, P.WINDOWS_INSTANT)
    d = F.col("calendar_day")
    windows = {"rolling": rolling_days(today), "to_yesterday": until_yesterday(P.WINDOWS_START, today),
               "to_month_end": until_last_month_end(dt.date(2023, 12, 30), today + dt.timedelta(days=10))}
    return i.calendar.select(
        d, F.lit(today).alias("today"), F.lit(last_month_end(today)).alias("month_end"),
        day_in_zone(d.cast("timestamp_ntz") + F.expr("interval 13 hours")).alias("day_in_zone"),
        month_start(d).alias("month_start"), F.col("fiscal_week_start").alias("week_start"),
        *[d.between(F.lit(lo), F.lit(hi)).alias(f"in_{name}") for name, (lo, hi) in windows.items()])


def _rows_of(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a stored table's files (a few per day), after its entry is dropped."""
    stored = spark.table(table).drop(jobs.DAY_PARTITION)
    files = stored.inputFiles()
    rows = spark.read.schema(stored.schema).parquet(*files) if files else spark.createDataFrame([], stored.schema)
    spark.sql(f"DROP TABLE {table}")
    return rows


def q_publish_window(spark, sf_dir):
    """A stored table after the backfill and a daily window load."""
    i = _inputs(spark, sf_dir)
    name = f"policy_orders_{uuid.uuid4().hex}"
    jobs.backfill_policy_orders(i, name, *P.BACKFILL_WINDOW, path=f"{checkpoint_dir(spark)}/tables/{name}")
    jobs.daily_policy_orders(i, name, today=P.DAILY_TODAY)
    return _rows_of(spark, name)


def q_publish_once(spark, sf_dir):
    """A stored table loaded window by window, the later one first, that keeps each policy on its earliest day."""
    i = _inputs(spark, sf_dir)
    name = f"policy_orders_{uuid.uuid4().hex}"
    (lo, _), (first, last) = P.DAILY_WINDOW, P.PURCHASE_WINDOW
    jobs.backfill_policy_orders(i, name, lo, last, path=f"{checkpoint_dir(spark)}/tables/{name}")
    for start, end in ((first, lo - dt.timedelta(days=1)), (lo, last)):
        publish_window(R.policy_orders(i, start, end), name, "date_time", start, end, jobs.DAY_PARTITION, once_by="pid")
    return _rows_of(spark, name)


def q_dedup_target(spark, sf_dir):
    """Stored policy orders of two windows, loaded one after the other, each policy once."""
    i = _inputs(spark, sf_dir)
    (lo, hi), (_, end) = P.DAILY_WINDOW, P.PURCHASE_WINDOW
    first = R.policy_orders(i, P.PURCHASE_WINDOW[0], lo - dt.timedelta(days=1))
    stored = R.daily_refresh(i, first, lo, end)
    return dedup_target(stored, ["pid"], "date_time", list(R.POLICY_ORDER_COLUMNS[1:]))


def q_report_ordered(spark, sf_dir):
    """A report in presentation order, with each row's place in it."""
    i = _inputs(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/tables/ordered/{uuid.uuid4().hex}"
    placed = write_ordered(R.purchases_by_custom_channel(i, *P.PURCHASE_WINDOW), path, ["product", "custom_channel"])
    return placed.withColumn("place", F.col("place").cast("int"))


def q_fiscal_week(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    p = with_fiscal_week(i.policies, i.calendar, "policy_purchase_date", *P.WEEKLY_WINDOW)
    return p.select("policy_identifier", "policy_purchase_date", "purchase_week")


def q_month_bucket(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return i.policies.select("policy_identifier",
                             month_start("purchase_date_est").alias("purchase_month"),
                             month_start("start_date_est").alias("start_month"))


def q_product_scope(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    cols = {f"in_{k}": F.coalesce(in_scope(k), F.lit(False))
            for k in ("car_home", "car_home_retail", "car_home_retail_travel")}
    return i.policies.select("policy_identifier", "source_product", "product_subtype",
                             *[c.alias(n) for n, c in cols.items()])


def q_policy_attribution(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    orders = R.policy_orders(i, *P.BACKFILL_WINDOW).select(
        "pid", "utm_param", "custom_channel", "default_channel")
    j = attribute(policy_base(i.policies), orders, on=[("policy_identifier", "pid")])
    return j.select("policy_identifier", "product", "start_date", "utm_param", "custom_channel",
                    "default_channel")


def q_distinct_policies(spark, sf_dir):
    return R.bq_policies(_inputs(spark, sf_dir), *P.PURCHASE_WINDOW)


def q_callcentre_union(spark, sf_dir):
    return R.callcentre_policies(_inputs(spark, sf_dir))


def q_recon_semi(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return matched(R.bq_policies(i, *P.PURCHASE_WINDOW), R.web_policies(i, *P.PURCHASE_WINDOW))


def q_recon_anti(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return unmatched(R.bq_policies(i, *P.PURCHASE_WINDOW), R.web_policies(i, *P.PURCHASE_WINDOW))


# --- report queries ---------------------------------------------------------------

def q_report_policy_orders(spark, sf_dir):
    return R.policy_orders(_inputs(spark, sf_dir), *P.DAILY_WINDOW)


def q_policy_orders_pruned(spark, sf_dir):
    """The daily window's policy orders from visits filtered by the window's visit ids."""
    i = dataclasses.replace(_inputs(spark, sf_dir), prune_visits=True)
    return R.policy_orders(i, *P.DAILY_WINDOW)


def q_policy_orders_backfill(spark, sf_dir):
    return R.policy_orders(_inputs(spark, sf_dir), *P.BACKFILL_WINDOW)


def q_report_purchases_default(spark, sf_dir):
    return R.purchases_by_default_channel(_inputs(spark, sf_dir), *P.PURCHASE_WINDOW)


def q_report_purchases_custom(spark, sf_dir):
    return R.purchases_by_custom_channel(_inputs(spark, sf_dir), *P.PURCHASE_WINDOW)


def q_report_reconcile(spark, sf_dir):
    return R.reconciliation(_inputs(spark, sf_dir), *P.PURCHASE_WINDOW)


def q_report_retention_monthly(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return R.retention_monthly(i, R.policy_orders(i, *P.BACKFILL_WINDOW), *P.SCHEDULED_WINDOW)


def q_report_retention_weekly(spark, sf_dir):
    return R.retention_weekly(_inputs(spark, sf_dir), *P.WEEKLY_WINDOW)


def q_report_retention_monthly_manual(spark, sf_dir):
    return R.retention_monthly_manual(_inputs(spark, sf_dir), *P.MONTHLY_MANUAL_WINDOW)


def q_report_dashboard(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return R.retention_dashboard(i, R.policy_orders(i, *P.BACKFILL_WINDOW), *P.DASHBOARD_WINDOW)


def q_dashboard_refresh(spark, sf_dir):
    """Full refresh (create or replace) of the dashboard pivot in shared storage.

    Each call writes its own folder, so a DataFrame returned by an earlier
    call keeps reading the files it listed (the scheduled job writes a named
    table instead: ``jobs.monthly_dashboard``).
    """
    path = f"{checkpoint_dir(spark)}/tables/retention_channel_pivot/{uuid.uuid4().hex}"
    return full_refresh(q_report_dashboard(spark, sf_dir), path=path)


QUERIES: dict[str, Query] = {
    "first_hit": q_first_hit,
    "first_hit_raw_key": q_first_hit_raw_key,
    "purchase_hits": q_purchase_hits,
    "default_channel": q_default_channel,
    "custom_channel": q_custom_channel,
    "url_host": q_url_host,
    "policy_key_prefix": q_policy_key_prefix,
    "policy_key_strip": q_policy_key_strip,
    "visit_key": q_visit_key,
    "visit_enrichment": q_visit_enrichment,
    "first_renewal": q_first_renewal,
    "lifecycle_flags": q_lifecycle_flags,
    "cohort_rates": q_cohort_rates,
    "cohort_counts_by_product": q_cohort_counts_by_product,
    "cohort_rates_asof": q_cohort_rates_asof,
    "retention_monthly_asof": q_retention_monthly_asof,
    "dashboard_asof": q_dashboard_asof,
    "replace_window": q_replace_window,
    "report_windows": q_report_windows,
    "publish_window": q_publish_window,
    "publish_once": q_publish_once,
    "dedup_target": q_dedup_target,
    "report_ordered": q_report_ordered,
    "fiscal_week": q_fiscal_week,
    "month_bucket": q_month_bucket,
    "product_scope": q_product_scope,
    "policy_attribution": q_policy_attribution,
    "distinct_policies": q_distinct_policies,
    "callcentre_union": q_callcentre_union,
    "recon_semi": q_recon_semi,
    "recon_anti": q_recon_anti,
    "report_policy_orders": q_report_policy_orders,
    "policy_orders_pruned": q_policy_orders_pruned,
    "policy_orders_backfill": q_policy_orders_backfill,
    "report_purchases_default": q_report_purchases_default,
    "report_purchases_custom": q_report_purchases_custom,
    "report_reconcile": q_report_reconcile,
    "report_retention_monthly": q_report_retention_monthly,
    "report_retention_weekly": q_report_retention_weekly,
    "report_retention_monthly_manual": q_report_retention_monthly_manual,
    "report_dashboard": q_report_dashboard,
    "dashboard_refresh": q_dashboard_refresh,
}
