"""Policy-side operators: product scope (U28), lifecycle base (U10-U12,
U27), fiscal week (U26) and policy-to-order attribution (U29)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.dates import month_start, open_end
from cohortline.functions.keys import bare_policy_id
from cohortline.functions.lifecycle import with_lifecycle_flags
from cohortline.functions.memo import column_memo

# Home subtypes counted as retail home policies.
RETAIL_HOME_SUBTYPES = ("Combined Home & Contents", "Content Only Cover", "Home Only Cover")


@column_memo
def in_scope(kind: str) -> Column:
    """Product scope predicate over ``source_product`` / ``product_subtype``.

    ``car_home``: CAR or HOME. ``car_home_retail``: CAR, or HOME with a
    retail subtype. ``car_home_retail_travel``: the latter or TRAVEL.
    """
    product, subtype = F.col("source_product"), F.col("product_subtype")
    retail = (product == "CAR") | ((product == "HOME") & subtype.isin(*RETAIL_HOME_SUBTYPES))
    if kind == "car_home":
        return product.isin("CAR", "HOME")
    if kind == "car_home_retail":
        return retail
    if kind == "car_home_retail_travel":
        return retail | (product == "TRAVEL")
    raise ValueError(f"unknown scope {kind!r}")


def policy_base(policies: DataFrame, *, bare_pid: bool = False,
                extra: Sequence[Column] = ()) -> DataFrame:
    """Policy columns the retention reports use, with an open-ended end date
    and month buckets. ``bare_pid`` adds ``pid`` without the product prefix."""
    cols = [
        F.lower("source_product").alias("product"),
        F.col("policy_identifier"),
        F.col("purchase_date_est").alias("purchase_date"),
        month_start("purchase_date_est").alias("purchase_month"),
        F.col("start_date_est").alias("start_date"),
        month_start("start_date_est").alias("start_month"),
        open_end("end_date_est").alias("end_date"),
        F.col("renewal_date_est").alias("recorded_renewal_date"),
        F.col("cooling_off_days").alias("coolingoff_days"),
    ]
    if bare_pid:
        cols.append(bare_policy_id("source_product", "policy_identifier").alias("pid"))
    return policies.select(*cols, *extra)


def policies_with_flags(policies: DataFrame, report_end: dt.date, **kw) -> DataFrame:
    return with_lifecycle_flags(policy_base(policies, **kw), report_end)


def with_fiscal_week(df: DataFrame, calendar_dim: DataFrame, day_col: str,
                     lo: dt.date, hi: dt.date, week_col: str | None = "purchase_week") -> DataFrame:
    """Inner-join calendar days in ``[lo, hi]`` on ``day_col``.

    Keeps only rows whose day is a calendar day of the window; adds the
    fiscal week start as ``week_col`` when given. The planner broadcasts the
    calendar below its size threshold.
    """
    cal = calendar_dim.where(F.col("calendar_day").between(F.lit(lo), F.lit(hi)))
    cols = [F.col("calendar_day").alias("__cal_day")]
    if week_col:
        cols.append(F.col("fiscal_week_start").alias(week_col))
    cal = cal.select(*cols)
    return df.join(cal, F.col(day_col) == F.col("__cal_day"), "inner").drop("__cal_day")


def attribute(policies: DataFrame, orders: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join policies to attributed orders on ``[(policy_col, order_col)]``.

    Both sides grow with the data, so the join shuffles on the key; AQE turns
    it into a broadcast join at runtime if one side turns out small.
    """
    cond = None
    for pc, oc in on:
        c = policies[pc] == orders[oc]
        cond = c if cond is None else (cond & c)
    return policies.join(orders, cond, "inner")
