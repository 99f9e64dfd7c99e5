"""The scheduled and once-off jobs: reports written to tables.

* ``backfill_policy_orders``: once-off create-or-replace of the policy-orders
  table over a fixed window, stored partitioned by hit day.
* ``daily_policy_orders``: the daily reload of the trailing 8 days
  ``[today - 8, today - 1]`` (today in the report zone): only those day
  partitions are rewritten, so late hits up to 8 days old are picked up.
* ``monthly_dashboard``: create-or-replace of the retention pivot from the
  stored policy orders, up to the end of last month.

"today" defaults to the current date in the report zone but is always an
argument, so reruns and tests are reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.dates import REPORT_ZONE, rolling_days, today_in, until_last_month_end
from cohortline.operators.load import bucket_rows, full_refresh, publish_window, replace_table
from cohortline.plans import reports as R
from cohortline.sources.tables import Inputs, check_hit_days

DAY_PARTITION = "hit_day"
DASHBOARD_START = dt.date(2024, 3, 1)


def backfill_policy_orders(inputs: Inputs, table: str, lo: dt.date, hi: dt.date,
                           buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Create or replace ``table`` with the policy orders of ``[lo, hi]``.

    Partitioned by hit day (the daily reload replaces day partitions). The rows
    are rebalanced by day before the write: a small day is one file, a large
    one is split at the advisory partition size, so the number of files follows
    the data and not the number of tasks. With ``buckets`` (chosen from the
    table's size) the table is also bucketed by ``pid``, one file per day and
    bucket, and a join on the policy id shuffles only the other side (or neither, see
    :func:`snapshot_policies`). ``path`` names the place of the table's files instead of the warehouse.
    A backfill that fails leaves the table as it was.
    """
    check_hit_days(inputs, lo, hi)
    rows = R.policy_orders(inputs, lo, hi).withColumn(DAY_PARTITION, F.to_date("date_time"))
    if buckets:
        rows = bucket_rows(rows, buckets, ["pid"], DAY_PARTITION)
    else:
        rows = rows.hint("rebalance", DAY_PARTITION)
    return replace_table(rows, table, DAY_PARTITION, buckets, ["pid"], path)


def snapshot_policies(inputs: Inputs, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Create or replace ``table`` with the policy master, bucketed by its identifier.

    Joined to policy orders that a backfill stored in as many buckets, neither side is
    shuffled: pass the returned table as the ``policies`` of the inputs.
    """
    rows = bucket_rows(inputs.policies, buckets, ["policy_identifier"])
    return replace_table(rows, table, None, buckets, ["policy_identifier"], path)


def daily_policy_orders(inputs: Inputs, table: str, today: dt.date | None = None, zone: str = REPORT_ZONE,
                        once: bool = False, horizon: int | None = None) -> tuple[dt.date, dt.date]:
    """Reload the trailing window of ``table``; returns the window.

    As upstream, a policy that is seen again in a later window is stored again. With ``once``
    it stays on its earliest day (of those within ``horizon`` days, default all): see ``publish_window``.
    """
    today = today or today_in(zone)
    lo, hi = rolling_days(today, 8, 1)
    check_hit_days(inputs, lo, hi)
    publish_window(R.policy_orders(inputs, lo, hi), table, "date_time", lo, hi,
                   partition_col=DAY_PARTITION, once_by="pid" if once else None, horizon=horizon)
    return lo, hi


def monthly_dashboard(inputs: Inputs, orders_table: str, out_table: str,
                      today: dt.date | None = None, start: dt.date = DASHBOARD_START,
                      zone: str = REPORT_ZONE) -> DataFrame:
    """Create or replace ``out_table`` with the retention pivot."""
    spark: SparkSession = inputs.spark
    today = today or today_in(zone)
    lo, hi = until_last_month_end(start, today)
    orders = spark.table(orders_table).drop(DAY_PARTITION)
    return full_refresh(R.retention_dashboard(inputs, orders, lo, hi), table=out_table)


def present(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Presentation order for a (small, aggregated) report: sort by its keys, nulls first.

    Only for the final display; stored tables are never sorted.
    """
    return df.orderBy(*(keys or df.columns[:1]))
