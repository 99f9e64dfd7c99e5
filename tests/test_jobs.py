"""Table-level jobs: backfill, daily window reload, monthly dashboard."""

import datetime as dt

from cohortline.plans import jobs
from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.plans.verify import canon


def _rows(df):
    cols = [c for c in df.columns if c != jobs.DAY_PARTITION]
    return canon([tuple(r) for r in df.select(*cols).collect()], cols)


def test_daily_reload_equals_window_replace(spark, inputs_small):
    table = "po_daily_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    jobs.backfill_policy_orders(inputs_small, table, *P.BACKFILL_WINDOW)
    expected = R.daily_refresh(inputs_small, R.policy_orders(inputs_small, *P.BACKFILL_WINDOW),
                               *P.DAILY_WINDOW)
    for _ in range(2):  # rerunning the same day leaves the table unchanged
        lo, hi = jobs.daily_policy_orders(inputs_small, table, today=P.DAILY_TODAY)
        assert (lo, hi) == P.DAILY_WINDOW
        assert _rows(spark.table(table)) == _rows(expected)


def test_monthly_dashboard_from_stored_orders(spark, inputs_small):
    orders, out = "po_dash_src", "retention_pivot_test"
    for t in (orders, out):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    jobs.backfill_policy_orders(inputs_small, orders, *P.BACKFILL_WINDOW)
    got = jobs.monthly_dashboard(inputs_small, orders, out, today=P.DASHBOARD_TODAY,
                                 start=P.RETENTION_START)
    want = R.retention_dashboard(inputs_small, R.policy_orders(inputs_small, *P.BACKFILL_WINDOW),
                                 *P.DASHBOARD_WINDOW)
    assert _rows(got) == _rows(want)


def test_window_helpers():
    from cohortline.functions.dates import last_month_end, rolling_days, today_in
    assert rolling_days(dt.date(2024, 1, 25)) == (dt.date(2024, 1, 17), dt.date(2024, 1, 24))
    assert last_month_end(dt.date(2024, 3, 15)) == dt.date(2024, 2, 29)
    # 2024-06-30 14:30 UTC is already July 1st in Sydney
    assert today_in("Australia/Sydney", dt.datetime(2024, 6, 30, 14, 30)) == dt.date(2024, 7, 1)


def test_day_in_zone_ignores_session_zone(spark):
    from pyspark.sql import functions as F

    from cohortline.functions.dates import day_in_zone

    df = spark.createDataFrame([(dt.datetime(2024, 6, 30, 14, 30),), (dt.datetime(2024, 6, 30, 13, 0),)],
                               "ts timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Australia/Sydney"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r.d for r in df.select(day_in_zone("ts").alias("d")).orderBy(F.col("ts")).collect()]
            assert got == [dt.date(2024, 6, 30), dt.date(2024, 7, 1)], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_stored_orders_join_without_shuffling_them(spark, inputs_small):
    from tests.test_plans import formatted

    orders = "po_bucketed_test"
    spark.sql(f"DROP TABLE IF EXISTS {orders}")
    jobs.backfill_policy_orders(inputs_small, orders, *P.BACKFILL_WINDOW, buckets=8)
    jobs.daily_policy_orders(inputs_small, orders, today=P.DAILY_TODAY)  # appends keep buckets
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = R.retention_dashboard(inputs_small, spark.table(orders).drop(jobs.DAY_PARTITION),
                                   *P.DASHBOARD_WINDOW)
        text = formatted(df)
        assert "Bucketed: true" in text
        assert "hashpartitioning(pid" not in text  # the stored side is not shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_backfill_writes_few_files(spark, inputs_small):
    import os

    table = "po_layout_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    jobs.backfill_policy_orders(inputs_small, table, *P.BACKFILL_WINDOW)
    files = spark.table(table).inputFiles()
    days = spark.table(table).select(jobs.DAY_PARTITION).distinct().count()
    assert len(files) == days  # small days: one file each
    spark.sql(f"DROP TABLE IF EXISTS {table}_b")
    jobs.backfill_policy_orders(inputs_small, f"{table}_b", *P.BACKFILL_WINDOW, buckets=4)
    names = [os.path.basename(f) for f in spark.table(f"{table}_b").inputFiles()]
    assert len(names) <= 4 * days


def test_failed_load_loses_no_day_when_the_next_day_runs(spark, inputs_small, monkeypatch):
    from cohortline.operators import load

    table = "po_crash_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    jobs.backfill_policy_orders(inputs_small, table, *P.BACKFILL_WINDOW)
    before = _rows(spark.table(table))
    day1, day2 = dt.date(2024, 1, 20), dt.date(2024, 1, 21)

    def broken(*args, **kwargs):
        raise RuntimeError("executors lost")

    for step in ("_overwrite_days", "_apply_run"):
        with monkeypatch.context() as m:
            m.setattr(load, step, broken)
            try:
                jobs.daily_policy_orders(inputs_small, table, today=day1)
            except RuntimeError:
                pass
            else:
                raise AssertionError("the load was to fail")
        assert _rows(spark.table(table)) == before or step == "_overwrite_days"
    jobs.daily_policy_orders(inputs_small, table, today=day2)
    got = _rows(spark.table(table))
    want = R.daily_refresh(inputs_small, R.policy_orders(inputs_small, *P.BACKFILL_WINDOW), dt.date(2024, 1, 12),
                           dt.date(2024, 1, 19))
    want = R.daily_refresh(inputs_small, want, dt.date(2024, 1, 13), dt.date(2024, 1, 20))
    assert got == _rows(want)
    assert spark.table(table).where("hit_day = DATE'2024-01-12'").count() > 0


def test_empty_days_of_the_window_are_cleared(spark, inputs_small):
    from cohortline.operators.load import publish_window

    table = "po_empty_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    jobs.backfill_policy_orders(inputs_small, table, *P.BACKFILL_WINDOW)
    lo, hi = P.DAILY_WINDOW
    new = R.policy_orders(inputs_small, lo, hi).where("to_date(date_time) <> DATE'2024-01-18'")
    publish_window(new, table, "date_time", lo, hi)
    assert spark.table(table).where("hit_day = DATE'2024-01-18'").count() == 0
    assert spark.table(table).where("hit_day = DATE'2024-01-16'").count() > 0


def test_unpartitioned_rewrite_recovers(spark, inputs_small, monkeypatch):
    """The overwrite fails halfway and leaves the table empty: the next load starts from the staged copy."""
    from cohortline.operators import load

    spark.sql("DROP TABLE IF EXISTS po_flat_test")
    R.policy_orders(inputs_small, *P.BACKFILL_WINDOW).write.saveAsTable("po_flat_test")
    lo, hi = P.DAILY_WINDOW
    whole = _rows(R.daily_refresh(inputs_small, R.policy_orders(inputs_small, *P.BACKFILL_WINDOW), lo, hi))
    new = R.policy_orders(inputs_small, lo, hi)
    rewrite = load._rewrite

    def halfway(spark, run, table, *args):
        rewrite(spark, run, table, *args)
        spark.sql(f"TRUNCATE TABLE {table}")
        raise RuntimeError("executors lost")

    with monkeypatch.context() as m:
        m.setattr(load, "_rewrite", halfway)
        try:
            load.publish_window(new, "po_flat_test", "date_time", lo, hi)
        except RuntimeError:
            pass
    assert spark.table("po_flat_test").count() == 0
    load.publish_window(new, "po_flat_test", "date_time", lo, hi)
    assert _rows(spark.table("po_flat_test")) == whole
