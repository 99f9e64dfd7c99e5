"""Cohorts as of many report days: equal to one report per day, from one scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortline.functions.dates import month_ends
from cohortline.operators.cohorts import cohort_changes, cohort_counts, cohort_counts_asof, cohort_rates, cohort_rates_asof, counts_asof
from cohortline.operators.policies import policies_with_flags, policy_base
from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.plans.verify import canon
from tests.test_plans import formatted

ENDS = [dt.date(2023, 12, 31), dt.date(2024, 1, 10), dt.date(2024, 1, 31), dt.date(2024, 2, 14), dt.date(2025, 2, 1), dt.date(2027, 1, 1)]


def rows(df):
    return canon([tuple(r) for r in df.collect()], df.columns)


def one_by_one(report, ends):
    out = None
    for end in ends:
        one = report(end).withColumn("report_end", F.lit(end))
        out = one if out is None else out.unionByName(one)
    return out


def test_rates_and_counts_equal_one_report_per_day(spark, inputs_small):
    keys = ["product", "start_month"]
    changes = cohort_changes(policy_base(inputs_small.policies), keys)
    for asof, plain in ((cohort_rates_asof, cohort_rates), (cohort_counts_asof, cohort_counts)):
        got = asof(changes, keys, ENDS)
        want = one_by_one(lambda end: plain(policies_with_flags(inputs_small.policies, end), keys), ENDS)
        assert rows(got) == rows(want.select(*got.columns))
        assert dict(got.dtypes) == dict(want.dtypes)


def test_reports_equal_one_report_per_day(spark, inputs_small):
    orders = R.policy_orders(inputs_small, *P.BACKFILL_WINDOW).cache()
    for asof, plain in ((R.retention_monthly_asof, R.retention_monthly), (R.retention_dashboard_asof, R.retention_dashboard)):
        got = asof(inputs_small, orders, P.RETENTION_START, ENDS)
        want = one_by_one(lambda end: plain(inputs_small, orders, P.RETENTION_START, end), ENDS)
        assert rows(got) == rows(want.select(*got.columns))
    orders.unpersist()


def policies(spark, data):
    schema = "k string, start_date date, end_date date, recorded_renewal_date date, coolingoff_days long"
    day = lambda s: s and dt.date.fromisoformat(s)
    return spark.createDataFrame([(k, day(s), day(e), day(r), c) for k, s, e, r, c in data], schema)


ODD = [
    ("a", "2024-01-01", "2099-12-31", "2024-01-01", 14), ("a", "2024-01-01", "2023-12-30", "2025-01-01", 14),
    ("a", "2024-02-29", "2024-03-14", "2024-02-29", None), ("a", None, "2024-03-14", "2024-02-29", 14),
    ("b", "2023-12-31", "2024-01-01", "2024-01-01", 21), ("b", "2024-01-05", "2025-01-19", None, -3),
    (None, "2024-01-05", "2025-01-05", "2025-01-05", 0), (None, "2024-01-05", "2025-01-05", "2025-01-05", 0),
    ("late", "2030-01-01", "2031-01-01", "2031-01-01", 14),
]


def test_odd_dates_null_keys_repeated_rows(spark):
    from cohortline.functions.lifecycle import with_lifecycle_flags

    df = policies(spark, ODD)
    every = [dt.date(2023, 12, 29) + dt.timedelta(days=k) for k in range(0, 800, 3)]
    got = cohort_rates_asof(cohort_changes(df, ["k"]), ["k"], every)
    some = every[::37] + [every[-1]]
    want = one_by_one(lambda end: cohort_rates(with_lifecycle_flags(df, end), ["k"]), some)
    assert rows(got.where(F.col("report_end").isin(some))) == rows(want.select(*got.columns))
    # Counted from the start date on: nothing before it, and never without one.
    got = cohort_counts_asof(cohort_changes(df, ["k"], entry=F.col("start_date")), ["k"], every)
    want = one_by_one(lambda end: cohort_counts(with_lifecycle_flags(df.where(F.col("start_date") <= F.lit(end)), end), ["k"]), some)
    assert rows(got.where(F.col("report_end").isin(some))) == rows(want.select(*got.columns))
    assert got.where("k = 'late'").count() == 0


def test_stored_changes_answer_any_day(spark, tmp_path):
    df = policies(spark, ODD)
    cohort_changes(df, ["k"]).write.parquet(str(tmp_path / "changes"))
    stored = spark.read.parquet(str(tmp_path / "changes"))
    for ends in (ENDS, ENDS[::-1] + ENDS[:2], [ENDS[3]]):
        assert rows(counts_asof(stored, ["k"], ends)) == rows(counts_asof(cohort_changes(df, ["k"]), ["k"], ends))
    assert counts_asof(stored.limit(0), ["k"], ENDS).collect() == []
    with pytest.raises(ValueError):
        counts_asof(stored, ["k"], [])


def test_one_scan_of_the_policies(spark, inputs_small, tmp_path):
    inputs_small.policies.write.parquet(str(tmp_path / "p"))
    keys = ["product", "start_month"]
    text = formatted(cohort_rates_asof(cohort_changes(policy_base(spark.read.parquet(str(tmp_path / "p"))), keys), keys, P.ASOF_ENDS))
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_month_ends():
    assert month_ends(dt.date(2023, 12, 31), dt.date(2024, 3, 30)) == [dt.date(2023, 12, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 29)]
    assert month_ends(dt.date(2024, 1, 1), dt.date(2024, 1, 30)) == []
