"""Physical-plan checks: no slow or unbounded operators, pushdown reaches
the scan, dedup limits rows before the shuffle."""

import re

import pytest

from cohortline.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")

REPORTS = [k for k in QUERIES if k.startswith("report_") or k in ("policy_orders_backfill",)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_forbidden_operators(spark, key):
    text = formatted(QUERIES[key](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in text, (key, op)


def test_first_hit_limits_before_shuffle(spark):
    text = formatted(QUERIES["report_purchases_default"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text
    assert "Partial" in text


def test_purchase_window_pushed_to_scan(spark):
    text = formatted(QUERIES["purchase_hits"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-01T00:00)" in text
    assert "LessThan(ts,2024-02-01T00:00)" in text


def test_scan_prunes_columns(spark):
    text = formatted(QUERIES["report_purchases_default"](spark, SF_SMALL))
    # events has value and props; the report never reads them
    for line in text.splitlines():
        if line.startswith("ReadSchema") and "event_id" in line:
            assert "props" not in line and "value" not in line


def test_channel_dimension_is_broadcast(spark):
    text = formatted(QUERIES["report_purchases_custom"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "LeftOuter" in text


def test_hot_key_dedup_shuffles_one_row_per_map_task(spark):
    """A key holding a third of all rows: the partial limit runs before the
    exchange, so the shuffle carries at most one row per key per task."""
    from pyspark.sql import functions as F

    from cohortline.operators.dedup import first_hit

    df = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"))
    out = first_hit(df, ["k"], ["t"])
    text = formatted(out)
    tree = text.split("\n\n")[0]  # the operator tree, root first
    exchange = tree.index("Exchange")
    limits = [m.start() for m in re.finditer("WindowGroupLimit", tree)]
    assert any(pos > exchange for pos in limits)  # a limit below the exchange ...
    assert re.search(r"WindowGroupLimit\nInput \[\d+\]: .*\nArguments: .*Partial", text)  # ... partial
    assert out.where("k = 'hot'").collect()[0].t == 0
    assert out.count() == 20001


def test_building_a_report_starts_no_job(spark, inputs_small):
    from cohortline.plans import params as P
    from cohortline.plans import reports as R

    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    orders = R.policy_orders(inputs_small, *P.DAILY_WINDOW)
    R.reconciliation(inputs_small, *P.PURCHASE_WINDOW)
    R.retention_dashboard(inputs_small, orders, *P.DASHBOARD_WINDOW)
    R.retention_weekly(inputs_small, *P.WEEKLY_WINDOW)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_reports_do_not_repartition_scans(spark):
    for key in REPORTS:
        assert "REPARTITION_BY" not in formatted(QUERIES[key](spark, SF_SMALL)), key


def test_reconciliation_skips_the_channel_dimension(spark):
    text = formatted(QUERIES["report_reconcile"](spark, SF_SMALL))
    assert "channel_id" not in text


def test_hot_visit_id_does_not_fan_out(spark, inputs_small):
    """A visit id with very many rows: reduced before the join, one row per hit after it."""
    from pyspark.sql import functions as F

    from cohortline.operators.hits import first_visit, with_visit

    one = inputs_small.visits.where("visit_id is not null").limit(1)
    hot = one.select(one.visit_id).crossJoin(spark.range(20000)).select(
        "visit_id", F.lit("d").alias("device"), F.lit("m").alias("mobile_device_type"),
        F.concat(F.lit("os"), F.col("id").cast("string")).alias("os_name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("start_time"))
    visit = one.first().visit_id
    visitor, num = visit.rsplit("_", 1)
    hits = spark.range(50).select("id", F.lit(visitor).alias("v"), F.lit(num).alias("visit_num"))
    out = with_visit(hits, first_visit(hot), visitor="v")
    assert out.count() == 50
    assert {r.os_version for r in out.collect()} == {"os0"}
    text = formatted(out)
    assert text.count("Exchange\n") <= 2 or "partial_min" in text
