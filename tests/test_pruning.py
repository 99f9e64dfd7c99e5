"""Visits read for a window only: key bitmap, day partition with a lookback; verified hit days; key cut."""

import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortline.functions.keys import bare_policy_id, strip_prefix
from cohortline.operators.hits import first_visit
from cohortline.operators.keyfilter import keep_keys, key_bitmap
from cohortline.plans import jobs
from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.plans.verify import canon
from cohortline.sources.tables import MisfiledHits, catalog_inputs, check_hit_days
from tests.test_plans import formatted
from tests.test_sources import TABLES


def rows(df):
    return canon([tuple(r) for r in df.collect()], df.columns)


@pytest.mark.parametrize("bits", [12, 16, 27])
def test_filter_keeps_every_key_of_the_set(spark, bits):
    r = random.Random(bits)
    keys = [f"k{r.randrange(10 ** 9)}" for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(k, n) for n, k in enumerate(keys + [f"other{n}" for n in range(20000)] + keys)], "key string, __at long")
    kept = keep_keys(df, "key", spark.createDataFrame([(k,) for k in keys], "id string"), "id", bits)
    assert kept.columns == df.columns
    got = [r.key for r in kept.collect()]
    assert sorted(k for k in got if not k.startswith("other")) == sorted([k for k in keys if k is not None] * 2)
    others = sum(k.startswith("other") for k in got)
    assert others / 20000 <= 1.3 * 402 / 2 ** bits + .001


def test_bitmap_is_bounded_whatever_is_put_in(spark):
    maps = key_bitmap(spark.range(200000).withColumn("id", F.col("id").cast("string")), "id", 14)
    assert maps.count() == 4 and {len(r.words) for r in maps.collect()} == {64}
    assert key_bitmap(spark.createDataFrame([], "id string"), "id").count() == 0
    assert keep_keys(spark.range(3), "id", spark.range(0), "id").count() == 0
    with pytest.raises(ValueError):
        key_bitmap(spark.range(3), "id", 40)


def test_pruned_orders_are_the_same(inputs_small):
    pruned = dataclasses.replace(inputs_small, prune_visits=True)
    assert rows(R.policy_orders(pruned, *P.DAILY_WINDOW)) == rows(R.policy_orders(inputs_small, *P.DAILY_WINDOW))


def shuffled_rows(spark, df):
    """Rows that the visits' aggregate sends through its shuffle, by the executed plan's metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(k) for k in range(children.size())]
    return found


def test_filter_lies_below_the_aggregate_and_spares_the_shuffle(spark, inputs_small):
    visits = inputs_small.visits
    many = visits.unionByName(visits.selectExpr("concat('x', visit_id) as visit_id", *visits.columns[1:])).cache()
    inputs = dataclasses.replace(inputs_small, visits=many, prune_visits=True)
    ids = R.purchase_hits(inputs.hits, *P.DAILY_WINDOW).select(R.visitor_id("post_visid_high", "post_visid_low").alias("visitor_id"), "visit_num")
    pruned = first_visit(R.window_visits(inputs, ids, *P.DAILY_WINDOW))
    tree = formatted(pruned).split("\n\n")[0]
    aggregates = [k for k, line in enumerate(tree.splitlines()) if "Aggregate" in line]
    join = next(k for k, line in enumerate(tree.splitlines()) if "BroadcastHashJoin" in line)
    assert aggregates[0] < aggregates[1] < join  # both halves of the visits' aggregate are above the filter
    whole = max(shuffled_rows(spark, first_visit(many)))
    assert max(shuffled_rows(spark, pruned)) < .6 * whole
    many.unpersist()


def test_long_windows_are_not_filtered(inputs_small):
    pruned = dataclasses.replace(inputs_small, prune_visits=True)
    assert "shiftright" not in formatted(R.policy_orders(pruned, *P.BACKFILL_WINDOW))
    assert "shiftright" in formatted(R.policy_orders(pruned, *P.DAILY_WINDOW))


@pytest.fixture(scope="module")
def by_day(spark, inputs_small):
    names = {}
    for t in TABLES:
        names[t] = f"prune_{t}"
        spark.sql(f"DROP TABLE IF EXISTS prune_{t}")
        df = getattr(inputs_small, t)
        if t in ("hits", "visits"):
            df.withColumn("day", F.to_date("date_time" if t == "hits" else "start_time")).write.partitionBy("day").saveAsTable(names[t])
        else:
            df.write.saveAsTable(names[t])
    return names


def test_visits_of_the_window_and_the_days_before_it(spark, inputs_small, by_day):
    lo, hi = P.DAILY_WINDOW
    wide = catalog_inputs(spark, hits_day_column="day", visits_day_column="day", visit_lookback=60, **by_day)
    df = R.policy_orders(wide, lo, hi)
    assert rows(df) == rows(R.policy_orders(inputs_small, lo, hi))
    narrow = catalog_inputs(spark, hits_day_column="day", visits_day_column="day", visit_lookback=3, **by_day)
    text = formatted(R.policy_orders(narrow, lo, hi))
    assert (lo - dt.timedelta(days=3)).isoformat() in text
    recent = inputs_small.visits.where(F.to_date("start_time").between(F.lit(lo - dt.timedelta(days=3)), F.lit(hi)) | F.col("start_time").isNull())
    assert rows(R.policy_orders(narrow, lo, hi)) == rows(R.policy_orders(dataclasses.replace(inputs_small, visits=recent), lo, hi))


def test_misfiled_hits_raise(spark, inputs_small, by_day):
    good = catalog_inputs(spark, hits_day_column="day", **by_day)
    check_hit_days(good, *P.DAILY_WINDOW)
    check_hit_days(inputs_small, *P.DAILY_WINDOW)  # no partition, nothing to check
    lo, hi = P.DAILY_WINDOW
    for shifted in (hi + dt.timedelta(days=1), lo, None):  # next to the window, in it, without a day
        moved = good.hits.withColumn("hit_day", F.when(F.col("event_id") == good.hits.where(
            F.to_date("date_time") == F.lit(lo + dt.timedelta(days=2))).agg(F.min("event_id")).first()[0], F.lit(shifted)).otherwise(F.col("hit_day")))
        bad = dataclasses.replace(good, hits=moved)
        with pytest.raises(MisfiledHits, match=str(shifted)):
            check_hit_days(bad, lo, hi)
        with pytest.raises(MisfiledHits):
            jobs.daily_policy_orders(bad, "never_written", today=P.DAILY_TODAY)
    assert not spark.catalog.tableExists("never_written")


def test_prefix_is_stripped_and_long_ids_are_cut(spark):
    long = "MOT" + "".join(str(k % 10) for k in range(150))
    df = spark.createDataFrame([("CAR", long), ("TRAVEL", long), ("HOME", "HOM"), ("HOME", None)], "product string, id string")
    got = df.select(strip_prefix("id").alias("a"), strip_prefix("id", None).alias("b"), bare_policy_id("product", "id").alias("c")).collect()
    assert [tuple(r) for r in got] == [(long[3:103], long[3:], long[3:103]), (long[3:103], long[3:], long), ("", "", ""), (None, None, None)]
