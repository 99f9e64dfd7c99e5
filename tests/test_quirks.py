
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortline.operators.load import replace_window
from cohortline.plans import reports as R
from cohortline.sources import schemas
from cohortline.sources.tables import Inputs

CAR = "ev-ins:car:quote:thanks"


def _hits(spark, rows):
    """rows: (event_id, ts, evar7, post_evar61, evar61)"""
    full = [(e, t, p7, p61, r61, "mc1", Decimal(1), Decimal(7), "1", None, None, "1", "d", CAR)
            for e, t, p7, p61, r61 in rows]
    return spark.createDataFrame(full, schemas.HITS)


def _inputs(spark, hits, base):
    return Inputs(spark=spark, hits=hits, marketing_channel=base.marketing_channel,
                  visits=base.visits.limit(0), policies=base.policies.limit(0),
                  callcentre_car=base.callcentre_car.limit(0),
                  callcentre_home=base.callcentre_home.limit(0), calendar=base.calendar)


def test_q1_null_raw_ids_collapse_into_one_purchase(spark, inputs_small):
    ts = dt.datetime(2024, 1, 5, 10)
    hits = _hits(spark, [
        (1, ts, "car", "100", None),   # raw id missing
        (2, ts, "car", "200", None),   # raw id missing: same dedup group as 1
        (3, ts, "car", "300", "300"),
    ])
    i = _inputs(spark, hits, inputs_small)
    got = R.first_purchase_hits(i, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert sorted(r.policy_id for r in got.collect()) == ["100", "300"]


def test_q2_policy_seen_again_in_the_window_is_stored_twice(spark, inputs_small):
    early, late = dt.datetime(2024, 1, 10, 9), dt.datetime(2024, 1, 20, 9)
    hits = _hits(spark, [(1, early, "car", "500", "500"), (2, late, "car", "500", "500")])
    i = _inputs(spark, hits, inputs_small)
    stored = R.policy_orders(i, dt.date(2024, 1, 1), dt.date(2024, 1, 16))   # first load
    window = (dt.date(2024, 1, 17), dt.date(2024, 1, 24))
    after = replace_window(stored, R.policy_orders(i, *window), "date_time", *window)
    rows = after.where(F.col("pid") == "MOT500").collect()
    assert sorted(r.date_time for r in rows) == [early, late]


def test_q4_capitalised_product_gets_no_prefix(spark, inputs_small):
    ts = dt.datetime(2024, 1, 5, 10)
    hits = _hits(spark, [(1, ts, "Car", "700", "700"), (3, ts, "car", "800", "800")])
    i = _inputs(spark, hits, inputs_small)
    got = {r.pid: r.product for r in R.policy_orders(i, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).collect()}
    assert got == {"700": "car", "MOT800": "car"}
