"""Adapter views: the report inputs derived from the driver's test tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not web hits
or a policy master. These functions derive deterministic stand-ins with the
DataFrame API (``FIXTURES.md`` section 3 gives the same views in SQL). Every
view is a projection/filter/aggregate over a whole source table, so its size
grows with the source. Production jobs read the real tables instead
(``sources.tables.catalog_inputs``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.dates import week_start
from cohortline.sources import schemas

# Page names of the purchase-confirmation pages, and the
# quote-start page that is not a purchase.
PAGE_CAR = "ev-ins:car:quote:thanks"
PAGE_HOME = "ev-ins:home:quote:thanks"
PAGE_TRAVEL = "ev-ins:quoteline:travel:thankyou"
PAGE_QUOTE_START = "ev-ins:quote:start"

# The marketing-channel dimension of the test setup.
CHANNELS = (
    (1, "direct"), (2, "email"), (3, "paid search"), (4, "social"),
    (5, "organic search"), (6, "display"), (7, "paid search"), (8, "paid search"),
    (2, "newsletter"),  # an id that is listed twice
)

# Referrer URLs by event_id % 16 (others: a plain site).
REFERRERS = {
    1: "https://www.comparethemarket.com.au/car",
    2: "www.choosi.com.au/x",
    3: "https://u:p@www.iselect.com.au:443/a?b",
    4: "https://WWW.ISELECT.COM.AU/",
    5: "https://x.example.org/?r=choosi",
    6: None,
}
REFERRER_OTHER = "https://example.org/"

# Utm strings by event_id % 29 (others: a neutral tag).
UTMS = {
    1: "UTM:CTM-a", 2: "utm:comparethemarket", 3: "x-iSelect", 4: "utm:choosi", 5: "ser-1",
    6: "laser-2", 7: "Email_w", 8: "PMax", 9: "performance-max", 10: "utm:rewards",
    11: "utm:discoverpage", 12: "facebook", 13: "tiktok", 14: "youtube", 15: "instagram",
    16: "bvod", 17: None,
}
UTM_OTHER = "utm:other"

# Home product subtypes by (orderkey + orderkey % 6) % 7.
HOME_SUBTYPES = {0: "Landlord", 1: "Content Only Cover", 2: "Home Only Cover"}
HOME_SUBTYPE_OTHER = "Combined Home & Contents"

POLICY_EPOCH = dt.date(2024, 1, 1)


def _case(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        val = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(key == k, val) if expr is None else expr.when(key == k, val)
    return expr.otherwise(F.lit(default))


def hits(events: DataFrame) -> DataFrame:
    """Web hits: a pair of events (even id and the next) shares a policy id."""
    e = F.col("event_id")
    k = e - e % 2
    k6 = k % 6
    is_error = F.col("event_type") == "error"
    null_s = F.lit(None).cast("string")
    out = events.select(
        e.alias("event_id"),
        F.col("ts").alias("date_time"),
        F.when(k6 == 0, F.when(e % 50 == 7, F.lit("Car")).otherwise(F.lit("car")))
        .when(k6 == 2, F.lit("home")).otherwise(F.lit("travel")).alias("evar7"),
        F.when(is_error, null_s).otherwise(k.cast("string")).alias("post_evar61"),
        F.when(is_error | (e % 20 == 0), null_s).otherwise(k.cast("string")).alias("evar61"),
        F.concat(F.lit("mc"), F.col("user_id").cast("string")).alias("mcvisid"),
        F.when(e % 31 != 0, F.col("user_id").cast("decimal(20,0)")).alias("post_visid_high"),
        (F.col("user_id") * 7).cast("decimal(20,0)").alias("post_visid_low"),
        (e % 3 + 1).cast("string").alias("visit_num"),
        _case(e % 16, REFERRERS, REFERRER_OTHER).alias("visit_referrer"),
        _case(e % 29, UTMS, UTM_OTHER).alias("post_evar46"),
        F.when(e % 23 == 5, F.lit("n/a")).when(e % 23 != 3, (e % 11).cast("string")).alias("va_closer_id"),
        F.col("event_type").alias("va_closer_detail"),
        F.when(F.col("event_type") == "view", F.lit(PAGE_QUOTE_START))
        .when(k6 == 0, F.lit(PAGE_CAR)).when(k6 == 2, F.lit(PAGE_HOME))
        .otherwise(F.lit(PAGE_TRAVEL)).alias("pagename"),
    )
    return schemas.conform(out, schemas.HITS, "hits")


def marketing_channel(spark: SparkSession) -> DataFrame:
    """The channel dimension (a fixed, 8-row table).

    Built as an inline ``VALUES`` table so it plans as a local relation: its
    size is known to the planner and broadcasting it needs no Spark job.
    """
    def q(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"(CAST({i} AS BIGINT), {q(name)})" for i, name in CHANNELS)
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(channel_id, channel_name)")
    return schemas.conform(df, schemas.MARKETING_CHANNEL, "marketing_channel")


def visits(events: DataFrame) -> DataFrame:
    """Visit dimension; a visit id can carry two rows (two OS versions), for some
    users also two devices with the same start and OS version, and users with
    id divisible by 10 have no visits (left-join misses)."""
    u, e = F.col("user_id"), F.col("event_id")
    grouped = (
        events.where(u % 10 != 0)
        .groupBy(u.alias("user_id"), (e % 3).alias("r3"), (e % 2).alias("r2"))
        .agg(F.min("ts").alias("start_time"))
    )
    u = F.col("user_id")
    out = grouped.select(
        F.concat(u.cast("string"), (u * 7).cast("string"), F.lit("_"),
                 (F.col("r3") + 1).cast("string")).alias("visit_id"),
        F.when(u % 3 == 0, F.lit("mobile")).when(u % 3 == 1, F.lit("desktop"))
        .otherwise(F.lit("tablet")).alias("device"),
        F.when(u % 2 == 0, F.lit("iOS")).otherwise(F.lit("Android")).alias("mobile_device_type"),
        F.concat(F.lit("os-"), F.col("r2").cast("string")).alias("os_name"),
        F.col("start_time"),
    )
    out = out.unionByName(out.where(F.col("visit_id").like("%7\\_1")).withColumn("device", F.lit("console")))
    return schemas.conform(out, schemas.VISITS, "visits")


def policies(orders: DataFrame) -> DataFrame:
    """Policy master: one policy per order key, some listed twice; CAR and HOME
    identifiers carry a prefix, TRAVEL ones do not."""
    orders = orders.select("o_orderkey")
    orders = orders.unionByName(orders.where(F.col("o_orderkey") % 90 == 0))
    key = F.col("o_orderkey")
    m = key % 6
    is_car, is_travel = m.isin(0, 1), m == 4
    purchase = F.date_add(F.lit(POLICY_EPOCH), (key % 30).cast("int"))
    start = F.date_add(F.lit(POLICY_EPOCH), (key % 30 + key % 7).cast("int"))
    end_offsets = {1: 10, 2: 45, 3: 80, 4: -2, 5: 370, 6: 500}
    end = None
    for r, off in end_offsets.items():
        val = F.date_add(start, off)
        end = F.when(key % 11 == r, val) if end is None else end.when(key % 11 == r, val)
    out = orders.select(
        F.when(is_car, F.lit("CAR")).when(is_travel, F.lit("TRAVEL")).otherwise(F.lit("HOME"))
        .alias("source_product"),
        F.concat(F.when(is_car, F.lit("MOT")).when(is_travel, F.lit("")).otherwise(F.lit("HOM")),
                 key.cast("string")).alias("policy_identifier"),
        F.when(is_car, F.lit("Comprehensive")).when(is_travel, F.lit("Single Trip"))
        .otherwise(_case((key + m) % 7, HOME_SUBTYPES, HOME_SUBTYPE_OTHER)).alias("product_subtype"),
        purchase.alias("policy_purchase_date"),
        purchase.alias("purchase_date_est"),
        start.alias("start_date_est"),
        end.alias("end_date_est"),
        F.when(key % 37 == 0, F.lit(None).cast("date"))
        .when(key % 2 == 0, F.add_months(start, 12)).otherwise(F.add_months(start, 24))
        .alias("renewal_date_est"),
        F.when(key % 50 == 0, F.lit(None).cast("bigint")).when(key % 3 == 0, F.lit(21).cast("bigint"))
        .otherwise(F.lit(14).cast("bigint")).alias("cooling_off_days"),
    )
    return schemas.conform(out, schemas.POLICIES, "policies")


def callcentre_car(orders: DataFrame) -> DataFrame:
    """Car policies sold by phone; some are listed twice."""
    key = F.col("o_orderkey")
    listed = orders.select(key).where(key % 12 == 0)
    return listed.unionByName(listed.where(key % 36 == 0)).select(
        F.concat(F.lit("MOT"), key.cast("string")).alias("policy_id"))


def callcentre_home(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.where((key % 6 == 2) & (key % 4 == 0)).select(
        F.concat(F.lit("HOM"), key.cast("string")).alias("policy_id"))


def calendar(events: DataFrame) -> DataFrame:
    """One row per calendar day seen in the events; weeks start on Monday."""
    days = events.select(F.to_date("ts").alias("calendar_day")).distinct()
    ws = week_start("calendar_day")
    out = days.select("calendar_day", ws.alias("fiscal_week_start"),
                      F.date_add(ws, 6).alias("fiscal_week_end"))
    return schemas.conform(out, schemas.CALENDAR, "calendar")
