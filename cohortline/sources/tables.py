"""Input loading: the report inputs as lazy DataFrames.

``Inputs`` bundles the seven inputs the reports read. ``test_inputs``
derives them from the driver's parquet tables (``adapters``);
``catalog_inputs`` reads real tables by name. Both are lazy: nothing is
scanned until an action, and Catalyst prunes every scan to the columns and
row ranges a report uses.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.sources import adapters, schemas

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a single parquet file or folder per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Inputs:
    spark: SparkSession
    hits: DataFrame
    marketing_channel: DataFrame
    visits: DataFrame
    policies: DataFrame
    callcentre_car: DataFrame
    callcentre_home: DataFrame
    calendar: DataFrame
    #: Read only the visits of a window's hits: see ``plans.reports.policy_orders``.
    prune_visits: bool = False
    #: Days before a window's first day on which its visits may have begun (visits with a day partition).
    visit_lookback: int = 2


def test_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    events = read_table(spark, sf_dir, "events")
    orders = read_table(spark, sf_dir, "orders")
    return Inputs(
        spark=spark,
        hits=adapters.hits(events),
        marketing_channel=adapters.marketing_channel(spark),
        visits=adapters.visits(events),
        policies=adapters.policies(orders),
        callcentre_car=adapters.callcentre_car(orders),
        callcentre_home=adapters.callcentre_home(orders),
        calendar=adapters.calendar(events),
    )


def catalog_inputs(spark: SparkSession, *, hits: str, marketing_channel: str, visits: str,
                   policies: str, callcentre_car: str, callcentre_home: str,
                   calendar: str, hits_day_column: str | None = None,
                   columns: dict[str, dict[str, str]] | None = None,
                   prune_visits: bool = True, visits_day_column: str | None = None,
                   visit_lookback: int = 2) -> Inputs:
    """Inputs from catalog tables.

    Columns are matched to ``schemas`` without regard to case and underscores
    (``SourceProduct`` is ``source_product``); ``columns`` names others, as
    ``{"hits": {"event_id": "hit_id"}}``. Types are widened where no value can
    change (``schemas.conform``).

    Hits without an ``event_id`` get a hash of the whole row instead: it only
    breaks ties between hits of the same key and time.

    ``hits_day_column`` names the hit table's day partition column, which
    must equal ``date(date_time)``. It is kept (as ``hit_day``) so report
    windows prune whole partitions; a filter on ``date_time`` alone can only
    skip row groups. ``check_hit_days`` verifies the claim, and the jobs do so before they read a window.

    With ``prune_visits`` a report of few days filters the visits by its hits' visit ids
    before it shuffles them (``operators.keyfilter``). ``visits_day_column`` names the visits'
    day partition, equal to ``date(start_time)`` or null; then only the days from ``visit_lookback`` days
    before the window are read, and a visit that began earlier counts as unknown.
    """
    columns = columns or {}

    def load(kind: str, name: str, schema, keep: tuple[str, ...] = ()) -> DataFrame:
        df = spark.table(name)
        if kind == "hits" and not schemas.find(df, "event_id", columns.get(kind, {})):
            df = df.withColumn("event_id", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        return schemas.conform(df, schema, name, keep=keep, names=columns.get(kind, {}))

    hits_df = load("hits", hits, schemas.HITS, (hits_day_column,) if hits_day_column else ())
    if hits_day_column and hits_day_column != schemas.HIT_DAY:
        hits_df = hits_df.withColumnRenamed(hits_day_column, schemas.HIT_DAY)
    visits_df = load("visits", visits, schemas.VISITS, (visits_day_column,) if visits_day_column else ())
    if visits_day_column and visits_day_column != schemas.VISIT_DAY:
        visits_df = visits_df.withColumnRenamed(visits_day_column, schemas.VISIT_DAY)
    return Inputs(
        spark=spark,
        hits=hits_df,
        marketing_channel=load("marketing_channel", marketing_channel, schemas.MARKETING_CHANNEL),
        visits=visits_df,
        policies=load("policies", policies, schemas.POLICIES),
        callcentre_car=load("callcentre_car", callcentre_car, schemas.MEMBER_LIST),
        callcentre_home=load("callcentre_home", callcentre_home, schemas.MEMBER_LIST),
        calendar=load("calendar", calendar, schemas.CALENDAR),
        prune_visits=prune_visits,
        visit_lookback=visit_lookback,
    )


class MisfiledHits(ValueError):
    """Hits lie in a day partition that is not the day of their time."""


def check_hit_days(inputs: Inputs, lo: dt.date, hi: dt.date, margin: int = 1) -> None:
    """Raise :class:`MisfiledHits` if a day partition in or next to ``[lo, hi]`` holds hits of another day.

    A window is read from its partitions only, so a misfiled hit would be lost in
    silence. One aggregate reads the time column of the window's partitions and of ``margin``
    days on either side (a shifted time zone files a hit one day off) and compares each partition's first and last
    time with its day. Hits without a time are no hits of any day. Without a declared day partition there is nothing to check.
    """
    if schemas.HIT_DAY not in inputs.hits.columns:
        return
    day = F.col(schemas.HIT_DAY)
    near = day.between(F.lit(lo - dt.timedelta(days=margin)), F.lit(hi + dt.timedelta(days=margin)))
    ends = (inputs.hits.where(near | day.isNull()).groupBy(day.alias("day"))
            .agg(F.to_date(F.min("date_time")).alias("first"), F.to_date(F.max("date_time")).alias("last")))
    wrong = ends.where(~F.col("day").eqNullSafe(F.col("first")) | ~F.col("day").eqNullSafe(F.col("last")))
    found = wrong.where(F.col("first").isNotNull()).orderBy("day").limit(20).collect()
    if found:
        raise MisfiledHits("; ".join(f"partition {r.day} holds hits of {r['first']} to {r['last']}" for r in found))
