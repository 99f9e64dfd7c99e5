"""Hit-level operators: purchase selection (U2), default channel (U3),
visit enrichment (U9) and custom channel (U4 applied to a frame)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.channels import INSURANCE_RULES, Rule, channel_label, host_literals
from cohortline.functions.dates import day_between
from cohortline.functions.keys import visit_id, visitor_id
from cohortline.functions.urls import url_host
from cohortline.sources.adapters import PAGE_CAR, PAGE_HOME, PAGE_TRAVEL
from cohortline.sources.schemas import HIT_DAY

# Purchase-confirmation pages per report family.
PURCHASE_PAGES = (PAGE_CAR, PAGE_HOME, PAGE_TRAVEL)
CAR_HOME_PAGES = (PAGE_CAR, PAGE_HOME)

# Fixed value: type the closer id is compared in (exact numeric).
CLOSER_ID_TYPE = "decimal(38,9)"

# Prefix of the stand-in keys given to null join keys (see ``with_visit``).
NULL_KEY_PREFIX = "\u0000"


def purchase_hits(hits: DataFrame, lo: dt.date, hi: dt.date,
                  pages: Sequence[str] = PURCHASE_PAGES) -> DataFrame:
    """Hits with a policy id on a purchase page whose day is in ``[lo, hi]``.

    The day range reaches the Parquet scan as a timestamp range filter. When
    the hits carry their day partition (``hit_day``), the same range is also
    put on it, so only the window's partitions are listed and read.
    """
    cond = (day_between("date_time", lo, hi)
            & F.col("post_evar61").isNotNull()
            & F.col("pagename").isin(*pages))
    if HIT_DAY in hits.columns:
        cond = F.col(HIT_DAY).between(F.lit(lo), F.lit(hi)) & cond
    return hits.where(cond)


def with_default_channel(hits: DataFrame, channel_dim: DataFrame,
                         out: str = "default_channel") -> DataFrame:
    """Left-join the channel dimension on the numeric closer id.

    ``try_cast`` makes a non-numeric closer id a miss (null channel) instead
    of failing the job under ANSI mode. The planner broadcasts the dimension
    while its size is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles beyond it.
    """
    dim = channel_dim.select(F.col("channel_id").alias("__ch_id"),
                             F.col("channel_name").alias(out))
    key = F.col("va_closer_id").try_cast(CLOSER_ID_TYPE)
    return hits.join(dim, key == F.col("__ch_id"), "left").drop("__ch_id")


def first_visit(visits: DataFrame) -> DataFrame:
    """One row per visit id: the earliest ``start_time`` (nulls first), ties by
    OS name, device and OS type, so the choice never depends on the input's order.

    A minimum of a struct: partially aggregated before the shuffle, so a visit
    id with very many rows costs one row per map task.
    """
    row = F.struct("start_time", "os_name", "device", "mobile_device_type")
    return (visits.groupBy("visit_id").agg(F.min(row).alias("__v"))
            .select("visit_id", "__v.device", "__v.mobile_device_type", "__v.os_name", "__v.start_time"))


def with_visit(df: DataFrame, visits: DataFrame, *, high: str = "post_visid_high",
               low: str = "post_visid_low", visit_num: str = "visit_num",
               visitor: str | None = None, spread_nulls_by: Sequence[str] = ()) -> DataFrame:
    """Left-join the visit dimension on ``visitor_id || '_' || visit_num``.

    Adds ``device_type``, ``os_type``, ``os_version`` and ``start_time``. A
    visit id with several rows fans the hit out; where only the earliest row
    matters, pass ``first_visit(visits)``. Both sides can be large, so this is
    a shuffled join (the reduced visits already have its partitioning); AQE
    splits a skewed visit key on the hit side.

    A hit without a visitor id can never match, but a null join key still
    hashes every such hit to the same reducer. With ``spread_nulls_by``,
    each null key is replaced by a stand-in key (a NUL character followed by
    a hash of the given columns) so those hits spread over all reducers; the
    join condition excludes stand-in keys from matching, so they still miss
    and the result is unchanged.
    """
    vis = visitor_id(high, low) if visitor is None else F.col(visitor)
    key = visit_id(vis, visit_num)
    v = visits.select(
        F.col("visit_id").alias("__visit_id"),
        F.col("device").alias("device_type"),
        F.col("mobile_device_type").alias("os_type"),
        F.col("os_name").alias("os_version"),
        F.col("start_time"),
    )
    if not spread_nulls_by:
        return df.join(v, key == F.col("__visit_id"), "left").drop("__visit_id")
    spread = F.concat(F.lit(NULL_KEY_PREFIX), F.xxhash64(*spread_nulls_by).cast("string"))
    df = df.withColumns({"__vkey": F.coalesce(key, spread), "__vkey_real": key.isNotNull()})
    cond = (F.col("__vkey") == F.col("__visit_id")) & F.col("__vkey_real")
    return df.join(v, cond, "left").drop("__visit_id", "__vkey", "__vkey_real")


def with_custom_channel(df: DataFrame, *, referrer: str = "visit_referrer", utm: str = "utm_param",
                        channel: str = "default_channel", out: str = "custom_channel",
                        rules: tuple[Rule, ...] = INSURANCE_RULES) -> DataFrame:
    """Add the rule-based channel label; host and lower(utm) are computed once.

    The host only feeds ``host LIKE '%name%'`` rule predicates, and a host is
    a substring of its URL, so the host regex runs only for referrers that
    contain one of those names; for the others it is null, which a ``CASE``
    condition treats like false. Labels are unchanged.
    """
    host = url_host(referrer)
    lits = host_literals(rules)
    if lits is not None:
        ref = F.col(referrer)
        hit = None
        for lit in lits:
            hit = ref.contains(lit) if hit is None else (hit | ref.contains(lit))
        host = F.when(hit, host) if hit is not None else F.lit(None).cast("string")
    cols = [c for c in df.columns if c != out]
    df = df.withColumns({"__host": host, "__utm": F.lower(F.col(utm))})
    return df.select(*cols, channel_label("__host", "__utm", channel, rules).alias(out))
