"""Declared schemas of the inputs the reports read.

The upstream tables have no DDL; these are the column sets and types the
operators rely on. ``conform`` checks a DataFrame against one of them so a
wrong feed fails at plan time, not in the middle of a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType,
)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


HITS = _s(
    ("event_id", LongType(), True),          # hit id, used as the dedup tiebreak
    ("date_time", TimestampNTZType(), True),
    ("evar7", StringType(), True),           # web product code
    ("post_evar61", StringType(), True),     # policy id, persisted
    ("evar61", StringType(), True),          # policy id, raw
    ("mcvisid", StringType(), True),
    ("post_visid_high", DecimalType(20, 0), True),
    ("post_visid_low", DecimalType(20, 0), True),
    ("visit_num", StringType(), True),
    ("visit_referrer", StringType(), True),
    ("post_evar46", StringType(), True),     # utm string
    ("va_closer_id", StringType(), True),    # numeric text
    ("va_closer_detail", StringType(), True),
    ("pagename", StringType(), True),
)

# Optional column of the hits: the day partition, equal to date(date_time).
HIT_DAY = "hit_day"

# Optional column of the visits: the day partition, equal to date(start_time) or null.
VISIT_DAY = "visit_day"

MARKETING_CHANNEL = _s(
    ("channel_id", LongType(), False),
    ("channel_name", StringType(), False),
)

VISITS = _s(
    ("visit_id", StringType(), True),
    ("device", StringType(), True),
    ("mobile_device_type", StringType(), True),
    ("os_name", StringType(), True),
    ("start_time", TimestampNTZType(), True),
)

POLICIES = _s(
    ("source_product", StringType(), True),
    ("policy_identifier", StringType(), True),
    ("product_subtype", StringType(), True),
    ("policy_purchase_date", DateType(), True),
    ("purchase_date_est", DateType(), True),
    ("start_date_est", DateType(), True),
    ("end_date_est", DateType(), True),
    ("renewal_date_est", DateType(), True),
    ("cooling_off_days", LongType(), True),
)

CALENDAR = _s(
    ("calendar_day", DateType(), True),
    ("fiscal_week_start", DateType(), True),
    ("fiscal_week_end", DateType(), True),
)

MEMBER_LIST = _s(("policy_id", StringType(), True))


# Conversions that keep every value: from -> to. A plain timestamp becomes its
# wall-clock time in the session time zone.
_INTS = ("tinyint", "smallint", "int", "bigint")
_WIDER = {(a, b) for b in ("bigint", "string", "decimal(20,0)") for a in _INTS} | {("timestamp", "timestamp_ntz")}


def _plain(name: str) -> str:
    return name.lower().replace("_", "")


def find(df: DataFrame, column: str, names: dict[str, str] | None = None) -> str | None:
    """The name that ``column`` has in ``df``: as given in ``names``, or equal
    but for case, or equal but for case and underscores."""
    if names and column in names:
        return names[column]
    for same in (str.lower, _plain):
        got = [c for c in df.columns if same(c) == same(column)]
        if len(got) > 1 and column not in got:
            raise ValueError(f"{column!r} could be any of {got}")
        if got:
            return column if column in got else got[0]
    return None


def _wider(have: DataType, want: DataType) -> bool:
    if isinstance(have, DecimalType) and isinstance(want, DecimalType):
        return (have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale)
    return (have.simpleString(), want.simpleString()) in _WIDER


def conform(df: DataFrame, schema: StructType, name: str, keep: tuple[str, ...] = (),
            names: dict[str, str] | None = None) -> DataFrame:
    """Select the declared columns in declared order (plus ``keep``).

    Names match as in ``find``; a type that can be widened without changing a value
    is cast. Fails on a missing column or another type. Other columns are pruned away."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = find(df, f.name, names)
        if own is None or own not in have:
            raise ValueError(f"{name}: missing column {f.name!r}")
        column = F.col(f"`{own}`")
        if have[own] != f.dataType:
            if not _wider(have[own], f.dataType):
                raise TypeError(f"{name}.{f.name}: expected {f.dataType.simpleString()}, "
                                f"got {have[own].simpleString()}")
            column = column.cast(f.dataType)
        out.append(column.alias(f.name))
    for k in keep:
        if k not in have:
            raise ValueError(f"{name}: missing column {k!r}")
    return df.select(*out, *[F.col(f"`{k}`") for k in keep])
