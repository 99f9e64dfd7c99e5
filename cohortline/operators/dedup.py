"""First-hit deduplication (U1): keep the earliest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.memo import column_memo

_RN = "__first_hit_rn"


def _asc(c: Column | str) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


@column_memo
def rank_in_key(keys: tuple, order: tuple) -> Column:
    """``row_number() over (partition by keys order by order)``."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*[_asc(c) for c in order]))


def first_hit(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
              tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Rows with ``row_number() over (partition by keys order by order, tiebreak) = 1``.

    String order columns sort ascending with nulls first. ``tiebreak`` must
    make the order total, otherwise the survivor of a time tie is arbitrary.
    A null key is one group, as in SQL.

    Plan: Catalyst turns the ``= 1`` filter into a partial
    ``WindowGroupLimit`` before the shuffle and a final one after it, so each
    map task forwards at most one row per key: a key holding a third of all
    rows costs one row per map task in the shuffle, not a third of the data
    in one reducer.
    """
    if not keys:
        raise ValueError("first_hit needs at least one key")
    rank = rank_in_key(tuple(keys), tuple(order) + tuple(tiebreak))
    return df.withColumn(_RN, rank).where(F.col(_RN) == 1).drop(_RN)
