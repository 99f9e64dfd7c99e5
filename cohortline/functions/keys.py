"""Policy and visit keys (U6, U7, U8) as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline.functions.memo import column_memo

# Web product code -> prefix of the policy-master identifier.
# The comparison is case-sensitive ('Car' gets no prefix), as upstream.
WEB_PREFIXES: Mapping[str, str] = {"car": "MOT", "home": "HOM"}

# Policy-master products whose identifier carries a 3-letter
# prefix.
PREFIXED_PRODUCTS = ("CAR", "HOME")
PREFIX_LEN = 3
# Fixed value: characters kept behind the prefix; a longer id is cut, as upstream.
BARE_LEN = 100


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@column_memo
def prefixed_policy_id(product: Column | str, policy_id: Column | str,
                       prefixes: Mapping[str, str] = WEB_PREFIXES) -> Column:
    """Web policy id -> policy-master identifier (``car`` -> ``MOT`` + id)."""
    product, policy_id = _c(product), _c(policy_id)
    expr = None
    for code, prefix in prefixes.items():
        cond = product == F.lit(code)
        value = F.concat(F.lit(prefix), policy_id)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return policy_id if expr is None else expr.otherwise(policy_id)


@column_memo
def strip_prefix(policy_id: Column | str, length: int | None = BARE_LEN) -> Column:
    """Drop the 3-letter prefix and keep ``length`` characters (None: all)."""
    if length is None:
        return F.substr(_c(policy_id), F.lit(PREFIX_LEN + 1))
    return F.substr(_c(policy_id), F.lit(PREFIX_LEN + 1), F.lit(length))


@column_memo
def bare_policy_id(product: Column | str, policy_id: Column | str,
                   prefixed: tuple[str, ...] = PREFIXED_PRODUCTS, length: int | None = BARE_LEN) -> Column:
    """Policy-master identifier -> web policy id for prefixed products (others stay whole)."""
    product, policy_id = _c(product), _c(policy_id)
    return F.when(product.isin(*prefixed), strip_prefix(policy_id, length)).otherwise(policy_id)


@column_memo
def visitor_id(high: Column | str, low: Column | str) -> Column:
    """Visitor id: the two id halves as text, joined with no separator."""
    return F.concat(_c(high).cast("string"), _c(low).cast("string"))


@column_memo
def visit_id(visitor: Column | str, visit_num: Column | str) -> Column:
    """Visit id: ``visitor_id || '_' || visit_num`` (null if either is null)."""
    return F.concat(_c(visitor), F.lit("_"), _c(visit_num))
