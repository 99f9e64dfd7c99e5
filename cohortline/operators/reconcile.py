"""Cross-source purchase reconciliation (U22) and its semi / anti forms.

Semantics (the reference's row model): left rows are left-joined to a
membership list on ``member_on`` (a key listed n times fans the left row
out n times), the result is full-outer-joined to the right rows on ``on``,
and per group the rows are counted by which sides are present.

Plan: instead of materialising that fan-out, every side is first reduced
to counts per key (partial + final aggregation, so a hot key costs one
partial row per map task) and the row counts of the outer join are
computed from the multiplicities. The result is exactly the same numbers,
but a policy listed many times, or matched by many hits, never multiplies
rows in a shuffle.

Per join key k = (pid, product): n_l left rows, each listed c times in the
membership list (c = 0 when absent, one left-join row then), g right rows.
With L = n_l * max(c, 1) left-join rows, of which H = n_l * c are members
and N = n_l * [c = 0] are not, the full outer join yields L * g rows
(g > 0), L rows (g = 0) or g rows (n_l = 0). Hence, summed over keys:

    bq_sales = L * max(g, 1)          grs_sales = g * max(L, 1)
    bq_hub_sales = H * max(g, 1)      bq_nonhub_sales = N * max(g, 1)
    both_sales = L * g                nonhub_both_sales = N * g
    bq_only_sales = L * [g = 0]       bq_nonhub_only_sales = N * [g = 0]
    grs_only_sales = g * [L = 0]

Null keys never match, as in SQL; they stay one-sided.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECONCILE_COLUMNS = (
    "bq_sales", "bq_nonhub_sales", "bq_hub_sales", "grs_sales", "both_sales",
    "nonhub_both_sales", "bq_only_sales", "bq_nonhub_only_sales", "grs_only_sales",
)


def reconcile(left: DataFrame, right: DataFrame, members: DataFrame,
              on: Sequence[str] = ("pid", "product"), member_on: str = "pid",
              group: str = "product", left_distinct: bool = False) -> DataFrame:
    """Counts of left (``bq``) and right (``grs``) rows by presence on the
    other side and by membership (``hub``) of the left row's key.

    ``group`` must be one of ``on``; the group value is taken from whichever
    side is present. The membership counts (one row per listed key) are
    joined as the planner decides: adaptive execution broadcasts them when
    their measured size allows, which keeps the left side in its ``on``
    partitioning for the outer join, and shuffles a longer list.

    ``left_distinct`` declares that ``left`` has one row per ``on`` key (for
    example the output of ``distinct()``); each key then counts once and the
    per-key count aggregation, a second hash aggregation over the same keys,
    is skipped.
    """
    on = list(on)
    if group not in on or member_on not in on:
        raise ValueError("group and member_on must be join keys")
    m = members.groupBy(member_on).agg(F.count(F.lit(1)).alias("__n_c"))
    n_l, n_c = F.col("__n_l"), F.col("__n_c")
    # Left: rows per key first (partial aggregation before any shuffle), then
    # the membership multiplicity of the key's member_on value.
    if left_distinct:
        counted = left.select(*on, F.lit(1).cast("bigint").alias("__n_l"))
    else:
        counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__n_l"))
    lk = (
        counted
        .join(m, member_on, "left")
        .select(
            *on,
            (n_l * F.coalesce(n_c, F.lit(1))).alias("__l_all"),
            F.when(n_c.isNull(), n_l).otherwise(F.lit(0)).alias("__l_nonhub"),
            (n_l * F.coalesce(n_c, F.lit(0))).alias("__l_hub"),
        )
    )
    rk = right.groupBy(*on).agg(F.count(F.lit(1)).alias("__g"))
    cond = None
    for k in on:  # same key order as both aggregates: no extra exchange
        c = lk[k] == rk[k]
        cond = c if cond is None else (cond & c)
    j = lk.join(rk, cond, "full_outer").select(
        F.coalesce(lk[group], rk[group]).alias(group),
        F.coalesce(F.col("__l_all"), F.lit(0)).alias("l_all"),
        F.coalesce(F.col("__l_nonhub"), F.lit(0)).alias("l_nonhub"),
        F.coalesce(F.col("__l_hub"), F.lit(0)).alias("l_hub"),
        F.coalesce(F.col("__g"), F.lit(0)).alias("g"),
    )
    l_all, l_nonhub, l_hub, g = (F.col(c) for c in ("l_all", "l_nonhub", "l_hub", "g"))
    g1 = F.greatest(g, F.lit(1))
    no_g = F.when(g == 0, F.lit(1)).otherwise(F.lit(0))
    no_l = F.when(l_all == 0, F.lit(1)).otherwise(F.lit(0))
    measures = {
        "bq_sales": l_all * g1,
        "bq_nonhub_sales": l_nonhub * g1,
        "bq_hub_sales": l_hub * g1,
        "grs_sales": F.when(l_all > 0, l_all * g).otherwise(g),
        "both_sales": l_all * g,
        "nonhub_both_sales": l_nonhub * g,
        "bq_only_sales": l_all * no_g,
        "bq_nonhub_only_sales": l_nonhub * no_g,
        "grs_only_sales": g * no_l,
    }
    return j.groupBy(group).agg(*[F.sum(e).cast("bigint").alias(n) for n, e in measures.items()])


def matched(left: DataFrame, right: DataFrame, on: Sequence[str] = ("pid", "product")) -> DataFrame:
    """Left rows with at least one right row on ``on`` (left semi join)."""
    return left.join(right.select(*on), list(on), "left_semi")


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str] = ("pid", "product")) -> DataFrame:
    """Left rows with no right row on ``on`` (left anti join)."""
    return left.join(right.select(*on), list(on), "left_anti")
