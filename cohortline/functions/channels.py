"""Rule-based marketing-channel classification (U4).

Rules are data: an ordered tuple of ``Rule``; ``classify`` folds them into
one ``CASE WHEN`` column (first match wins), so classification stays a
single JVM expression inside whole-stage codegen. Null inputs make a rule
unknown, which falls through to the next rule exactly like SQL ``CASE``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``label`` applies when ``require`` holds (if given) and any matcher does.

    ``host_like`` patterns are tested against the referrer host as is
    (case-sensitive); ``utm_like`` against the lower-cased utm string;
    ``channel_in`` against the default channel name. Patterns are SQL
    ``LIKE`` patterns, so ``_`` matches any single character.
    """

    label: str
    host_like: tuple[str, ...] = ()
    utm_like: tuple[str, ...] = ()
    channel_in: tuple[str, ...] = ()
    require_channel: tuple[str, ...] = field(default=())


# The insurance channel rules, in evaluation order.
INSURANCE_RULES: tuple[Rule, ...] = (
    Rule("aggregator",
         host_like=("%comparethemarket%", "%choosi%", "%iselect%"),
         utm_like=("%utm:ctm%", "%utm:comparethemarket%", "%iselect%", "%utm:choosi%")),
    Rule("direct", channel_in=("direct",)),
    Rule("email", channel_in=("email",), utm_like=("%ser-%", "%email%")),
    Rule("pmax", require_channel=("paid search",), utm_like=("%pmax%", "%performance_max%")),
    Rule("paid search", channel_in=("paid search",)),
    Rule("everyday", utm_like=("%utm:rewards%", "%utm:discoverpage%")),
    Rule("social", channel_in=("social",),
         utm_like=("%facebook%", "%tiktok%", "%youtube%", "%instagram%", "%bvod%")),
    Rule("organic search", channel_in=("organic search",)),
)
DEFAULT_LABEL = "other"


def _any(preds: list[Column]) -> Column | None:
    out = None
    for p in preds:
        out = p if out is None else (out | p)
    return out


def rule_condition(rule: Rule, host: Column, utm_lower: Column, channel: Column) -> Column:
    preds = [host.like(p) for p in rule.host_like]
    preds += [utm_lower.like(p) for p in rule.utm_like]
    preds += [channel == F.lit(c) for c in rule.channel_in]
    cond = _any(preds)
    if rule.require_channel:
        req = _any([channel == F.lit(c) for c in rule.require_channel])
        cond = req if cond is None else (req & cond)
    if cond is None:
        raise ValueError(f"rule {rule.label!r} has no condition")
    return cond


def classify(host: Column, utm_lower: Column, channel: Column,
             rules: tuple[Rule, ...] = INSURANCE_RULES,
             default: str = DEFAULT_LABEL) -> Column:
    """Label of the first rule that matches, else ``default``.

    ``host`` should be a precomputed ``url_host`` column and ``utm_lower`` a
    precomputed ``lower(utm)`` column, so each is evaluated once per row.
    """
    expr = None
    for rule in rules:
        cond = rule_condition(rule, host, utm_lower, channel)
        expr = F.when(cond, F.lit(rule.label)) if expr is None else expr.when(cond, F.lit(rule.label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def host_literals(rules: tuple[Rule, ...]) -> tuple[str, ...] | None:
    """The plain substrings behind the rules' host patterns (``%text%`` with
    no other wildcard), or None when some pattern is not of that form."""
    lits = []
    for rule in rules:
        for p in rule.host_like:
            inner = p[1:-1]
            if not (p.startswith("%") and p.endswith("%")) or "%" in inner or "_" in inner or not inner:
                return None
            lits.append(inner)
    return tuple(lits)


@lru_cache(maxsize=64)
def channel_label(host_col: str, utm_lower_col: str, channel_col: str,
                  rules: tuple[Rule, ...] = INSURANCE_RULES,
                  default: str = DEFAULT_LABEL) -> Column:
    """``classify`` over named columns, built once per argument set.

    A Column is an unresolved expression, independent of any DataFrame, so
    the same object is reused by every plan that classifies these columns.
    """
    return classify(F.col(host_col), F.col(utm_lower_col), F.col(channel_col), rules, default)
