"""Reuse of Column expressions built from plain arguments.

A Column is an unresolved expression tree, independent of any DataFrame or
session state, so the same object can serve every plan that needs it.
Building one from Python costs several JVM round trips per node; reports
that are planned repeatedly (a bench, a notebook, a multi-report job)
rebuild the same expressions. ``column_memo`` keeps the result for calls
whose arguments are all hashable (column names, dates, numbers, tuples);
calls with Column arguments are built as usual.
"""

from __future__ import annotations

import functools


def column_memo(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        key = (args, tuple(sorted(kwargs.items())))
        try:
            hit = cache.get(key)
        except TypeError:  # a Column argument: not hashable
            return fn(*args, **kwargs)
        if hit is None:
            hit = cache[key] = fn(*args, **kwargs)
        return hit

    wrapper.cache_clear = cache.clear
    return wrapper
