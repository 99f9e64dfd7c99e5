"""Report parameters used by the registered queries, the tests and the bench.

Upstream jobs take "today" from the clock; here every date is an explicit
value so results are reproducible. They are chosen to cover the test data:
hits span 2024-01-01..2024-01-30 and policies start in January/February 2024.
"""

from __future__ import annotations

import datetime as dt

from cohortline.functions.dates import month_ends, rolling_days, until_last_month_end, until_yesterday

D = dt.date

# Purchase reports (default / custom channel, reconciliation): one month.
PURCHASE_WINDOW = (D(2024, 1, 1), D(2024, 1, 31))

# Daily policy-orders refresh: run "today"; window is today-8 .. today-1.
DAILY_TODAY = D(2024, 1, 25)
DAILY_WINDOW = rolling_days(DAILY_TODAY, 8, 1)

# Once-off policy-orders backfill.
BACKFILL_WINDOW = (D(2024, 1, 1), D(2025, 4, 8))

# Retention reports.
RETENTION_START = D(2024, 1, 1)
SCHEDULED_TODAY = D(2025, 2, 2)                                  # monthly, scheduled
SCHEDULED_WINDOW = until_yesterday(RETENTION_START, SCHEDULED_TODAY)
DASHBOARD_TODAY = D(2025, 2, 15)                                 # dashboard pivot
DASHBOARD_WINDOW = until_last_month_end(RETENTION_START, DASHBOARD_TODAY)
WEEKLY_TODAY = D(2025, 2, 2)                                     # weekly, manual
WEEKLY_WINDOW = until_yesterday(RETENTION_START, WEEKLY_TODAY)
MONTHLY_MANUAL_TODAY = D(2024, 3, 21)                            # monthly, manual (young cohorts)
MONTHLY_MANUAL_WINDOW = until_yesterday(RETENTION_START, MONTHLY_MANUAL_TODAY)

# Per-policy lifecycle flags.
LIFECYCLE_REPORT_END = D(2025, 2, 1)

# Reports as of many days: every month end until all flags of the test policies are known.
ASOF_ENDS = tuple(month_ends(D(2024, 1, 1), D(2026, 4, 30)))

# The report windows at a fixed instant (already the next day in the report zone).
WINDOWS_INSTANT = dt.datetime(2024, 1, 24, 14, 30)               # UTC
WINDOWS_START = D(2024, 1, 5)
