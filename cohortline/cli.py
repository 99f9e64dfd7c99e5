"""Command line for the scheduled jobs, for ``spark-submit`` or a scheduler.

    spark-submit --py-files cohortline.zip -m cohortline.cli daily \\
        --tables hits=web.hits,marketing_channel=web.channels,visits=web.visits,\\
policies=ins.policies,callcentre_car=ins.cc_car,callcentre_home=ins.cc_home,calendar=ref.calendar \\
        --orders-table analytics.policy_orders [--today 2025-02-02]

Sub-commands: ``backfill`` (create or replace the policy-orders table over
``--start``..``--end``), ``daily`` (reload the trailing 8 days),
``dashboard`` (create or replace the retention pivot in ``--out-table``),
``report NAME`` (any report: written to ``--out-table``, or its first rows
printed in key order when it is an aggregate). The session is the one ``spark-submit``
provides; its settings are kept.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from cohortline.functions.dates import REPORT_ZONE, today_in, until_last_month_end, until_yesterday
from cohortline.operators.load import full_refresh
from cohortline.plans import jobs
from cohortline.plans import reports as R
from cohortline.session import configure
from cohortline.sources.tables import catalog_inputs

INPUT_NAMES = ("hits", "marketing_channel", "visits", "policies", "callcentre_car",
               "callcentre_home", "calendar")


# Rows of a report that are printed; a longer one goes to a table.
PRINT_ROWS = 1000


def _tables(spec: str) -> dict[str, str]:
    pairs = dict(item.split("=", 1) for item in spec.split(",") if item)
    missing = [n for n in INPUT_NAMES if n not in pairs]
    if missing:
        raise SystemExit(f"--tables is missing {', '.join(missing)}")
    unknown = [n for n in pairs if n not in (*INPUT_NAMES, "hits_day_column")]
    if unknown:
        raise SystemExit(f"--tables does not know {', '.join(unknown)}")
    return pairs


def _columns(spec: str) -> dict[str, dict[str, str]]:
    """``table.column=name`` items as ``{table: {column: name}}``."""
    out: dict[str, dict[str, str]] = {}
    for item in filter(None, spec.split(",")):
        where, _, name = item.partition("=")
        table, _, column = where.partition(".")
        if table not in INPUT_NAMES or not column or not name:
            raise SystemExit(f"--columns: {item!r} is not table.column=name")
        out.setdefault(table, {})[column] = name
    return out


# report name -> (builder, window kind, needs the stored policy orders, group keys)
REPORTS = {
    "policy_orders": (lambda i, o, lo, hi: R.policy_orders(i, lo, hi), "range", False, None),
    "purchases_default": (lambda i, o, lo, hi: R.purchases_by_default_channel(i, lo, hi), "range",
                          False, ["product", "channel_name"]),
    "purchases_custom": (lambda i, o, lo, hi: R.purchases_by_custom_channel(i, lo, hi), "range",
                         False, ["product", "custom_channel"]),
    "reconcile": (lambda i, o, lo, hi: R.reconciliation(i, lo, hi), "range", False, ["product"]),
    "retention_monthly": (R.retention_monthly, "yesterday", True,
                          ["product", "start_month", "custom_channel"]),
    "retention_weekly": (lambda i, o, lo, hi: R.retention_weekly(i, lo, hi), "yesterday", False,
                         ["product", "purchase_week", "custom_channel"]),
    "retention_monthly_manual": (lambda i, o, lo, hi: R.retention_monthly_manual(i, lo, hi),
                                 "yesterday", False, ["product", "purchase_month", "custom_channel"]),
    "dashboard": (R.retention_dashboard, "last_month_end", True,
                  ["product", "purchase_month", "start_month", "utm_param", "custom_channel",
                   "default_channel"]),
}


def _report(spark, inputs, args) -> None:
    if args.name not in REPORTS:
        raise SystemExit(f"unknown report {args.name!r}; one of {', '.join(REPORTS)}")
    build, window, needs_orders, keys = REPORTS[args.name]
    if window == "range":
        if not (args.start and args.end):
            raise SystemExit(f"{args.name} needs --start and --end")
        lo, hi = args.start, args.end
    else:
        if not args.start:
            raise SystemExit(f"{args.name} needs --start (and optionally --today)")
        today = args.today or today_in(REPORT_ZONE)
        lo, hi = (until_yesterday if window == "yesterday" else until_last_month_end)(args.start, today)
    orders = None
    if needs_orders:
        if not args.orders_table:
            raise SystemExit(f"{args.name} reads the stored policy orders: give --orders-table")
        orders = spark.table(args.orders_table).drop(jobs.DAY_PARTITION)
    df = build(inputs, orders, lo, hi)
    if args.out_table:
        full_refresh(df, table=args.out_table)
    elif keys is None:
        raise SystemExit(f"{args.name} is row-level: give --out-table")
    else:
        rows = jobs.present(df, keys).limit(PRINT_ROWS + 1).collect()
        print("\t".join(df.columns))
        for row in rows[:PRINT_ROWS]:
            print("\t".join("" if v is None else str(v) for v in row))
        if len(rows) > PRINT_ROWS:
            print(f"only the first {PRINT_ROWS} rows are printed; give --out-table for all")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cohortline")
    ap.add_argument("command", choices=("backfill", "daily", "dashboard", "report"))
    ap.add_argument("name", nargs="?", help="report name for the report command")
    ap.add_argument("--tables", required=True, help="input=table pairs, comma separated; hits_day_column=NAME "
                                                       "names the hits' day partition, so windows read only their days")
    ap.add_argument("--columns", default="", help="table.column=name pairs for columns with other names, "
                                                  "comma separated")
    ap.add_argument("--orders-table", help="stored policy orders (backfill, daily, dashboard, "
                                             "retention_monthly)")
    ap.add_argument("--out-table", help="output table (dashboard, report)")
    ap.add_argument("--today", type=dt.date.fromisoformat, help="default: today in the report zone")
    ap.add_argument("--start", type=dt.date.fromisoformat)
    ap.add_argument("--end", type=dt.date.fromisoformat)
    ap.add_argument("--once", action="store_true", help="daily: a policy stays on its earliest day")
    ap.add_argument("--horizon", type=int, help="daily --once: days around the window in which that counts; default all")
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.getOrCreate())
    inputs = catalog_inputs(spark, **_tables(args.tables), columns=_columns(args.columns))
    if args.command == "report":
        _report(spark, inputs, args)
        return 0
    if not args.orders_table:
        raise SystemExit(f"{args.command} needs --orders-table")
    if args.command == "backfill":
        if not (args.start and args.end):
            raise SystemExit("backfill needs --start and --end")
        jobs.backfill_policy_orders(inputs, args.orders_table, args.start, args.end)
    elif args.command == "daily":
        lo, hi = jobs.daily_policy_orders(inputs, args.orders_table, today=args.today, once=args.once,
                                              horizon=args.horizon)
        print(f"reloaded {args.orders_table} for {lo}..{hi}")
    else:
        if not args.out_table:
            raise SystemExit("dashboard needs --out-table")
        kw = {"start": args.start} if args.start else {}
        jobs.monthly_dashboard(inputs, args.orders_table, args.out_table, today=args.today, **kw)
    return 0


if __name__ == "__main__":
    sys.exit(main())
