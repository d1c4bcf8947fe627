"""Command line: run the pipeline on an orders CSV, read the alerts back.

    python -m tradewatch prices --prices PRICES_CSV --store DIR
    python -m tradewatch run --orders ORDERS_CSV [--prices PRICES_CSV] [--store DIR] --out DIR
                             [--profile post_trade|latest_pair] [--as-of YYYY-MM-DD] [--run-id ID]
    python -m tradewatch alerts --results DIR [--top N]

``run`` reads orders with a header (trader_id, stock, quantity, price,
timestamp = HH:mm; only ``*.csv`` files) and daily closes (datetime, stock,
price), cleans both, places the order times on ``--as-of``, uses the prices of
the traded symbols in the look-back window before it, and writes every layer
under ``DIR/<layer>/run_id=<id>``.  ``prices`` loads price files into a store that later runs read
(``--store``, with or without new ``--prices``).  ``alerts`` prints the dashboard figures (total,
critical, moderate) and the highest-scored alerts.
"""

from __future__ import annotations

import argparse
import sys

from tradewatch.operators import alerts
from tradewatch.plans import pipeline
from tradewatch.profiles import PROFILES
from tradewatch.session import build_session

SHOWN_SYMBOLS = 20  # symbols without prices that ``run`` prints


def cmd_run(args) -> int:
    spark = build_session(master=args.master)
    res = pipeline.run_from_csv(spark, args.orders, args.prices, args.out, PROFILES[args.profile], args.as_of, args.run_id, store=args.store)
    for stage in pipeline.STAGES:
        print(f"{stage}: {res.counts[stage]}")
    unpriced = res.unpriced.count()
    print(f"symbols without prices: {unpriced}")
    if unpriced:
        res.unpriced.orderBy("stock").show(SHOWN_SYMBOLS, truncate=False)
    return 0


def cmd_prices(args) -> int:
    pipeline.load_price_store(build_session(master=args.master), args.prices, args.store)
    return 0


def cmd_alerts(args) -> int:
    spark = build_session(master=args.master)
    res = spark.read.parquet(args.results)
    alerts.alert_stats(res).show(truncate=False)
    alerts.alerts_display(alerts.alerts_ranked(res)).show(args.top, truncate=False)
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tradewatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="run the pipeline on an orders CSV")
    run.add_argument("--orders", required=True)
    run.add_argument("--prices", default=None)
    run.add_argument("--store", default=None, help="a price store (default: one of this run)")
    run.add_argument("--out", required=True)
    run.add_argument("--profile", choices=sorted(PROFILES), default="latest_pair")
    run.add_argument("--as-of", default=None, help="date the order times belong to (default: today)")
    run.add_argument("--run-id", default=None)
    run.add_argument("--master", default="local[*]")
    load = sub.add_parser("prices", help="load price files into a price store")
    load.add_argument("--prices", required=True)
    load.add_argument("--store", required=True)
    load.add_argument("--master", default="local[*]")
    al = sub.add_parser("alerts", help="print alert counts and the highest-scored alerts")
    al.add_argument("--results", required=True, help="a results folder written by run")
    al.add_argument("--top", type=int, default=20)
    al.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)
    if args.cmd == "prices":
        return cmd_prices(args)
    if args.cmd == "run":
        if not args.prices and not args.store:
            ap.error("run needs --prices, --store or both")
        if args.as_of is None:
            import datetime as dt

            args.as_of = dt.date.today().isoformat()
        return cmd_run(args)
    return cmd_alerts(args)


if __name__ == "__main__":
    sys.exit(main())
