"""Print the physical plan tree (``explain("formatted")`` header) of registered queries.

    python tools/show_plans.py [--sf DIR] [key ...] > PLANS.md

Queries are executed once first, so adaptive plans show their final shape
(broadcasts chosen, skew splits, coalesced partitions).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = [
    "flagged_post_trade",
    "flagged_latest_pair",
    "large_trades",
    "asof_next_price",
    "last_two_prices",
    "stock_profile",
    "trader_summary",
    "clean_orders",
    "prices_lookback",
    "price_store_lookback",
]


def tree(df) -> str:
    df.collect()
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    shown, _, details = text.partition("\n\n\n")
    # what the scans skip: folders and row groups
    filters = [line for line in details.split("\n") if line.startswith(("PartitionFilters:", "PushedFilters:"))]
    return "\n".join([shown.strip(), *dict.fromkeys(filters)])


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from tradewatch.plans.queries import QUERIES
    from tradewatch.session import build_session

    spark = build_session()
    print("# Physical plans\n")
    print(f"Final adaptive plans of registered queries on `{args.sf}` (`python tools/show_plans.py`).\n")
    for key in args.keys or DEFAULT:
        print(f"## {key}\n\n```\n{tree(QUERIES[key](spark, args.sf))}\n```\n")


if __name__ == "__main__":
    main()
