"""The price store: cleaned daily prices laid out by month, so that a look-back window reads its months only.

Months are folders (about 20 trading days of all symbols in a file or a few, sorted by symbol, so row groups of other
symbols are skipped as well).  A load is published as a whole (``sinks/versions.py``): readers see the prices before
or after it, and a failed one changes nothing.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch.sinks.versions import Versions

MONTH = "price_month"
STORED = "stock string, price_date date, close double, close_ts timestamp_ntz"


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def load_prices(spark: SparkSession, base: str, closes: DataFrame) -> str:
    """Adds closes (stock, price_date, close, close_ts) to the store; those of a (stock, day) replace what it had of that day."""
    versions = Versions(spark, base)
    ticket = versions.begin()
    new = closes.select("stock", "price_date", "close", "close_ts")
    try:
        with versions.reading() as live:
            if live:
                old = spark.read.schema(f"{STORED}, {MONTH} date").parquet(live).drop(MONTH)
                days = new.select("stock", "price_date").distinct()
                new = old.join(days, ["stock", "price_date"], "left_anti").unionByName(new)
            laid = new.withColumn(MONTH, month_of(F.col("price_date"))).hint("rebalance", MONTH)
            laid.sortWithinPartitions(MONTH, "stock", "price_date").write.partitionBy(MONTH).parquet(versions.path(ticket))
    except Exception:
        versions.discard(ticket)
        raise
    versions.publish(ticket)
    return base


def prices_between(spark: SparkSession, base: str, first: date, last: date) -> DataFrame:
    """Stored closes of the days ``first`` to ``last``; folders of other months are not opened."""
    live = Versions(spark, base).live_path()
    if live is None:
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(f"{STORED}, {MONTH} date").parquet(live)
    months = F.col(MONTH).between(first.replace(day=1), last.replace(day=1))
    return rows.where(months & F.col("price_date").between(first, last)).drop(MONTH)


def window(spark: SparkSession, base: str, symbols: DataFrame, as_of: str, days: int = P.LOOKBACK_DAYS) -> DataFrame:
    """Stored closes of ``symbols`` in the look-back window that ends ``as_of``."""
    last = date.fromisoformat(as_of)
    return prices_between(spark, base, last - timedelta(days=days), last).join(symbols, "stock", "left_semi")
