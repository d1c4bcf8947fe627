"""Price-side operators: latest close, next close, last two closes, look-back,
post-trade and as-of price lookups.

Windows here run over *closes* (one row per stock and day), never over trades,
so a stock's window partition is bounded by the number of days, not by how
many trades the stock has.  Trades meet prices through equi-joins on
(stock, day) with a size-checked broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch.functions import scoring
from tradewatch.operators.joins import Side, join_small


def one_close_per_day(closes: DataFrame) -> DataFrame:
    """At most one close per (stock, day): the last observed, ties by the higher price.

    Price sources may carry a day twice; joins on (stock, day) must not fan out.
    """
    key = F.struct("close_ts", "close")
    last = closes.groupBy("stock", "price_date").agg(F.max_by(key, key).alias("c"))
    return last.select("stock", "price_date", F.col("c.close").alias("close"), F.col("c.close_ts").alias("close_ts"))


def _timed(closes: DataFrame) -> DataFrame:
    """Closes with a ``close_ts`` (null where the source has no time)."""
    return closes if "close_ts" in closes.columns else closes.withColumn("close_ts", F.lit(None).cast("timestamp_ntz"))


# Closes of a stock follow each other by day, then by time.  Only where no time is known does the price
# decide between closes of one day; such a pair then always reads as a rise.
_ORDER = ("price_date", "close_ts", "close")


def latest_price(closes: DataFrame) -> DataFrame:
    """Newest close per stock: by day, then time, then price.

    Deterministic ``max_by`` instead of sort + dropDuplicates.
    """
    key = F.struct(*_ORDER)
    latest = _timed(closes).groupBy("stock").agg(F.max_by(key, key).alias("l"))
    return latest.select("stock", F.col("l.price_date").alias("price_date"), F.col("l.close").alias("close"))


def next_close(closes: DataFrame) -> DataFrame:
    """Each close with the stock's following close."""
    w = Window.partitionBy("stock").orderBy(*_ORDER)
    return _timed(closes).select("stock", "price_date", "close", F.lead("close", 1).over(w).alias("next_close"))


def last_two_prices(closes: DataFrame) -> DataFrame:
    """The two newest closes per stock (recency 1 = newest).

    ``row_number() <= 2`` is planned with a partial window group limit ahead
    of the shuffle, so each task ships at most two rows per stock.
    """
    w = Window.partitionBy("stock").orderBy(*map(F.desc, _ORDER))
    ranked = _timed(closes).select("stock", "price_date", "close", F.row_number().over(w).alias("recency"))
    return ranked.where(F.col("recency") <= 2)


def price_change_latest_pair(closes: DataFrame) -> DataFrame:
    """Change between the last two closes per stock; 0 with fewer than two."""
    two = last_two_prices(closes)
    pair = two.groupBy("stock").agg(
        F.max(F.when(F.col("recency") == 2, F.col("close"))).alias("prev_close"),
        F.max(F.when(F.col("recency") == 1, F.col("close"))).alias("last_close"),
    )
    return pair.withColumn("price_change_pct", scoring.price_change_pct("prev_close", "last_close"))


def post_trade_change(trades: DataFrame, closes: DataFrame) -> DataFrame:
    """Trade -> that day's close and the stock's next close; change % (0 if missing)."""
    nx = next_close(one_close_per_day(closes)).withColumnRenamed("price_date", "trade_date")
    joined = join_small(trades, nx, ["stock", "trade_date"], "left")
    return joined.select(
        "trade_id", "stock", "trade_date", "close", "next_close",
        scoring.price_change_pct("close", "next_close").alias("price_change_pct"),
    )


def trades_with_latest_price(trades: DataFrame, closes: DataFrame) -> DataFrame:
    """Each trade with its stock's newest close (left join on stock)."""
    latest = latest_price(closes).select(
        "stock", F.col("price_date").alias("latest_date"), F.col("close").alias("current_close")
    )
    joined = join_small(trades, latest, "stock", "left")
    return joined.select("trade_id", "trader_id", "stock", "quantity", "latest_date", "current_close")


def asof_next_price(trades: DataFrame, closes: DataFrame | Side, days_from_closes: bool = False) -> DataFrame:
    """First close observed strictly after each trade (forward as-of join).

    A close is observed at ``close_ts`` on its own day.  For a trade on day d
    the answer is d's close when observed later than the trade, otherwise the
    first close on a later day.  "First close after day d" is found on the
    small (stock, day) sides with a window over days; trades then take both
    candidates through one equi-join on (stock, day), so the hot stock is
    spread over its days instead of sorted in one task.

    ``days_from_closes``: the closes derive from the same trades, so every
    trade day has a close and the closes' keys are the trade days - no
    separate pass over trades for them.  With materialised closes the lookup
    then has at most the closes' row count and is broadcast without a write.
    """
    known = closes if isinstance(closes, Side) and days_from_closes else None
    if isinstance(closes, Side):
        closes = closes.df
    obs = one_close_per_day(closes)
    if days_from_closes:
        by_day = Window.partitionBy("stock").orderBy("price_date")
        lookup = obs.select("*", F.lead("close").over(by_day).alias("after_close"), F.lead("close_ts").over(by_day).alias("after_ts"))
    else:
        days = trades.select("stock", F.col("trade_date").alias("price_date")).distinct()
        marked = obs.withColumn("kind", F.lit(0)).unionByName(days.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        # newest first, so "the next close" is the last one already passed: the frame only grows and stays linear
        later = Window.partitionBy("stock").orderBy(F.desc("price_date"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
        passed = F.last(F.when(F.col("kind") == 0, F.struct("close", "close_ts")), ignorenulls=True).over(later)
        after = (
            marked.withColumn("nx", passed)
            .where(F.col("kind") == 1)
            .select("stock", "price_date", F.col("nx.close").alias("after_close"), F.col("nx.close_ts").alias("after_ts"))
        )
        lookup = after.join(obs, ["stock", "price_date"], "left")
    lookup = lookup.withColumnRenamed("price_date", "trade_date")
    joined = join_small(trades, Side(lookup, known.rows, known.text_bytes) if known is not None else lookup, ["stock", "trade_date"], "left")
    same_day = F.col("close_ts") > F.col("trade_ts")
    return joined.select(
        "trade_id", "stock", "trade_ts",
        F.when(same_day, F.col("close")).otherwise(F.col("after_close")).alias("next_price"),
        F.when(same_day, F.col("close_ts")).otherwise(F.col("after_ts")).alias("next_price_ts"),
    )


def traded_symbols(orders: DataFrame) -> DataFrame:
    return orders.select("stock").where(F.col("stock").isNotNull()).distinct()


def prices_lookback(prices: DataFrame, symbols: DataFrame, as_of: str, days: int = P.LOOKBACK_DAYS) -> DataFrame:
    """Prices of traded symbols within [as_of - days, as_of]."""
    end = F.to_date(F.lit(as_of))
    window = prices.where(F.col("price_date").between(F.date_sub(end, days), end))
    return window.join(symbols, "stock", "left_semi")


def symbols_without_prices(symbols: DataFrame, prices: DataFrame) -> DataFrame:
    priced = prices.select("stock").distinct()  # pre-aggregated before the anti-join
    return symbols.join(priced, "stock", "left_anti")


def history_frame(closes: DataFrame) -> DataFrame:
    """A price history in exchange layout: Date, Close and a symbol column."""
    return closes.select(F.col("price_date").alias("Date"), F.col("close").alias("Close"), "stock")


def union_prices(*frames: DataFrame) -> DataFrame:
    """Concatenate price frames into (datetime, stock, price), price to 2 decimals.

    Frames may come in exchange layout (Date, Close) or price-line layout
    (datetime, stock, price); columns are renamed, then unioned by name.
    """
    def normal(df: DataFrame) -> DataFrame:
        if "Date" in df.columns:
            df = df.withColumnsRenamed({"Date": "datetime", "Close": "price"})
        return df.select(
            F.col("datetime").cast("string").alias("datetime"), "stock", F.round(F.col("price"), 2).alias("price")
        )

    return reduce(DataFrame.unionByName, [normal(f) for f in frames])
