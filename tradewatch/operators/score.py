"""Scoring and flagging of trades under a profile.

Trades are never shuffled for scoring: per-stock statistics and price moves
are small derived sides joined with size-checked broadcasts, so the whole
score is one pipelined stage over the trade scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions import scoring
from tradewatch.operators.joins import Side, join_small
from tradewatch.operators.prices import next_close, one_close_per_day, price_change_latest_pair
from tradewatch.operators.stats import stock_stats
from tradewatch.profiles import Profile

SCORED_COLUMNS = [
    "trade_id", "trader_id", "stock", "quantity", "avg_qty", "stddev_qty",
    "price_change_pct", "size_score", "price_score", "suspicion_score",
]


def with_price_move(trades: DataFrame, closes: DataFrame | Side, profile: Profile) -> DataFrame:
    """Adds ``price_change_pct`` (0 when unknown).

    When ``closes`` is already materialised, the derived move table needs no
    write of its own: it never has more rows than the closes (one close per
    day, then a window; or one row per stock), so the closes' count is its
    proven broadcast bound and the derivation runs inside the broadcast.
    """
    known = closes if isinstance(closes, Side) else None
    if isinstance(closes, Side):
        closes = closes.df

    def side(df: DataFrame) -> DataFrame | Side:
        return Side(df, known.rows, known.text_bytes) if known is not None else df

    if profile.price_move == "post_trade":
        nx = next_close(one_close_per_day(closes)).withColumnRenamed("price_date", "trade_date")
        joined = join_small(trades, side(nx), ["stock", "trade_date"], "left")
        return joined.withColumn("price_change_pct", scoring.price_change_pct("close", "next_close")).drop(
            "close", "next_close"
        )
    change = price_change_latest_pair(closes).select("stock", "price_change_pct")
    joined = join_small(trades, side(change), "stock", "left")
    return joined.withColumn("price_change_pct", F.coalesce(F.col("price_change_pct"), F.lit(0.0)))


def score(trades: DataFrame, closes: DataFrame | Side, profile: Profile, stats: Side | None = None) -> DataFrame:
    """Every trade with its size, price and suspicion scores.

    ``stddev_qty`` is the spread actually used: raw sample sd (post_trade) or
    the floored one (latest_pair).  ``stats`` may be passed in already
    materialised (see ``stats.stats_and_closes``); otherwise it is computed.
    """
    if stats is None:
        stats = stock_stats(trades, "samp")
    df = join_small(trades, stats, "stock", "left").drop("trade_count")
    if profile.floor:
        df = df.withColumn("stddev_qty", scoring.floored_spread("avg_qty", "stddev_qty"))
    df = with_price_move(df, closes, profile)
    size = scoring.size_score("quantity", "avg_qty", "stddev_qty", profile.floor)
    df = df.withColumn("size_score", size).withColumn("price_score", scoring.price_score("price_change_pct"))
    df = df.withColumn("suspicion_score", scoring.suspicion_score("size_score", "price_score"))
    return df.select(*SCORED_COLUMNS)


def flag(scored: DataFrame, profile: Profile) -> DataFrame:
    """Trades over the profile's threshold, with the reason text."""
    hit = scored.where(F.col("suspicion_score") > profile.threshold)
    why = scoring.reason("quantity", "avg_qty", "stddev_qty", "price_change_pct", profile)
    return hit.select("trade_id", "trader_id", "stock", "quantity", why.alias("reason"), "suspicion_score")


def flagged(trades: DataFrame, closes: DataFrame | Side, profile: Profile, stats: Side | None = None) -> DataFrame:
    return flag(score(trades, closes, profile, stats), profile)
