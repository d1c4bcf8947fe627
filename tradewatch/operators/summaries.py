"""Trader and stock summaries (grouped aggregates, two-phase)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch import profiles as P

_SPREAD = {"samp": F.stddev_samp, "pop": F.stddev_pop}


def trader_summary(orders: DataFrame) -> DataFrame:
    """Per trader: count, total quantity, mean and max price; biggest first."""
    agg = orders.groupBy("trader_id").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("quantity").alias("total_quantity"),
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
    )
    return agg.orderBy(F.desc("total_quantity"), "trader_id")


def stock_summary(orders: DataFrame, spread: str = "samp") -> DataFrame:
    """Per stock: count, mean and spread of quantity, mean price; by mean quantity."""
    agg = orders.groupBy("stock").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("quantity").alias("avg_quantity"),
        _SPREAD[spread]("quantity").alias("stddev_quantity"),
        F.avg("price").alias("avg_price"),
    )
    return agg.orderBy(F.desc("avg_quantity"), "stock")


def stock_summary_from(moments: DataFrame, spread: str = "samp") -> DataFrame:
    """Stock summary from precomputed per-stock moments (see ``stats.stock_moments``)."""
    return moments.select(
        "stock",
        "trade_count",
        F.col("avg_qty").alias("avg_quantity"),
        F.col(f"stddev_{spread}").alias("stddev_quantity"),
        "avg_price",
    ).orderBy(F.desc("avg_quantity"), "stock")


def high_volume_from(trader_summary_df: DataFrame, min_volume: int = P.HIGH_VOLUME_MIN) -> DataFrame:
    """High-volume traders from a (written) trader summary: no second pass over orders."""
    return (
        trader_summary_df.where(F.col("total_quantity") > min_volume)
        .select("trader_id", F.col("total_quantity").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "trader_id")
    )


def high_volume_traders(orders: DataFrame, min_volume: int = P.HIGH_VOLUME_MIN) -> DataFrame:
    """Traders whose total quantity exceeds ``min_volume`` (HAVING)."""
    agg = orders.groupBy("trader_id").agg(F.sum("quantity").alias("total_volume"))
    return agg.where(F.col("total_volume") > min_volume).orderBy(F.desc("total_volume"), "trader_id")
