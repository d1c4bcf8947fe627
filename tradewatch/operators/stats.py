"""Per-stock statistics, large trades and z-scores.

Statistics are grouped aggregates (partial + final), so skewed stocks are
combined map-side; the per-stock result is joined back with a size-checked
broadcast rather than a window over all trades of a stock.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.functions import scoring
from tradewatch.functions.ordering import time_then_id_key
from tradewatch.operators.joins import Side, join_small, small_side

_SPREAD = {"samp": F.stddev_samp, "pop": F.stddev_pop}


def stock_stats(trades: DataFrame, spread: str = "samp") -> DataFrame:
    """stock, avg_qty, stddev_qty, trade_count."""
    return trades.groupBy("stock").agg(
        F.avg("quantity").alias("avg_qty"),
        _SPREAD[spread]("quantity").alias("stddev_qty"),
        F.count(F.lit(1)).alias("trade_count"),
    )


def stock_moments(trades: DataFrame) -> DataFrame:
    """Every per-stock figure the pipeline needs, in one aggregate:
    trade_count, avg_qty, stddev_samp, stddev_pop, avg_price."""
    return trades.groupBy("stock").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("quantity").alias("avg_qty"),
        F.stddev_samp("quantity").alias("stddev_samp"),
        F.stddev_pop("quantity").alias("stddev_pop"),
        F.avg("price").alias("avg_price"),
    )


def stats_from_moments(moments: Side, spread: str) -> Side:
    """The (stock, avg_qty, stddev_qty, trade_count) side for one spread estimator."""
    df = moments.df.select("stock", "avg_qty", F.col(f"stddev_{spread}").alias("stddev_qty"), "trade_count")
    return Side(df, moments.rows, moments.text_bytes)


def moments_and_closes(trades: DataFrame) -> tuple[Side, Side]:
    """Per-stock moments and per-(stock, day) closes from ONE pass over trades.

    ``GROUPING SETS ((stock), (stock, trade_date))`` aggregates both levels in
    one scan with map-side partial aggregation; the result is written once to
    the shared folder, partitioned by level (reads of one level prune the
    other), and row counts and text bytes are observed on that write.  Used when
    the closes derive from the same trades (the driver-table binding).
    """
    from pyspark.sql import Observation

    from tradewatch.session import scratch_path

    order = time_then_id_key("trade_ts", "trade_id")  # fixed width: keeps hash aggregation
    both = trades.groupingSets([["stock"], ["stock", "trade_date"]], "stock", "trade_date").agg(
        F.grouping_id().alias("level"),  # 1: per stock, 0: per stock and day
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("quantity").alias("avg_qty"),
        F.stddev_samp("quantity").alias("stddev_samp"),
        F.stddev_pop("quantity").alias("stddev_pop"),
        F.avg("price").alias("avg_price"),
        F.max_by("price", order).alias("close"),
        F.max("trade_ts").alias("close_ts"),
    )
    spark = trades.sparkSession
    path = scratch_path(spark, "stock_day_sides")
    obs = Observation(f"stock_day_sides_{uuid.uuid4().hex[:8]}")
    level = F.col("level")
    figures = []
    for k, name in ((1, "stocks"), (0, "days")):
        figures += [F.count_if(level == k).alias(name), F.sum(F.when(level == k, F.octet_length("stock")).otherwise(0)).alias(f"{name}_text")]
    both.observe(obs, *figures).write.mode("overwrite").partitionBy("level").parquet(path)
    table = spark.read.schema(both.schema).parquet(path)
    seen = obs.get
    moments = table.where(level == 1).select("stock", "trade_count", "avg_qty", "stddev_samp", "stddev_pop", "avg_price")
    closes = table.where(level == 0).select("stock", F.col("trade_date").alias("price_date"), "close", "close_ts")
    return tuple(Side(df, int(seen[name]), int(seen[f"{name}_text"] or 0)) for df, name in ((moments, "stocks"), (closes, "days")))


def stats_and_closes(trades: DataFrame) -> tuple[Side, Side]:
    """Scoring statistics (sample spread) and closes from one pass."""
    moments, closes = moments_and_closes(trades)
    return stats_from_moments(moments, "samp"), closes


def trades_with_stats(trades: DataFrame, stats: DataFrame, how: str = "left") -> DataFrame:
    return join_small(trades, stats, "stock", how)


def large_trades(trades: DataFrame, sigma: float = 3.0, spread: str = "pop", stats: Side | None = None) -> DataFrame:
    """Trades with quantity > avg + sigma * sd of their stock (inner join).

    ``stats`` may be an already materialised side for the same spread.
    """
    if stats is None:
        stats = stock_stats(trades, spread)
    joined = join_small(trades, stats, "stock", "inner")
    return joined.where(scoring.is_large("quantity", "avg_qty", "stddev_qty", sigma)).select(
        "trade_id", "trader_id", "stock", "quantity", "price", "timestamp", "avg_qty", "stddev_qty"
    )


def trade_zscore(trades: DataFrame) -> DataFrame:
    """z-score of each trade against its stock's sample spread."""
    joined = trades_with_stats(trades, stock_stats(trades, "samp"))
    return joined.select(
        "trade_id", "stock", "quantity", "avg_qty", "stddev_qty",
        scoring.zscore("quantity", "avg_qty", "stddev_qty").alias("z_score"),
    )


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact (interpolated) median of ``value`` per ``group``: columns group, median."""
    return median_of_counts(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("c")), group, value)


def median_of_counts(freq: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median from counted (group, value) pairs (``c``), a hash aggregate distributed over both keys.

    1. Range-partition the pairs by (group, value) and tag each with its
       range partition; written once, so every later pass sees the same ranges.
       A hot group's distinct values are spread over several range slices.
    2. Per (group, slice) totals are tiny; their running sum per group gives
       each slice's offset.  The running count is then taken only inside a
       slice, so no task ever sorts a whole group.
    3. The two middle ranks are located and averaged.
    """
    freq = freq.where(F.col(value).isNotNull()).select(group, value, "c")
    tagged = small_side(freq.repartitionByRange(group, value).withColumn("slice", F.spark_partition_id()), "median_slices")

    totals = tagged.df.groupBy(group, "slice").agg(F.sum("c").alias("t"))
    earlier = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group, "slice",
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("before"),
        F.sum("t").over(Window.partitionBy(group)).alias("n"),
    )
    # at most one offset row per (group, slice): bounded by the slices' row count
    with_offsets = join_small(tagged.df, Side(offsets, tagged.rows, tagged.text_bytes), [group, "slice"], "inner")
    inside = Window.partitionBy(group, "slice").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = with_offsets.select(group, value, "c", "n", (F.col("before") + F.sum("c").over(inside)).alias("upto"))

    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.ceil((F.col("n") - 1) / 2)

    def holds(rank):  # 0-based rank ``rank`` falls on this distinct value
        return (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))

    middle = ranked.where(holds(lo) | holds(hi))
    return middle.groupBy(group).agg(
        ((F.max(F.when(holds(lo), F.col(value))) + F.max(F.when(holds(hi), F.col(value)))) / 2).alias("median")
    )


def stock_profile(trades: DataFrame) -> DataFrame:
    """Median price, largest and mean quantity, and the concentration mark."""
    # one scan of the trades: (stock, price) pairs carry all three figures
    pairs = small_side(
        trades.groupBy("stock", "price").agg(
            F.count(F.lit(1)).alias("c"), F.max("quantity").alias("q_max"), F.sum("quantity").alias("q_sum"), F.count("quantity").alias("q_n")
        ),
        "stock_prices",
    ).df
    agg = pairs.groupBy("stock").agg(F.max("q_max").alias("max_qty"), F.try_divide(F.sum("q_sum"), F.sum("q_n")).alias("avg_qty"))
    med = median_of_counts(pairs, "stock", "price").withColumnRenamed("median", "median_price")
    prof = agg.join(med, "stock", "left")
    return prof.select(
        "stock", "median_price", "max_qty", "avg_qty", (F.col("max_qty") > F.col("avg_qty") * 2).alias("concentrated")
    )
