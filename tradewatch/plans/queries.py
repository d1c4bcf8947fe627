"""Registered queries: one callable per SURVEY §2 key, ``(spark, sf_dir) -> DataFrame``.

Inputs are bound from the driver tables (``sources.events``); every query runs
over the whole ``events`` table.  Round-trip keys write to a fresh folder under
the shared folder (``spark.checkpoint.dir``) and return what is read back.
Doubles are rounded to 4 decimals in the returned frames only, because sums
in a different order differ in the last bits between engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions.parsing import seconds_of_day, time_on_date
from tradewatch.operators import alerts, clean, prices, score, stats, summaries
from tradewatch.operators.joins import small_side
from tradewatch.plans import pipeline
from tradewatch.profiles import LATEST_PAIR, LOOKBACK_DAYS, POST_TRADE
from tradewatch.session import configure, scratch_path
from tradewatch.sinks import files, results
from tradewatch.sources import events as ev
from tradewatch.sources import files as src
from tradewatch.sources import price_store
from tradewatch.streaming.arrival import run_on_arrival

# Query parameters (arguments of the operators, fixed here for repeatability).
AS_OF = "2024-01-25"  # price look-back end date
RUN_ID = "20240131_000000"  # run folder name
EARLIER_RUN_ID = "20240130_000000"
NARROW_DAYS = 5  # price look-back of symbols_without_prices
LARGE_QUANTITY = 3_000_000_000  # beyond 32 bits
CSV_AS_OF = "2024-01-31"  # day on which uploaded order times are placed
DETECTED_AT = "2024-01-31 00:00:00"  # detection time stamped on results
HIGH_VOLUME_QUERY_MIN = 350000  # trader total-quantity threshold for the query

Query = Callable[[SparkSession, str], DataFrame]


# --- shared inputs -----------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return ev.read_events(spark, sf)


def _trades(spark: SparkSession, sf: str) -> DataFrame:
    return ev.trades_from_events(_events(spark, sf))


def _closes(spark: SparkSession, sf: str) -> DataFrame:
    return ev.daily_closes(_trades(spark, sf))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return ev.dirty_lines(_events(spark, sf))


def _r4(df: DataFrame) -> DataFrame:
    """Round double columns to 4 decimals (returned frames only)."""
    return df.select(
        *[
            F.round(F.col(f.name), 4).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --- statistics, large trades ------------------------------------------------


def q_stock_stats(spark, sf):
    return _r4(stats.stock_stats(_trades(spark, sf), "samp"))


def q_stock_stats_pop(spark, sf):
    return _r4(stats.stock_stats(_trades(spark, sf), "pop"))


def q_large_trades(spark, sf):
    return _r4(stats.large_trades(_trades(spark, sf), 3.0, "pop"))


def q_large_trades_sample(spark, sf):
    return _r4(stats.large_trades(_trades(spark, sf), 3.0, "samp"))


def q_trades_with_stats(spark, sf):
    t = _trades(spark, sf)
    joined = stats.trades_with_stats(t, stats.stock_stats(t, "samp"))
    return _r4(joined.select("trade_id", "trader_id", "stock", "quantity", "avg_qty", "stddev_qty", "trade_count"))


def q_trade_zscore(spark, sf):
    return _r4(stats.trade_zscore(_trades(spark, sf)))


def q_stock_profile(spark, sf):
    return _r4(stats.stock_profile(_trades(spark, sf)))


# --- summaries ----------------------------------------------------------------


def q_trader_summary(spark, sf):
    return _r4(summaries.trader_summary(_trades(spark, sf)))


def q_stock_summary(spark, sf):
    return _r4(summaries.stock_summary(_trades(spark, sf), "samp"))


def q_stock_summary_pop(spark, sf):
    return _r4(summaries.stock_summary(_trades(spark, sf), "pop"))


def q_high_volume_traders(spark, sf):
    return summaries.high_volume_traders(_trades(spark, sf), HIGH_VOLUME_QUERY_MIN)


def q_traded_symbols(spark, sf):
    return prices.traded_symbols(_trades(spark, sf))


# --- prices -------------------------------------------------------------------


def q_latest_price(spark, sf):
    return _r4(prices.latest_price(_closes(spark, sf)))


def q_next_close(spark, sf):
    return _r4(prices.next_close(_closes(spark, sf)))


def q_latest_price_intraday(spark, sf):
    return _r4(prices.latest_price(ev.half_day_closes(_trades(spark, sf))))


def q_next_close_intraday(spark, sf):
    return _r4(prices.next_close(ev.half_day_closes(_trades(spark, sf))))


def q_last_two_prices_intraday(spark, sf):
    return _r4(prices.last_two_prices(ev.half_day_closes(_trades(spark, sf))))


def q_price_change_intraday(spark, sf):
    return _r4(prices.price_change_latest_pair(ev.half_day_closes(_trades(spark, sf))))


def q_last_two_prices(spark, sf):
    return _r4(prices.last_two_prices(_closes(spark, sf)))


def q_price_change_latest_pair(spark, sf):
    return _r4(prices.price_change_latest_pair(_closes(spark, sf)))


def q_post_trade_change(spark, sf):
    t = _trades(spark, sf)
    return _r4(prices.post_trade_change(t, ev.daily_closes(t)))


def q_trades_with_latest_price(spark, sf):
    t = _trades(spark, sf)
    return _r4(prices.trades_with_latest_price(t, ev.daily_closes(t)))


def q_asof_next_price(spark, sf):
    t = _trades(spark, sf)
    closes = small_side(ev.daily_closes(t), "closes")  # one pass; every trade day has a close
    return _r4(prices.asof_next_price(t, closes, days_from_closes=True))


def _lookback_closes(t: DataFrame) -> DataFrame:
    """Closes of the look-back days only: a day's close needs only that day's
    trades, so the window is applied to the trade scan (pushed to Parquet)."""
    first = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=LOOKBACK_DAYS)).isoformat()
    return ev.daily_closes(ev.trades_between(t, first, AS_OF))


def q_prices_lookback(spark, sf):
    t = _trades(spark, sf)
    return _r4(prices.prices_lookback(_lookback_closes(t).drop("close_ts"), prices.traded_symbols(t), AS_OF))


def q_price_store_lookback(spark, sf):
    """The look-back window read from the price store; a second load corrects some days of the first."""
    t = _trades(spark, sf)
    store, closes = scratch_path(spark, "price_store"), ev.daily_closes(t)
    wrong = F.pmod(F.xxhash64("stock", "price_date"), F.lit(5)) == 0
    price_store.load_prices(spark, store, closes.withColumn("close", F.when(wrong, F.col("close") + 1).otherwise(F.col("close"))))
    price_store.load_prices(spark, store, closes.where(wrong))
    return _r4(price_store.window(spark, store, prices.traded_symbols(t), AS_OF).drop("close_ts"))


def q_symbols_without_prices(spark, sf):
    """Symbols here are (event type, user): many of them have no trade, so no price, in the window."""
    t = _trades(spark, sf).withColumn("stock", F.concat_ws("/", "stock", "trader_id"))
    symbols = prices.traded_symbols(t)
    first = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=NARROW_DAYS)).isoformat()
    window = prices.prices_lookback(ev.daily_closes(ev.trades_between(t, first, AS_OF)), symbols, AS_OF, NARROW_DAYS)
    return prices.symbols_without_prices(symbols, window)


def q_union_prices(spark, sf):
    e = _events(spark, sf)
    history = prices.history_frame(ev.daily_closes(ev.trades_from_events(e)))
    lines = clean.clean_prices(ev.dirty_lines(e))
    return _r4(prices.union_prices(history, lines))


# --- scoring ----------------------------------------------------------------


def _scored(spark, sf, profile, flag_only: bool) -> DataFrame:
    t = _trades(spark, sf)
    st, closes = stats.stats_and_closes(t)  # one pass over trades for both sides
    if flag_only:
        return score.flagged(t, closes, profile, st)
    return _r4(score.score(t, closes, profile, st))


def q_score_post_trade(spark, sf):
    return _scored(spark, sf, POST_TRADE, False)


def q_score_latest_pair(spark, sf):
    return _scored(spark, sf, LATEST_PAIR, False)


def q_flagged_post_trade(spark, sf):
    return _scored(spark, sf, POST_TRADE, True)


def q_flagged_latest_pair(spark, sf):
    return _scored(spark, sf, LATEST_PAIR, True)


def _stored_results(spark, sf) -> DataFrame:
    """The results table after a refresh: alerts are read from what is stored, not scored again."""
    table = _table_name("suspicious_trades")
    results.refresh_results(spark, q_flagged_post_trade(spark, sf), table, DETECTED_AT, scratch_path(spark, "results"))
    return src.read_results(spark, table)


def q_alerts_ranked(spark, sf):
    return alerts.alerts_ranked(_stored_results(spark, sf))


def q_alert_stats(spark, sf):
    return alerts.alert_stats(_stored_results(spark, sf))


def q_alerts_display(spark, sf):
    return alerts.alerts_display(_stored_results(spark, sf))


# --- cleaning, tagging, parsing, times ------------------------------------


def q_clean_orders(spark, sf):
    return clean.clean_orders(_lines(spark, sf))


def q_clean_prices(spark, sf):
    return clean.clean_prices(_lines(spark, sf))


def q_clean_typed_orders(spark, sf):
    return clean.clean_typed_orders(ev.dirty_typed_orders(_events(spark, sf)), require_timestamp=True)


def q_clean_typed_prices(spark, sf):
    return clean.clean_typed_prices(ev.dirty_typed_prices(_events(spark, sf)))


def q_tagged_records(spark, sf):
    path = scratch_path(spark, "tagged")
    files.write_tagged(clean.tagged_records(_lines(spark, sf)), path)
    return files.read_tagged(spark, path)


def _written_tagged(spark, sf) -> DataFrame:
    """The cleaner's output as the scoring job sees it: a written folder of tagged lines."""
    path = scratch_path(spark, "clean")
    clean.tagged_records(_lines(spark, sf)).write.mode("overwrite").text(path)
    return src.read_lines(spark, path)


def q_parse_tagged(spark, sf):
    return clean.parse_tagged(_written_tagged(spark, sf))


def q_parse_tagged_regex(spark, sf):
    return clean.parse_tagged_regex(_written_tagged(spark, sf))


def q_parse_tagged_prices(spark, sf):
    return clean.parse_tagged_prices(_written_tagged(spark, sf))


def q_trade_seconds(spark, sf):
    return _trades(spark, sf).select("trade_id", "timestamp", seconds_of_day("timestamp").alias("trade_seconds"))


def q_order_timestamps(spark, sf):
    orders = clean.clean_orders(_lines(spark, sf))
    return orders.select(
        "trader_id", "stock", "quantity", "timestamp",
        time_on_date(F.to_date(F.lit(AS_OF)), "timestamp").alias("order_ts"),
    )


# --- sinks and round trips ------------------------------------------------------


def q_raw_landing(spark, sf):
    path = scratch_path(spark, "raw")
    files.land_raw(_lines(spark, sf), path)
    return src.read_lines(spark, path)


def q_orders_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "orders_csv")
    orders = _trades(spark, sf).select(*schemas.ORDER_COLUMNS)
    files.write_csv(orders, path)
    # a non-CSV file in the same folder must be ignored by the reader
    orders.select(F.col("trader_id").alias("value")).write.mode("append").text(path)
    return src.read_orders_csv(spark, path)


def q_prices_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "prices_csv")
    closes = _closes(spark, sf).select(F.col("price_date").alias("datetime"), "stock", F.col("close").alias("price"))
    files.write_csv(closes, path)
    return _r4(src.read_prices_csv(spark, path))


def q_large_trades_export(spark, sf):
    path = scratch_path(spark, "large_trades")
    files.write_csv(stats.large_trades(_trades(spark, sf), 3.0, "pop").drop("trade_id"), path, header=False)
    return _r4(spark.read.schema(schemas.LARGE_TRADES).csv(path))


def q_alerts_export(spark, sf):
    path = scratch_path(spark, "alerts_csv")
    flagged = q_flagged_latest_pair(spark, sf).drop("trade_id")
    files.write_csv(flagged, path)
    return spark.read.schema(schemas.ALERTS_EXPORT).option("header", True).csv(path)


def q_insert_overwrite_directory(spark, sf):
    path = scratch_path(spark, "hive")
    view = _table_name("trader_summary_v")
    summaries.trader_summary(_trades(spark, sf)).createOrReplaceTempView(view)
    files.insert_overwrite_directory(spark, view, path)
    spark.catalog.dropTempView(view)
    return _r4(spark.read.schema(schemas.TRADER_SUMMARY).csv(path))


def q_external_table_scan(spark, sf):
    path = scratch_path(spark, "order_table")
    rows = src.order_table_rows(_trades(spark, sf))
    files.write_csv(rows, path, header=False, sep="\t")
    table = src.external_order_table(spark, _table_name("orders_ext"), path)
    return _r4(table.where(F.col("record_type") == "ORDER"))


def q_run_partitioned_write(spark, sf):
    base = scratch_path(spark, "runs")
    t = _trades(spark, sf)
    files.write_run(t, base, EARLIER_RUN_ID)  # an earlier run that must survive
    files.write_run(t.where("quantity > 1000"), base, RUN_ID)
    files.write_run(t, base, RUN_ID)  # replaces only its own run
    return files.read_run(spark, base, schemas.TRADES, EARLIER_RUN_ID).unionByName(files.read_run(spark, base, schemas.TRADES, RUN_ID))


def q_results_refresh(spark, sf):
    table = _table_name("suspicious_trades")
    location = scratch_path(spark, "results")
    # an earlier run under the other profile; the post_trade run must replace all of it
    results.refresh_results(spark, q_flagged_latest_pair(spark, sf), table, DETECTED_AT, location)
    results.refresh_results(spark, q_flagged_post_trade(spark, sf), table, DETECTED_AT, location)
    return src.read_results(spark, table).drop("detected_at")


def q_results_clear(spark, sf):
    table = _table_name("suspicious_trades")
    location = scratch_path(spark, "results")
    results.refresh_results(spark, q_flagged_post_trade(spark, sf), table, DETECTED_AT, location)
    before = src.read_results(spark, table).count()
    results.clear_results(spark, table, location)
    after = src.read_results(spark, table).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select(F.lit(before).cast("long").alias("rows_before"), "rows_after")


def q_stage_counts(spark, sf):
    e = _events(spark, sf)
    out = scratch_path(spark, "pipeline")
    res = pipeline.run(spark, ev.raw_trades_from_events(e), None, out, POST_TRADE, RUN_ID, None, DETECTED_AT)
    rows = [(name, res.counts[name]) for name in pipeline.STAGES]
    return spark.createDataFrame(rows, "stage string, row_count long")


def _order_text(t: DataFrame) -> DataFrame:
    """The five columns of an orders CSV as text."""
    return t.select(*[F.col(c).cast("string").alias(c) for c in schemas.ORDER_COLUMNS], "trade_id")


def q_file_arrival_run(spark, sf):
    """Two uploads in one trigger, in the five-column layout, some rows without a time: each is a full run
    of its own, and the later one's results stay."""
    landing, out = f"{scratch_path(spark, 'my landing 100%')}/landing", scratch_path(spark, "arrival")
    t = _trades(spark, sf)
    rows = _order_text(t)
    files.write_csv(rows.where("quantity < 5000").drop("trade_id"), f"{landing}/first")
    timeless = F.pmod(F.col("trade_id"), F.lit(16)) == 7
    files.write_csv(rows.withColumn("timestamp", F.when(~timeless, F.col("timestamp"))).drop("trade_id"), f"{landing}/second")
    table = _table_name("suspicious_trades")
    q = run_on_arrival(
        spark, landing, ev.daily_closes(t), table, scratch_path(spark, "arrival_ckpt"), LATEST_PAIR, DETECTED_AT, out,
        layout="orders", run_date=CSV_AS_OF,
    )
    q.awaitTermination()
    return src.read_results(spark, table).drop("id", "detected_at")


def q_pipeline_from_csv(spark, sf):
    """The user's path over dirty files: orders with bad and very large quantities, empty fields and bad prices;
    prices with zero, empty and bad values beside the right one of each day.  Two kinds of orders files: their columns
    stand in different orders."""
    orders, history, out = (scratch_path(spark, x) for x in ("orders_csv", "prices_csv", "from_csv"))
    t = _trades(spark, sf)
    v, text = F.pmod(F.col("trade_id"), F.lit(16)), _order_text(t)
    spoiled = {
        "trader_id": F.when(v == 5, F.lit("")).otherwise(F.col("trader_id")),
        "stock": F.when(v == 4, F.lit("")).otherwise(F.col("stock")),
        "quantity": F.when(v == 1, F.lit("0")).when(v == 2, F.concat(F.lit("-"), "quantity")).when(v == 3, F.concat("quantity", F.lit(".5"))).when(v == 8, F.lit(str(LARGE_QUANTITY))).otherwise(F.col("quantity")),
        "price": F.when(v == 6, F.lit("abc")).otherwise(F.col("price")),
        "timestamp": F.when(v == 7, F.lit("")).otherwise(F.col("timestamp")),
    }
    orders_text = text.select(*[c.alias(n) for n, c in spoiled.items()], F.lit("x").alias("desk"), F.pmod(F.col("trade_id"), F.lit(3)).alias("part"))
    files.write_csv(orders_text.where("part = 0").drop("part", "desk"), f"{orders}/a")
    # the same columns in another order, and one more
    files.write_csv(orders_text.where("part <> 0").select("desk", "price", "stock", "timestamp", "quantity", "trader_id"), f"{orders}/b")
    price = F.col("close").cast("string")
    each = F.explode(F.array(price, F.lit("0"), F.lit(""), F.lit("x"), F.lit("-1")))
    files.write_csv(ev.daily_closes(t).select(F.col("price_date").alias("datetime"), "stock", each.alias("price")), history)
    pipeline.run_from_csv(spark, f"{orders}/*", history, out, LATEST_PAIR, CSV_AS_OF, RUN_ID, None, DETECTED_AT)
    return spark.read.schema(schemas.ALERTS_EXPORT).option("header", True).csv(f"{out}/suspicious_trades/run_id={RUN_ID}")


QUERIES: dict[str, Query] = {
    "alert_stats": q_alert_stats,
    "alerts_display": q_alerts_display,
    "alerts_export": q_alerts_export,
    "alerts_ranked": q_alerts_ranked,
    "asof_next_price": q_asof_next_price,
    "clean_orders": q_clean_orders,
    "clean_prices": q_clean_prices,
    "clean_typed_orders": q_clean_typed_orders,
    "clean_typed_prices": q_clean_typed_prices,
    "external_table_scan": q_external_table_scan,
    "file_arrival_run": q_file_arrival_run,
    "flagged_latest_pair": q_flagged_latest_pair,
    "flagged_post_trade": q_flagged_post_trade,
    "high_volume_traders": q_high_volume_traders,
    "insert_overwrite_directory": q_insert_overwrite_directory,
    "large_trades": q_large_trades,
    "large_trades_sample": q_large_trades_sample,
    "large_trades_export": q_large_trades_export,
    "last_two_prices": q_last_two_prices,
    "last_two_prices_intraday": q_last_two_prices_intraday,
    "latest_price": q_latest_price,
    "latest_price_intraday": q_latest_price_intraday,
    "next_close": q_next_close,
    "next_close_intraday": q_next_close_intraday,
    "order_timestamps": q_order_timestamps,
    "orders_csv_roundtrip": q_orders_csv_roundtrip,
    "parse_tagged": q_parse_tagged,
    "parse_tagged_prices": q_parse_tagged_prices,
    "parse_tagged_regex": q_parse_tagged_regex,
    "pipeline_from_csv": q_pipeline_from_csv,
    "post_trade_change": q_post_trade_change,
    "price_change_intraday": q_price_change_intraday,
    "price_change_latest_pair": q_price_change_latest_pair,
    "prices_csv_roundtrip": q_prices_csv_roundtrip,
    "price_store_lookback": q_price_store_lookback,
    "prices_lookback": q_prices_lookback,
    "raw_landing": q_raw_landing,
    "results_clear": q_results_clear,
    "results_refresh": q_results_refresh,
    "run_partitioned_write": q_run_partitioned_write,
    "score_latest_pair": q_score_latest_pair,
    "score_post_trade": q_score_post_trade,
    "stage_counts": q_stage_counts,
    "stock_profile": q_stock_profile,
    "stock_stats": q_stock_stats,
    "stock_stats_pop": q_stock_stats_pop,
    "stock_summary": q_stock_summary,
    "stock_summary_pop": q_stock_summary_pop,
    "symbols_without_prices": q_symbols_without_prices,
    "tagged_records": q_tagged_records,
    "trade_seconds": q_trade_seconds,
    "trade_zscore": q_trade_zscore,
    "traded_symbols": q_traded_symbols,
    "trader_summary": q_trader_summary,
    "trades_with_latest_price": q_trades_with_latest_price,
    "trades_with_stats": q_trades_with_stats,
    "union_prices": q_union_prices,
}
