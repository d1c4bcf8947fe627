"""Price-side operators on small literal fixtures."""

import datetime as dt
import time

from pyspark.sql import functions as F

from fixtures import closes_from_rows, trades_from_rows
from tradewatch.operators import prices

D = [dt.date(2024, 1, d) for d in range(1, 8)]


def test_latest_price_ties_by_price(spark):
    c = closes_from_rows(spark, [("S", D[0], 5.0), ("S", D[1], 7.0), ("S", D[1], 6.0), ("U", D[0], 1.0)])
    got = {(r.stock, r.price_date, r.close) for r in prices.latest_price(c).collect()}
    assert got == {("S", D[1], 7.0), ("U", D[0], 1.0)}


def test_next_close_and_last_two(spark):
    c = closes_from_rows(spark, [("S", D[0], 5.0), ("S", D[1], 7.0), ("S", D[2], 6.0)])
    nx = {r.price_date: r.next_close for r in prices.next_close(c).collect()}
    assert nx == {D[0]: 7.0, D[1]: 6.0, D[2]: None}
    two = {r.recency: r.close for r in prices.last_two_prices(c).collect()}
    assert two == {1: 6.0, 2: 7.0}
    pair = prices.price_change_latest_pair(c).first()
    assert (pair.prev_close, pair.last_close) == (7.0, 6.0)
    assert round(pair.price_change_pct, 6) == round((6.0 - 7.0) / 7.0 * 100, 6)


def test_lookback_window_edges_and_semi_join(spark):
    c = closes_from_rows(
        spark, [("S", dt.date(2023, 12, 6), 1.0), ("S", dt.date(2023, 12, 5), 1.0), ("S", D[4], 2.0),
                ("S", D[5], 3.0), ("X", D[4], 9.0)]
    )
    symbols = spark.createDataFrame([("S",), ("U",)], "stock string")
    got = {(r.stock, r.price_date) for r in prices.prices_lookback(c, symbols, "2024-01-05", 30).collect()}
    assert got == {("S", dt.date(2023, 12, 6)), ("S", D[4])}  # both ends inclusive, X not traded
    missing = {r.stock for r in prices.symbols_without_prices(symbols, prices.prices_lookback(c, symbols, "2024-01-05")).collect()}
    assert missing == {"U"}


def test_traded_symbols_drop_nulls(spark):
    df = spark.createDataFrame([("S",), (None,), ("S",), ("U",)], "stock string")
    assert {r.stock for r in prices.traded_symbols(df).collect()} == {"S", "U"}


def test_union_prices_layouts(spark):
    hist = prices.history_frame(closes_from_rows(spark, [("S", D[0], 10.456)]))
    lines = spark.createDataFrame([("2024-01-02", "U", 3.0)], "datetime string, stock string, price double")
    got = {tuple(r) for r in prices.union_prices(hist, lines).collect()}
    assert got == {("2024-01-01", "S", 10.46), ("2024-01-02", "U", 3.0)}


def test_trades_with_latest_price(spark):
    t = trades_from_rows(spark, [("S", 10), ("U", 20)])
    c = closes_from_rows(spark, [("S", D[0], 5.0), ("S", D[1], 7.0)])
    got = {(r.stock, r.latest_date, r.current_close) for r in prices.trades_with_latest_price(t, c).collect()}
    assert got == {("S", D[1], 7.0), ("U", None, None)}


def test_asof_strictly_after(spark):
    base = dt.datetime(2024, 1, 1)
    t = trades_from_rows(spark, [("S", 1), ("S", 2)], day=D[0])  # trades at 10:00:00 and 10:00:01
    c = closes_from_rows(spark, [("S", D[0], 5.0, base.replace(hour=10, second=1)), ("S", D[2], 8.0)])
    got = {r.trade_id: (r.next_price) for r in prices.asof_next_price(t, c).collect()}
    # first trade: the same-day close is later; second trade: observed at the same instant -> next day
    assert got == {1: 5.0, 2: 8.0}


def test_trades_between_day_bounds(spark):
    from tradewatch import schemas
    from tradewatch.sources.events import trades_between

    stamps = [dt.datetime(2024, 1, 4, 23, 59, 59, 999999), dt.datetime(2024, 1, 5, 0, 0), dt.datetime(2024, 1, 7, 23, 59),
              dt.datetime(2024, 1, 8, 0, 0)]
    rows = [(i, "T", "S", 1, 1.0, "00:00", ts.date(), ts) for i, ts in enumerate(stamps)]
    t = spark.createDataFrame(rows, schemas.TRADES)
    got = sorted(r.trade_id for r in trades_between(t, "2024-01-05", "2024-01-07").collect())
    assert got == [1, 2]


def test_closes_of_one_day_follow_their_time_not_their_price(spark):
    at = lambda h: dt.datetime(2026, 3, 4, h)
    day = dt.date(2026, 3, 4)
    rows = [("A", day, 100.0, at(10)), ("A", day, 90.0, at(15)), ("B", day, 90.0, at(10)), ("B", day, 100.0, at(15))]
    closes = spark.createDataFrame(rows, "stock string, price_date date, close double, close_ts timestamp_ntz")
    assert {r.stock: r.close for r in prices.latest_price(closes).collect()} == {"A": 90.0, "B": 100.0}
    assert {r.stock: round(r.price_change_pct, 2) for r in prices.price_change_latest_pair(closes).collect()} == {"A": -10.0, "B": 11.11}
    assert {(r.stock, r.close): r.next_close for r in prices.next_close(closes).collect()}[("A", 100.0)] == 90.0
    assert {(r.stock, r.recency): r.close for r in prices.last_two_prices(closes).collect()}[("A", 1)] == 90.0


def test_asof_next_price_of_many_days_of_one_stock(spark):
    """30,000 days in one window partition, in seconds; both ways of finding the days agree."""
    hours = lambda n: F.expr(f"interval {n} hours")
    days = spark.range(30_000).select(
        "id", F.lit("A").alias("stock"), F.date_add(F.to_date(F.lit("1950-01-01")), F.col("id").cast("int")).alias("price_date"), F.col("id").cast("double").alias("close")
    ).withColumn("close_ts", F.col("price_date").cast("timestamp_ntz") + hours(15))
    trade_ts = F.col("close_ts") + F.when(F.col("id") % 2 == 0, hours(1)).otherwise(hours(-1))
    trades = days.select(F.col("id").alias("trade_id"), "stock", F.col("price_date").alias("trade_date"), trade_ts.alias("trade_ts"))
    began = time.time()
    for from_closes in (False, True):
        got = prices.asof_next_price(trades, days.drop("id"), from_closes)
        # before the close: that day's; after it: the next day's
        assert got.where("next_price = trade_id + (1 - trade_id % 2)").count() == 30_000
    assert time.time() - began < 60
