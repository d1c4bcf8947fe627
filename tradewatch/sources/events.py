"""Binding of the driver's ``events`` table to the trade domain.

    trade_id  = event_id             stock     = event_type
    trader_id = 'T' || user_id       quantity  = int(round(value * 100))
    price     = props.k + 1          timestamp = HH:mm of ts, trade_date = date of ts
    daily close = price of the last trade of (stock, day), by ts then trade_id

Cleaning operators need dirty text; ``dirty_lines`` derives it from every
event (one order line and one price line each), spoiling lines by a fixed
rule on the event id so that each defect class from the cleaner appears.
All work is per row (narrow) and grows with the table.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions.ordering import time_then_id_key
from tradewatch.profiles import Profile


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def props_k(kind: str = "double") -> Column:
    """``props.k`` as a number (malformed JSON or value -> null).

    ``get_json_object`` generates code, so the scan, binding and validity
    filter stay in one whole-stage-codegen stage; ``from_json`` would drop the
    filter to interpreted evaluation (it is a codegen-fallback expression).
    """
    return F.get_json_object("props", "$.k").try_cast(kind)


def raw_trades_from_events(events: DataFrame) -> DataFrame:
    """Typed trades as they arrive, before the validity rules."""
    k = props_k("double")
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trader_id"),
        F.col("event_type").alias("stock"),
        F.round(F.col("value") * 100).try_cast("bigint").alias("quantity"),
        (k + 1).alias("price"),
        F.date_format("ts", "HH:mm").alias("timestamp"),
        F.col("ts").cast("date").alias("trade_date"),
        F.col("ts").alias("trade_ts"),
    )


def valid_trade() -> Column:
    """Typed validity: trader and stock present, quantity and price positive."""
    return (
        F.col("trader_id").isNotNull()
        & (F.col("trader_id") != "")
        & F.col("stock").isNotNull()
        & (F.col("stock") != "")
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
    )


def kept_trade(profile: Profile) -> Column:
    """The validity rule of a run: typed validity, and a time where the profile asks for one."""
    if profile.require_timestamp:
        return valid_trade() & F.col("timestamp").isNotNull() & (F.col("timestamp") != "")
    return valid_trade()


def trades_from_events(events: DataFrame) -> DataFrame:
    """Typed trades; rows that fail the typed validity rules are dropped."""
    return raw_trades_from_events(events).where(valid_trade())


def load_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(read_events(spark, sf_dir))


def trades_between(trades: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Trades of the days ``first_day``..``last_day`` (inclusive), as a range on the
    trade time so the bounds reach the Parquet scan (row groups outside are skipped)."""
    start = F.to_timestamp_ntz(F.lit(f"{first_day} 00:00:00"))
    stop = F.to_timestamp_ntz(F.date_format(F.date_add(F.to_date(F.lit(last_day)), 1), "yyyy-MM-dd"))
    return trades.where((F.col("trade_ts") >= start) & (F.col("trade_ts") < stop))


def daily_closes(trades: DataFrame) -> DataFrame:
    """Close per (stock, day) = price of the day's last trade (ts, then id).

    ``max_by`` over a fixed-width key is a hash aggregate with map-side
    partial aggregation, so a hot stock is pre-aggregated before the
    (stock, day) shuffle.  Output: stock, price_date, close, close_ts.
    """
    order = time_then_id_key("trade_ts", "trade_id")
    return trades.groupBy("stock", F.col("trade_date").alias("price_date")).agg(
        F.max_by("price", order).alias("close"),
        F.max("trade_ts").alias("close_ts"),
    )


def half_day_closes(trades: DataFrame) -> DataFrame:
    """Two closes per (stock, day): the last trade before noon and the last one from noon on."""
    order = time_then_id_key("trade_ts", "trade_id")
    half = trades.groupBy("stock", F.col("trade_date").alias("price_date"), (F.hour("trade_ts") >= 12).alias("late"))
    return half.agg(F.max_by("price", order).alias("close"), F.max("trade_ts").alias("close_ts")).drop("late")


# --- dirty text ------------------------------------------------------------


def _pieces(events: DataFrame) -> DataFrame:
    k = props_k("int")
    return events.select(
        F.col("event_id"),
        F.pmod(F.col("event_id"), F.lit(16)).alias("ov"),
        F.pmod(F.col("event_id"), F.lit(7)).alias("pv"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("tr"),
        F.col("event_type").alias("st"),
        F.round(F.col("value") * 100).try_cast("bigint").cast("string").alias("q"),
        F.concat(
            (k + 1).cast("string"),
            F.lit("."),
            F.lpad(F.pmod(F.col("event_id"), F.lit(100)).cast("string"), 2, "0"),
        ).alias("px"),
        F.date_format("ts", "HH:mm").alias("tm"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


def _csv(*parts) -> Column:
    return F.concat_ws(",", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def order_fields(v: Column, tr: Column, st: Column, q: Column, px: Column, tm: Column) -> list[Column]:
    """The five order fields after spoiling by variant ``v`` (0..15)."""
    return [
        F.when(v == 5, F.lit("")).otherwise(tr),
        F.when(v == 4, F.lit("")).otherwise(st),
        F.when(v == 1, F.lit("0"))
        .when(v == 2, F.concat(F.lit("-"), q))
        .when(v == 3, F.concat(q, F.lit(".5")))
        .otherwise(q),
        F.when(v == 6, F.lit("abc")).when(v == 9, F.lit("nan")).otherwise(px),
        F.when(v == 7, F.lit("")).when(v == 12, F.lit("25:99")).otherwise(tm),
    ]


# Header lines as the reference's inputs carry them.
ORDER_HEADER = "trader_id,stock,quantity,price,timestamp"
PRICE_HEADER = "DateTime,stock,price"


def order_line(v: Column, tr: Column, st: Column, q: Column, px: Column, tm: Column) -> Column:
    """One order line, spoiled according to variant ``v`` (0..15):
    0 padded with blanks, 1-3 bad quantity, 4-5 empty stock / trader, 6 bad price,
    7 empty time, 8 extra field, 9 nan price, 10 header, 11 blank, 12 bad time,
    13 two fields, 14 price header, 15 clean."""
    f = order_fields(v, tr, st, q, px, tm)
    padded = F.concat(F.lit(" "), tr, F.lit(" , "), st, F.lit(" ,"), q, F.lit(", "), px, F.lit(" ,"), tm, F.lit(" "))
    return (
        F.when(v == 0, padded)
        .when(v == 8, _csv(*f, "extra"))
        .when(v == 10, F.lit(ORDER_HEADER))
        .when(v == 11, F.lit("   "))
        .when(v == 13, _csv(tr, st))
        .when(v == 14, F.lit(PRICE_HEADER))
        .otherwise(_csv(*f))
    )


def price_line(v: Column, dt: Column, st: Column, px: Column) -> Column:
    """One price line, spoiled according to variant ``v`` (0..6)."""
    return (
        F.when(v == 0, F.concat(F.lit(" "), dt, F.lit(" , "), st, F.lit(" , "), px, F.lit(" ")))
        .when(v == 1, _csv(dt, st, "0"))
        .when(v == 2, _csv(dt, "", px))
        .when(v == 3, _csv(dt, st, "x"))
        .when(v == 4, _csv("", st, px))
        .when(v == 6, _csv(dt, st, F.concat(F.lit("-"), px)))
        .otherwise(_csv(dt, st, px))
    )


def dirty_lines(events: DataFrame) -> DataFrame:
    """Orders and prices mixed in one text input (``value`` column)."""
    p = _pieces(events)
    both = F.array(
        order_line(F.col("ov"), F.col("tr"), F.col("st"), F.col("q"), F.col("px"), F.col("tm")),
        price_line(F.col("pv"), F.col("dt"), F.col("st"), F.col("px")),
    )
    return p.select(F.explode(both).alias("value"))


def dirty_typed_orders(events: DataFrame) -> DataFrame:
    """The five-field lines as a CSV reader yields them: text columns, '' -> null.

    Split from the mixed raw lines (their text is fixed once per line by the
    explode there); only order lines have five fields.
    """
    from tradewatch.functions.parsing import field, fields, strip

    split = dirty_lines(events).select(fields("value", ",").alias("parts"))
    parts = F.col("parts")
    cols = ["trader_id", "stock", "quantity", "price", "timestamp"]
    stripped = [strip(field(parts, i)) for i in range(5)]
    return split.where(F.size(parts) == 5).select(
        *[F.when(c != "", c).alias(name) for c, name in zip(stripped, cols)]
    )


def dirty_typed_prices(events: DataFrame) -> DataFrame:
    """The price lines as a CSV reader yields them (datetime, stock, price as text, '' -> null)."""
    from tradewatch.functions.parsing import strip

    p = _pieces(events)
    v = F.col("pv")
    dt = F.when(v == 4, F.lit("")).otherwise(F.col("dt"))
    st = F.when(v == 2, F.lit("")).otherwise(F.col("st"))
    px = (
        F.when(v == 1, F.lit("0"))
        .when(v == 3, F.lit("x"))
        .when(v == 6, F.concat(F.lit("-"), F.col("px")))
        .otherwise(F.col("px"))
    )
    cols = [strip(c) for c in (dt, st, px)]
    return p.select(*[F.when(c != "", c).alias(n) for c, n in zip(cols, ["datetime", "stock", "price"])])
