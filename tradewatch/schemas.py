"""Explicit schemas for every source and stored result; nothing is inferred."""

from pyspark.sql import types as T

ORDER_COLUMNS = ("trader_id", "stock", "quantity", "price", "timestamp")

# Trades as bound from the driver tables (orders plus identity and time).
TRADES = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("trader_id", T.StringType()),
        T.StructField("stock", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("trade_ts", T.TimestampNTZType()),
    ]
)

# Daily close per stock, as written to a prices CSV.
PRICES = T.StructType(
    [
        T.StructField("datetime", T.DateType()),
        T.StructField("stock", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)

# Six-column tab-delimited external table over clean orders.
ORDER_TABLE_DDL = (
    "record_type STRING, trader_id STRING, stock STRING, quantity BIGINT, price DOUBLE, trade_time STRING"
)

LARGE_TRADES = T.StructType(
    [
        T.StructField("trader_id", T.StringType()),
        T.StructField("stock", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("avg_qty", T.DoubleType()),
        T.StructField("stddev_qty", T.DoubleType()),
    ]
)

TRADER_SUMMARY = T.StructType(
    [
        T.StructField("trader_id", T.StringType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
    ]
)

ALERTS_EXPORT = T.StructType(
    [
        T.StructField("trader_id", T.StringType()),
        T.StructField("stock", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("suspicion_score", T.IntegerType()),
    ]
)

# Stored results table (the dashboard's source).
RESULTS_DDL = (
    "id STRING, trader_id STRING, stock STRING, quantity BIGINT, reason STRING, "
    "suspicion_score INT, detected_at TIMESTAMP_NTZ"
)
