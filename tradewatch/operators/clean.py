"""Cleaning of raw text lines and typed rows; tagging and parsing of tagged records.

All narrow (per-row) expressions: no shuffle, pipelined with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch.functions.parsing import field, fields, four_decimals, strict_double, strict_int, strip, whole

ORDER_TAG = "ORDER"
PRICE_TAG = "PRICE"


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` computed once per row: filters above are not pushed below the generator,
    so they test the result instead of repeating the expression."""
    return df.select(F.explode(F.array(value)).alias(name))


def _split_lines(lines: DataFrame) -> DataFrame:
    """Comma fields (``parts``) of non-blank, non-header lines."""
    filled = lines.select(strip("value").alias("line")).where(F.col("line") != "")
    split = _once(filled, fields("line", ","), "parts")
    return split.where(~F.lower(strip(field(F.col("parts"), 0))).isin(P.ORDER_HEADER_FIRST, P.PRICE_HEADER_FIRST))


def _order_record(parts: Column) -> Column:
    """Typed order of a comma-field array as a struct.

    Five fields, stripped; quantity an integer, price a finite number; the time is not checked.
    """
    tr, st, q, p, tm = (strip(field(parts, i)) for i in range(5))
    typed = [tr.alias("trader_id"), st.alias("stock"), strict_int(q, "bigint").alias("quantity"), strict_double(p).alias("price"), tm.alias("timestamp")]
    return F.when(F.size(parts) == 5, F.struct(*typed))


def _order_ok(o: Column) -> Column:
    """Quantity and price above 0, stock and trader non-empty."""
    return (o["quantity"] > 0) & (o["price"] > 0) & (o["stock"] != "") & (o["trader_id"] != "")


def _price_record(parts: Column) -> Column:
    """Typed price (datetime, stock, price) of a three-field array as a struct."""
    dt, st, p = (strip(field(parts, i)) for i in range(3))
    return F.when(F.size(parts) == 3, F.struct(dt.alias("datetime"), st.alias("stock"), strict_double(p).alias("price")))


def _price_ok(p: Column) -> Column:
    return (p["price"] > 0) & (p["stock"] != "")


def clean_orders(lines: DataFrame) -> DataFrame:
    """Raw lines -> typed orders (trader_id, stock, quantity, price, timestamp)."""
    return _once(_split_lines(lines), _order_record(F.col("parts")), "o").where(_order_ok(F.col("o"))).select("o.*")


def clean_prices(lines: DataFrame) -> DataFrame:
    """Raw lines -> typed prices (datetime, stock, price)."""
    return _once(_split_lines(lines), _price_record(F.col("parts")), "p").where(_price_ok(F.col("p"))).select("p.*")


def clean_typed_orders(rows: DataFrame, require_timestamp: bool = True) -> DataFrame:
    """Typed cleaner over text columns as a CSV reader yields them.

    Nulls in required columns dropped; quantity and price must parse as
    finite numbers > 0; quantity is truncated to a whole number (1.5 -> 1).
    """
    required = ["trader_id", "stock", "quantity", "price"] + (["timestamp"] if require_timestamp else [])
    kept = rows.na.drop(subset=required)
    p = strict_double("price")
    return kept.where((strict_double("quantity") > 0) & (p > 0)).select(
        "trader_id", "stock", whole("quantity").alias("quantity"), p.alias("price"), "timestamp"
    )


def clean_typed_prices(rows: DataFrame) -> DataFrame:
    """Typed cleaner for prices: all three columns present, price a finite number > 0."""
    kept = rows.na.drop(subset=["datetime", "stock", "price"])
    p = strict_double("price")
    return kept.where(p > 0).select("datetime", "stock", p.alias("price"))


def _order_text(c: dict[str, Column]) -> Column:
    payload = F.concat_ws(
        ",", c["trader_id"], c["stock"], c["quantity"].cast("string"), four_decimals(c["price"]),
        F.coalesce(c["timestamp"], F.lit("")),
    )
    return F.concat(F.lit(ORDER_TAG + "\t"), payload)


def _price_text(c: dict[str, Column]) -> Column:
    payload = F.concat_ws(",", F.coalesce(c["datetime"], F.lit("")), c["stock"], four_decimals(c["price"]))
    return F.concat(F.lit(PRICE_TAG + "\t"), payload)


def tagged_records(lines: DataFrame) -> DataFrame:
    """Raw mixed lines -> tagged clean records (the cleaner's output), in one pass:
    each line is split once and tagged by its field count."""
    parts = F.col("parts")
    both = _once(_split_lines(lines), F.struct(_order_record(parts).alias("o"), _price_record(parts).alias("p")), "r")
    o, p = F.col("r.o"), F.col("r.p")
    order = {c: o[c] for c in ("trader_id", "stock", "quantity", "price", "timestamp")}
    price = {c: p[c] for c in ("datetime", "stock", "price")}
    text = F.when(_order_ok(o), _order_text(order)).when(_price_ok(p), _price_text(price))
    return both.where(_order_ok(o) | _price_ok(p)).select(text.alias("value"))


def split_tag(tagged: DataFrame) -> DataFrame:
    """``value`` -> record_type, payload (split on the first tab)."""
    parts = F.split("value", "\t", 2)
    return tagged.select(field(parts, 0).alias("record_type"), field(parts, 1).alias("payload"))


def _parse_orders(payloads: DataFrame) -> DataFrame:
    f = F.split("payload", ",", 5)
    orders = payloads.select(
        field(f, 0).alias("trader_id"),
        field(f, 1).alias("stock"),
        strict_int(field(f, 2), "bigint").alias("quantity"),
        strict_double(field(f, 3)).alias("trade_price"),
        field(f, 4).alias("trade_time"),
    )
    return orders.where("quantity > 0")


def parse_tagged(tagged: DataFrame) -> DataFrame:
    """ORDER records -> trader_id, stock, quantity, trade_price, trade_time."""
    return _parse_orders(split_tag(tagged).where(F.col("record_type") == ORDER_TAG))


def parse_tagged_regex(tagged: DataFrame) -> DataFrame:
    """Same as ``parse_tagged`` by pattern: keep ``^ORDER`` lines, extract the payload."""
    payload = F.trim(F.regexp_extract("value", r"^ORDER\t(.*)$", 1)).alias("payload")
    return _parse_orders(tagged.where(F.col("value").rlike("^ORDER")).select(payload))


def parse_tagged_prices(tagged: DataFrame) -> DataFrame:
    """PRICE records -> price_date, stock, close_price (> 0)."""
    rec = split_tag(tagged).where(F.col("record_type") == PRICE_TAG)
    f = F.split("payload", ",", 3)
    prices = rec.select(
        field(f, 0).alias("price_date"), field(f, 1).alias("stock"), strict_double(field(f, 2)).alias("close_price")
    )
    return prices.where("close_price > 0")
