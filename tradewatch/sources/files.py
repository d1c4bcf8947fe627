"""File and table sources with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions.parsing import strict_double, strict_int, time_on_date, whole
from tradewatch.operators.clean import clean_typed_prices
from tradewatch.storage import Storage, literally

SOURCE_FILE = "source_file"
CSV_GLOB = "*.[cC][sS][vV]"  # only .csv inputs, any case


class MissingColumnsError(ValueError):
    pass


def require_columns(columns, required=schemas.ORDER_COLUMNS) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise MissingColumnsError(f"orders input must contain columns {sorted(required)}; missing {missing}")


def type_orders(raw: DataFrame, truncate_quantity: bool = False) -> DataFrame:
    """Text order columns -> typed orders with strict number parsing.

    ``truncate_quantity``: a finite fractional quantity is truncated (1.5 -> 1)
    as the typed cleaner does; otherwise only integers are accepted.
    """
    qty = whole("quantity") if truncate_quantity else strict_int("quantity", "bigint")
    return raw.select(
        *[c for c in raw.columns if c == SOURCE_FILE],
        "trader_id",
        "stock",
        qty.alias("quantity"),
        strict_double("price").alias("price"),
        "timestamp",
    )


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The ``.csv`` files of a folder (or a pattern, or one file); their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(path)
    return sorted(r["path"] for r in listed.select("path").collect())


def read_by_header(spark: SparkSession, paths: list[str], required=schemas.ORDER_COLUMNS, types: T.StructType | None = None) -> DataFrame:
    """CSV files read each by its own header: the required columns by name, and the file's name.

    Files with the same header are one scan; a file may have its columns in another order and more columns, and one
    without a required column is refused.  Values are text unless ``types`` gives their types; empty files are skipped.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, Storage(spark).headers(paths), strict=True):
        if header:
            require_columns(header, required)
            layouts.setdefault(header, []).append(path)
    if not layouts:
        require_columns((), required)
    known = {f.name: f.dataType for f in types} if types else {}
    frames = []
    for header, files in sorted(layouts.items()):
        # a repeated name counts where it stands first
        names = [n if header.index(n) == i else f"{n}#{i}" for i, n in enumerate(header)]
        schema = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
        rows = spark.read.schema(schema).option("header", True).csv([literally(f) for f in files])
        frames.append(rows.select(*required, F.col("_metadata.file_name").alias(SOURCE_FILE)))
    return reduce(DataFrame.unionByName, frames)


def read_orders_csv(spark: SparkSession, path: str, truncate_quantity: bool = False, keep_file: bool = False) -> DataFrame:
    """Orders CSV(s) with a header; only ``.csv`` files; the five columns must exist.

    ``keep_file`` adds the file's name (for ``orders_to_trades``).

    Every file is read by its own header (extra columns and any order are
    allowed); values are text and then typed with strict parsing.
    """
    raw = read_by_header(spark, csv_files(spark, path))
    return type_orders(raw if keep_file else raw.drop(SOURCE_FILE), truncate_quantity)


def orders_to_trades(orders: DataFrame, day: Column) -> DataFrame:
    """Typed orders -> trades: the time of day placed on ``day``, and an id.

    The id is a hash of the file's name and the line's content, so it depends
    neither on how files are split nor on the order of reading; identical
    lines of one file share it and are numbered where alerts are stored.
    Uploaded orders carry only a time of day; like the reference, the run's
    date supplies the rest.
    """
    parts = [c for c in (SOURCE_FILE, *schemas.ORDER_COLUMNS) if c in orders.columns]
    return orders.select(
        F.xxhash64(*parts).alias("trade_id"),
        "trader_id", "stock", "quantity", "price", "timestamp",
        day.alias("trade_date"),
        time_on_date(day, "timestamp").alias("trade_ts"),
    ).select(*schemas.TRADES.fieldNames())


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Prices CSV(s) with a header: datetime, stock, price, cleaned.

    Read as text and then typed, so which rows stay does not depend on the
    columns a query selects: rows without a date, a stock or a finite price
    above 0 are dropped.  Every file's header is checked.
    """
    text = ", ".join(f"{f.name} string" for f in schemas.PRICES)
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).option("pathGlobFilter", CSV_GLOB).csv(path)
    typed = clean_typed_prices(raw).withColumn("datetime", F.col("datetime").try_cast("date"))
    return typed.where(F.col("datetime").isNotNull())


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text lines of one or more folders read as one input (``value``); a carriage return stays part of its line."""
    return spark.read.option("lineSep", "\n").text(list(paths))


def external_order_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Drop and recreate a tab-delimited external table over ``location``."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({schemas.ORDER_TABLE_DDL}) USING csv "
        f"OPTIONS (sep '\\t', header 'false') LOCATION '{location}'"
    )
    return spark.table(table)


def read_results(spark: SparkSession, table: str) -> DataFrame:
    """The stored results as of now.

    Refreshes the session's cached relation first: a refresh published from
    another session (e.g. a stream's ``foreachBatch``) switches the table to
    a new version folder.
    """
    spark.catalog.refreshTable(table)
    return spark.table(table)


def order_table_rows(orders: DataFrame) -> DataFrame:
    """Clean orders in the external table's column order, tagged ORDER."""
    return orders.select(
        F.lit("ORDER").alias("record_type"), "trader_id", "stock", "quantity", "price",
        F.col("timestamp").alias("trade_time"),
    )
