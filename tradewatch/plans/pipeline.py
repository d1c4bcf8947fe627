"""The six steps as one Spark job graph, one write action per sink.

    trades --clean--> clean orders (Parquet, run folder)        [read back]
    clean  --> per-stock moments (one aggregate, materialised)
           --> stock summary; large-trade bound; scoring statistics
    clean  --> trader summary --> high-volume traders           [from the written summary]
    clean x moments --> large trades CSV
    clean x moments x closes --> score --> flagged --> results table

Clean orders are scanned four times (moments, trader summary, large trades,
scoring) instead of once per output; the four outputs run as concurrent jobs.

The clean orders are written once and every later step reads that written
table, so lineage is cut at the stage boundary and an executor lost later
never forces the cleaning to be recomputed.  Row counts of each stage are
taken with ``observe`` on the write itself (no extra counting job).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch import schemas
from tradewatch.operators import prices, stats, summaries
from tradewatch.operators.joins import small_side
from tradewatch.operators.score import flagged
from tradewatch.profiles import POST_TRADE, Profile
from tradewatch.session import materialize_counted
from tradewatch.sinks import files
from tradewatch.sinks.results import refresh_results, to_results
from tradewatch.sinks.versions import Versions
from tradewatch.sources import price_store
from tradewatch.sources.events import kept_trade
from tradewatch.sources.files import orders_to_trades, read_lines, read_orders_csv, read_prices_csv, read_results

STAGES = ("orders_in", "orders_clean", "large_trades", "flagged")


@dataclass
class RunResult:
    counts: dict[str, int]
    clean_path: str
    out: str
    unpriced: DataFrame | None = None  # traded symbols without a price in the look-back window


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")  # runs of one session must not share a name
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run(
    spark: SparkSession,
    trades: DataFrame,
    closes: DataFrame | Callable[[DataFrame], DataFrame] | None,
    out: str,
    profile: Profile = POST_TRADE,
    run_id: str | None = None,
    results_table: str | None = None,
    detected_at: str | None = None,
) -> RunResult:
    """Run every step over ``trades`` and write all outputs under ``out``,
    each layer in its own ``<layer>/run_id=<id>`` folder.

    ``closes`` may be a function of the written clean orders (so that it can
    use their symbols).  Without ``closes`` the day's last clean trade is its
    close; moments and closes then come from one pass over the clean orders.

    With ``results_table``, of runs at the same time the one that started last
    keeps the table, whichever ends last; each exports its own alerts.

    ``run_id`` names the run folders; by default it is taken from the session
    clock (``yyyyMMdd_HHmmss``), once, on the driver.
    """
    if run_id is None:
        run_id = spark.range(1).select(files.run_id_from(F.current_timestamp())).first()[0]
    obs = {}
    results_at = files.folder(out, "results")
    ticket = Versions(spark, results_at).begin() if results_table else None
    trades_in, obs["orders_in"] = _observed(trades, "orders_in")
    clean = trades_in.where(kept_trade(profile))
    clean, obs["orders_clean"] = _observed(clean, "orders_clean")
    clean_base = files.folder(out, "clean")
    files.write_run(clean, clean_base, run_id)
    orders = files.read_run(spark, clean_base, schemas.TRADES, run_id).drop("run_id")
    if callable(closes):
        closes = closes(orders)
    # a missing, zero or negative close is no close: it must not become a stock's last price
    if closes is not None:
        closes = closes.where("stock is not null and stock <> '' and price_date is not null and close > 0")

    def layer(*parts: str) -> str:  # <out>/<layer>/run_id=<id>: one folder per run and layer
        return files.folder(out, *parts, f"run_id={run_id}")

    # one aggregate per stock feeds the stock summary, the large-trade bound and the scoring stats
    if closes is None:
        moments, closes = stats.moments_and_closes(orders)
    else:
        moments = small_side(stats.stock_moments(orders), "stock_moments")

    def stock_summary() -> None:
        files.write_csv(summaries.stock_summary_from(moments.df, profile.spread), layer("hive", "stock_summary"), header=False, ordered=True)

    def large_trades() -> None:
        bound = stats.stats_from_moments(moments, profile.spread)
        large, obs["large_trades"] = _observed(stats.large_trades(orders, P.LARGE_TRADE_SIGMA, profile.spread, bound), "large_trades")
        files.write_csv(large.drop("trade_id"), layer("pig", "large_trades"), header=False)

    def trader_summaries() -> None:
        trader_path = layer("hive", "trader_summary")
        files.write_csv(summaries.trader_summary(orders), trader_path, header=False, ordered=True)
        written = spark.read.schema(schemas.TRADER_SUMMARY).csv(trader_path)
        files.write_csv(summaries.high_volume_from(written), layer("hive", "high_volume_traders"), header=False, ordered=True)

    def scoring() -> None:
        scoring_stats = stats.stats_from_moments(moments, "samp")
        hits = flagged(orders, closes, profile, scoring_stats)
        if results_table:
            version = refresh_results(spark, hits, results_table, detected_at, results_at, ticket)
            stored = spark.read.schema(schemas.RESULTS_DDL).parquet(version) if version else read_results(spark, results_table)
        else:
            to_results(hits, detected_at).write.mode("overwrite").parquet(layer("results"))
            stored = spark.read.schema(schemas.RESULTS_DDL).parquet(layer("results"))
        # the suspicious trades as a file, from what is stored (no second scoring)
        # (counted here, straight on a scan: below a shuffle that turns out empty, AQE drops the metric)
        exported, obs["flagged"] = _observed(stored.select(*schemas.ALERTS_EXPORT.fieldNames()), "flagged")
        files.write_csv(exported, layer("suspicious_trades"))

    # the four outputs are independent actions: submitted from separate threads,
    # Spark runs their jobs side by side and keeps executors busy through each tail
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(f) for f in (stock_summary, large_trades, trader_summaries, scoring)]:
            done.result()  # re-raises the first failure

    counts = {name: int(o.get.get("rows", 0)) for name, o in obs.items()}
    return RunResult(counts=counts, clean_path=clean_base, out=out)


def prices_as_closes(history: DataFrame) -> DataFrame:
    """A cleaned price history as closes (no time of day is known)."""
    return history.select(
        "stock", F.col("datetime").alias("price_date"), F.col("price").alias("close"),
        F.lit(None).cast("timestamp_ntz").alias("close_ts"),
    )


def load_price_store(spark: SparkSession, prices_path: str, store: str) -> str:
    """Cleaned prices CSV(s) into the price store (``sources/price_store.py``)."""
    return price_store.load_prices(spark, store, prices_as_closes(read_prices_csv(spark, prices_path)))


def run_from_csv(
    spark: SparkSession,
    orders_path: str,
    prices_path: str | None,
    out: str,
    profile: Profile = POST_TRADE,
    as_of: str | None = None,
    run_id: str | None = None,
    results_table: str | None = None,
    detected_at: str | None = None,
    store: str | None = None,
) -> RunResult:
    """The user's path: orders CSV(s) and prices CSV(s) in, every output under ``out``.

    The raw order lines are landed, prices are limited to the symbols of the
    written clean orders and the look-back window that ends ``as_of`` (the date
    the order times are placed on, by default the session's current date).
    Prices come from the store: ``store``, where they were loaded before (and
    ``prices_path``, if given, is loaded now), else one of this run under
    ``out/prices``.
    """
    day = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    as_of = as_of or spark.range(1).select(F.current_date().cast("string")).first()[0]
    if run_id is None:
        run_id = spark.range(1).select(files.run_id_from(F.current_timestamp())).first()[0]
    files.land_raw(read_lines(spark, orders_path), files.folder(out, "raw", f"run_id={run_id}"))
    orders = read_orders_csv(spark, orders_path, profile.truncate_quantity, keep_file=True)
    trades = orders_to_trades(orders, day)
    store = store or files.folder(out, "prices", f"run_id={run_id}")
    if prices_path:
        load_price_store(spark, prices_path, store)
    found: dict[str, DataFrame] = {}

    def closes_of(clean: DataFrame) -> DataFrame:
        found["symbols"], _ = materialize_counted(prices.traded_symbols(clean), "symbols")
        found["window"] = price_store.window(spark, store, found["symbols"], as_of)
        return found["window"]

    result = run(spark, trades, closes_of, out, profile, run_id, results_table, detected_at)
    result.unpriced = prices.symbols_without_prices(found["symbols"], found["window"])
    return result
