"""Versions: interleaved and failing runs, the cleaner, and what is built on them."""

import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import sample_closes, sample_trades
from tradewatch import schemas
from tradewatch.operators import score
from tradewatch.plans import pipeline
from tradewatch.profiles import LATEST_PAIR
from tradewatch.sinks import files, results
from tradewatch.sinks.versions import Versions
from tradewatch.sources import files as src
from tradewatch.sources import price_store


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def _write(spark, versions, name, n):
    spark.range(n).write.parquet(versions.path(name))


def test_the_run_that_started_last_stays(spark, tmp_dir):
    v = Versions(spark, os.path.join(tmp_dir, "r"))
    assert v.newest() is None and v.live_path() is None
    old, new = v.begin(), v.begin()
    assert old < new
    _write(spark, v, new, 2)
    assert v.publish(new)
    _write(spark, v, old, 1)
    assert not v.publish(old)  # it ended later but started earlier
    assert v.live_path() == v.path(new)
    later = v.begin()
    assert later > new and v.newest() == new  # nothing is seen before it is published


@pytest.mark.parametrize("old_ends_last", [True, False])
def test_interleaved_publishes_leave_the_newer_results(spark, tmp_dir, old_ends_last):
    table, loc = _name("results"), os.path.join(tmp_dir, "results")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    versions = Versions(spark, loc)
    old, new = versions.begin(), versions.begin()
    order = [(hits, new), (hits.where("stock = 'TCS'"), old)]
    for rows, ticket in order if old_ends_last else reversed(order):
        results.refresh_results(spark, rows, table, None, loc, ticket)
    assert src.read_results(spark, table).count() == 4


def test_a_switch_that_was_overtaken_is_repaired(spark, tmp_dir, monkeypatch):
    """Between an older run's look at the newest version and its switch, a newer run publishes and switches."""
    table, loc = _name("results"), os.path.join(tmp_dir, "results")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    versions = Versions(spark, loc)
    results.refresh_results(spark, hits.where("false"), table, None, loc)
    old, new = versions.begin(), versions.begin()
    real, looks = Versions.newest, []

    def newest(self):
        looks.append(real(self))
        if len(looks) == 3:  # publish, loop condition, then the value the switch is made with
            seen = looks[-1]
            monkeypatch.setattr(Versions, "newest", real)
            results.refresh_results(spark, hits, table, None, loc, new)
            return seen
        return looks[-1]

    monkeypatch.setattr(Versions, "newest", newest)
    results.refresh_results(spark, hits.where("stock = 'TCS'"), table, None, loc, old)
    assert len(looks) == 3
    assert src.read_results(spark, table).count() == 4


def test_two_pipelines_at_once_export_their_own_alerts(spark, tmp_dir):
    table, out = _name("results"), os.path.join(tmp_dir, "out")
    t = sample_trades(spark)
    newer = Versions(spark, os.path.join(out, "results"))
    started_later = None

    def closes(_orders):
        nonlocal started_later
        if started_later is None:  # a second run starts and ends while the first is at work
            started_later = pipeline.run(spark, t, sample_closes(spark), out, LATEST_PAIR, "second", table)
        return sample_closes(spark)

    pipeline.run(spark, t.where("stock = 'TCS'"), closes, out, LATEST_PAIR, "first", table)
    assert src.read_results(spark, table).count() == 4 == spark.read.parquet(newer.live_path()).count()
    exported = {r: spark.read.option("header", True).csv(os.path.join(out, "suspicious_trades", f"run_id={r}")).count() for r in ("first", "second")}
    assert exported == {"first": 2, "second": 4}


def test_a_failed_write_leaves_the_run_readable(spark, tmp_dir):
    base = os.path.join(tmp_dir, "runs")
    t = sample_trades(spark)
    files.write_run(t, base, "r1")
    # some tasks end before one fails
    broken = t.repartition(4).withColumn("stock", F.when(F.col("trader_id") == "T201", F.raise_error(F.lit("lost"))).otherwise(F.col("stock")))
    with pytest.raises(Exception, match="lost"):
        files.write_run(broken, base, "r1")
    assert files.read_run(spark, base, schemas.TRADES, "r1").count() == 15
    folder = os.path.join(base, "run_id=r1")
    assert len([d for d in os.listdir(folder) if d.startswith("v=")]) == 1  # nothing is left of it
    files.write_run(t.where("stock = 'TCS'"), base, "r1")
    rows = files.read_run(spark, base, schemas.TRADES, "r1")
    assert rows.count() == 4 and {r.run_id for r in rows.collect()} == {"r1"}
    assert files.read_run(spark, base, schemas.TRADES, "none").count() == 0
    assert len(files.clean_run(spark, base, "r1")) == 1
    assert rows.count() == 4


def test_the_cleaner_keeps_what_is_live_read_or_being_written(spark, tmp_dir):
    v = Versions(spark, os.path.join(tmp_dir, "r"))
    names = [v.begin() for _ in range(3)]
    for i, name in enumerate(names[:2]):
        _write(spark, v, name, i + 1)
        v.publish(name)
    _write(spark, v, names[2], 3)  # at work
    with v.reading() as path:
        last = v.begin()
        _write(spark, v, last, 4)
        v.publish(last)
        assert v.clean() == [names[0]]
        assert spark.read.parquet(path).count() == 2  # still read
    assert v.clean() == [names[1]]
    assert v.clean(unfinished_hours=0) == [names[2]]  # taken to be dead
    assert spark.read.parquet(v.live_path()).count() == 4
    assert v.clean(unfinished_hours=0) == []
    with Versions(spark, os.path.join(tmp_dir, "none")).reading() as path:
        assert path is None


def test_old_result_versions_go_and_the_table_stays(spark, tmp_dir):
    table, loc = _name("results"), os.path.join(tmp_dir, "results")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    for _ in range(3):
        results.refresh_results(spark, hits, table, None, loc)
    with results.reading_results(spark, loc) as rows:
        results.refresh_results(spark, hits.where("false"), table, None, loc)
        assert len(results.clean_results(spark, loc)) == 2
        assert rows.count() == 4
    assert len(results.clean_results(spark, loc)) == 1
    assert src.read_results(spark, table).count() == 0
    with results.reading_results(spark, os.path.join(tmp_dir, "none")) as rows:
        assert rows.count() == 0


def test_price_store_loads_and_prunes(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    schema = price_store.STORED
    day = "stock, cast(d as date) as price_date, close, cast(null as timestamp_ntz) as close_ts"
    rows = [("TCS", f"2024-{m:02d}-{d:02d}", float(m * 100 + d)) for m in range(1, 13) for d in (1, 15, 28)]
    first = spark.createDataFrame(rows + [("INFY", "2024-03-15", 5.0)], "stock string, d string, close double").selectExpr(*day.split(", "))
    assert price_store.prices_between(spark, store, date(2024, 1, 1), date(2024, 12, 31)).count() == 0
    price_store.load_prices(spark, store, first)
    new = spark.createDataFrame([("TCS", "2024-03-15", 1.0), ("TCS", "2024-03-15", 2.0), ("TCS", "2025-01-02", 3.0)], "stock string, d string, close double").selectExpr(*day.split(", "))
    price_store.load_prices(spark, store, new)
    symbols = spark.createDataFrame([("TCS",)], "stock string")
    window = price_store.window(spark, store, symbols, "2024-03-28", 30)
    assert sorted((str(r.price_date), r.close) for r in window.collect()) == [("2024-02-28", 228.0), ("2024-03-01", 301.0), ("2024-03-15", 1.0), ("2024-03-15", 2.0), ("2024-03-28", 328.0)]
    assert window.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert price_store.prices_between(spark, store, date(2024, 1, 1), date(2025, 12, 31)).count() == 39
    # only the window's months are listed and opened
    scanned = {f.rsplit("/", 2)[1] for f in price_store.prices_between(spark, store, date(2024, 2, 27), date(2024, 3, 28)).inputFiles()}
    assert scanned <= {"price_month=2024-02-01", "price_month=2024-03-01"} or len(scanned) == 13
    plan = window._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(price_month" in plan and "price_month" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_a_run_from_a_price_store(spark, tmp_dir):
    for name, lines in {
        "orders": ["trader_id,stock,quantity,price,timestamp", "T1,TCS,3000000000,5,10:10", *[f"T{i},TCS,1,5,10:10" for i in range(2, 12)]],
        "prices": ["datetime,stock,price", "2026-03-02,TCS,100", "2026-03-03,TCS,110", "2020-01-01,TCS,7"],
    }.items():
        os.makedirs(os.path.join(tmp_dir, name))
        with open(os.path.join(tmp_dir, name, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    store, out = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "out")
    pipeline.load_price_store(spark, os.path.join(tmp_dir, "prices"), store)
    res = pipeline.run_from_csv(spark, os.path.join(tmp_dir, "orders"), None, out, LATEST_PAIR, "2026-03-05", "r1", store=store)
    rows = spark.read.parquet(os.path.join(out, "results", "run_id=r1")).collect()
    assert [(r.trader_id, r.quantity, r.suspicion_score) for r in rows] == [("T1", 3000000000, 85)]
    assert res.unpriced.count() == 0
