"""Sources, sinks, the results table and the file-arrival stream."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from fixtures import SAMPLE_FLAGGED, sample_closes, sample_trades
from tradewatch import schemas
from tradewatch.operators import score, summaries
from tradewatch.plans import pipeline
from tradewatch.profiles import LATEST_PAIR, POST_TRADE
from tradewatch.sinks import files, results
from tradewatch.sources import files as src
from tradewatch.storage import literally
from tradewatch.streaming.arrival import run_on_arrival


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def test_orders_csv_reader_checks_columns_and_extension(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good")
    t = sample_trades(spark).select(*schemas.ORDER_COLUMNS)
    files.write_csv(t, good)
    t.select(F.col("stock").alias("value")).write.mode("append").text(good)  # .txt parts ignored
    back = src.read_orders_csv(spark, good)
    assert back.count() == 15 and back.schema["quantity"].dataType.simpleString() == "bigint"
    bad = os.path.join(tmp_dir, "bad")
    files.write_csv(t.drop("timestamp"), bad)
    with pytest.raises(src.MissingColumnsError):
        src.read_orders_csv(spark, bad)


def test_results_refresh_replaces_and_clear_empties(spark, tmp_dir):
    table = _name("suspicious_trades")
    loc = os.path.join(tmp_dir, "results")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    results.refresh_results(spark, hits, table, "2026-03-04 12:00:00", loc)
    rows = spark.table(table).collect()
    assert {(r.trader_id, r.stock, r.quantity, r.suspicion_score) for r in rows} == SAMPLE_FLAGGED
    assert len({r.id for r in rows}) == 4 and all(len(r.id) == 64 for r in rows)
    # re-run with nothing flagged: the table is replaced by an empty set
    results.refresh_results(spark, hits.where("false"), table, None, loc)
    assert spark.table(table).count() == 0
    results.refresh_results(spark, hits, table, None, loc)
    assert spark.table(table).count() == 4
    results.clear_results(spark, table, loc)
    assert spark.table(table).count() == 0
    # every refresh published its own version folder; the table points at the last
    versions = [d for d in os.listdir(loc) if d.startswith("v=")]
    assert len(versions) == 4


def test_failed_refresh_keeps_previous_results(spark, tmp_dir):
    table = _name("suspicious_trades")
    loc = os.path.join(tmp_dir, "results")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    results.refresh_results(spark, hits, table, None, loc)
    boom = hits.withColumn("trader_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        results.refresh_results(spark, boom, table, None, loc)
    assert spark.table(table).count() == 4


def test_managed_results_table_truncate(spark):
    table = _name("suspicious_trades")
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    results.refresh_results(spark, hits, table)
    assert spark.table(table).count() == 4
    results.clear_results(spark, table)
    assert spark.table(table).count() == 0


def test_run_folders_keep_other_runs(spark, tmp_dir):
    base = os.path.join(tmp_dir, "runs")
    t = sample_trades(spark)
    files.write_run(t, base, "r1")
    files.write_run(t.where("stock = 'TCS'"), base, "r2")
    files.write_run(t.where("stock = 'INFY'"), base, "r2")  # replaces r2 only
    assert files.read_run(spark, base, schemas.TRADES, "r1").count() == 15
    assert files.read_run(spark, base, schemas.TRADES, "r2").count() == 3


def test_insert_overwrite_directory_and_external_table(spark, tmp_dir):
    t = sample_trades(spark)
    view = _name("v")
    summaries.trader_summary(t).createOrReplaceTempView(view)
    path = os.path.join(tmp_dir, "hive")
    files.insert_overwrite_directory(spark, view, path)
    files.insert_overwrite_directory(spark, view, path)  # overwrite, not append
    assert spark.read.schema(schemas.TRADER_SUMMARY).csv(path).count() == 15
    ext = os.path.join(tmp_dir, "ext")
    files.write_csv(src.order_table_rows(t), ext, header=False, sep="\t")
    table = src.external_order_table(spark, _name("orders_ext"), ext)
    assert table.where("record_type = 'ORDER'").count() == 15
    assert table.agg(F.sum("quantity")).first()[0] == sum(r.quantity for r in t.collect())


def test_tagged_folders_round_trip(spark, tmp_dir):
    from fixtures import lines
    from tradewatch.operators import clean

    tagged = clean.tagged_records(lines(spark, ["T1,TCS,10,3.5,10:10", "2026-03-04,TCS,3125.42"]))
    path = os.path.join(tmp_dir, "tagged")
    files.write_tagged(tagged, path)
    assert os.path.isdir(os.path.join(path, "record_type=ORDER"))
    assert {r.value for r in files.read_tagged(spark, path).collect()} == {r.value for r in tagged.collect()}


def test_pipeline_stage_counts(spark, tmp_dir):
    t = sample_trades(spark)
    res = pipeline.run(spark, t, sample_closes(spark), os.path.join(tmp_dir, "out"), LATEST_PAIR, "r1")
    assert res.counts == {"orders_in": 15, "orders_clean": 15, "large_trades": 0, "flagged": 4}
    out = spark.read.parquet(os.path.join(tmp_dir, "out", "results", "run_id=r1"))
    assert out.count() == 4
    for layer in ("clean", "pig/large_trades", "hive/stock_summary", "hive/trader_summary", "hive/high_volume_traders"):
        assert os.path.isdir(os.path.join(tmp_dir, "out", layer, "run_id=r1")), layer
    # outputs derived from the shared per-stock moments equal the direct operators
    ss = spark.read.schema(
        "stock string, trade_count long, avg_quantity double, stddev_quantity double, avg_price double"
    ).csv(os.path.join(tmp_dir, "out", "hive", "stock_summary", "run_id=r1"))
    direct = {r.stock: round(r.stddev_quantity, 6) for r in summaries.stock_summary(t, LATEST_PAIR.spread).collect()}
    assert {r.stock: round(r.stddev_quantity, 6) for r in ss.collect()} == direct
    hv = spark.read.schema("trader_id string, total_volume long").csv(os.path.join(tmp_dir, "out", "hive", "high_volume_traders", "run_id=r1"))
    assert hv.count() == summaries.high_volume_traders(t).count() == 0


def test_file_arrival_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    files.write_csv(sample_trades(spark).coalesce(1), landing)
    table = _name("suspicious_trades")
    q = run_on_arrival(
        spark, landing, sample_closes(spark), table, os.path.join(tmp_dir, "ckpt"), LATEST_PAIR, None,
        os.path.join(tmp_dir, "res"),
    )
    q.awaitTermination()
    got = {(r.trader_id, r.stock, r.quantity, r.suspicion_score) for r in src.read_results(spark, table).collect()}
    assert got == SAMPLE_FLAGGED
    assert POST_TRADE.threshold == 70


def test_second_upload_replaces_first(spark, tmp_dir):
    """Each upload is scored on its own and replaces the results; the
    checkpoint makes the second run read only the new files."""
    landing, ckpt, res = (os.path.join(tmp_dir, d) for d in ("landing", "ckpt", "res"))
    table = _name("suspicious_trades")
    t = sample_trades(spark)
    os.makedirs(landing)
    files.write_csv(t.repartition(3), os.path.join(tmp_dir, "up1"))
    files.write_csv(t.where("stock = 'TCS'"), os.path.join(tmp_dir, "up2"))
    os.rename(os.path.join(tmp_dir, "up1"), os.path.join(landing, "up1"))  # a finished upload moves in at once
    run_on_arrival(spark, landing, sample_closes(spark), table, ckpt, LATEST_PAIR, None, res).awaitTermination()
    assert src.read_results(spark, table).count() == 4
    os.rename(os.path.join(tmp_dir, "up2"), os.path.join(landing, "up2"))
    run_on_arrival(spark, landing, sample_closes(spark), table, ckpt, LATEST_PAIR, None, res).awaitTermination()
    # TCS alone: 4 trades, sample spread of its own; results hold only this upload's flags
    got = {(r.trader_id, r.suspicion_score) for r in src.read_results(spark, table).collect()}
    assert got == {("T201", 51), ("T213", 54)}


def test_two_uploads_in_one_trigger_are_scored_apart(spark, tmp_dir):
    """The later upload's results stay, and they equal a batch run over that upload alone."""
    landing, res = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "res")
    t = sample_trades(spark)
    files.write_csv(t.withColumn("quantity", F.lit(10).cast("long")), os.path.join(landing, "a"))
    time.sleep(1.1)
    timeless = F.when(F.col("trader_id") != "T201", F.col("timestamp"))
    second = t.withColumn("timestamp", timeless)
    files.write_csv(second, os.path.join(landing, "b"))
    table = _name("suspicious_trades")
    run_on_arrival(spark, landing, sample_closes(spark), table, os.path.join(tmp_dir, "ckpt"), LATEST_PAIR, None, res).awaitTermination()
    key = lambda rows: sorted((r.trader_id, r.stock, r.quantity, r.suspicion_score) for r in rows)
    got = key(src.read_results(spark, table).collect())
    pipeline.run(spark, second, sample_closes(spark), os.path.join(tmp_dir, "batch"), LATEST_PAIR, "r1")
    batch = spark.read.parquet(os.path.join(tmp_dir, "batch", "results", "run_id=r1"))
    assert got == key(batch.collect()) and got
    assert "T201" not in {g[0] for g in got}  # no time: dropped by the same rule as in a batch run
    # both uploads ran all steps
    assert len(os.listdir(os.path.join(res, "hive", "trader_summary"))) == 2


def test_upload_without_a_required_column_is_refused(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "o.csv"), "w") as fh:
        fh.write("stock,trader_id,quantity,price\nTCS,T1,5,3.5\n")
    q = run_on_arrival(spark, landing, sample_closes(spark), _name("t"), os.path.join(tmp_dir, "ckpt"), LATEST_PAIR,
                       None, os.path.join(tmp_dir, "res"), layout="orders", run_date="2026-03-04")
    with pytest.raises(Exception, match="timestamp"):
        q.awaitTermination()


def test_files_are_read_each_by_its_own_header(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "orders [x]{1}")
    os.makedirs(folder)
    contents = {
        "a.csv": "trader_id,stock,quantity,price,timestamp\nT1,TCS,5,3.5,10:10\n",
        "b [1]*?.csv": "stock,trader_id,note,quantity,price,timestamp\nINFY,T2,n,6,4.5,10:11\n",
        "c.CSV": "\ufeff\"trader_id\",\"timestamp\",price,quantity,stock,price\nT3,10:12,5.5,7,TCS,9\n",
        "d.csv": "",
        "e.csv": "trader_id,stock,quantity,price,timestamp\n",
        "f.txt": "nothing",
    }
    for name, text in contents.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    rows = src.read_orders_csv(spark, literally(folder)).collect()
    assert sorted(tuple(r) for r in rows) == [("T1", "TCS", 5, 3.5, "10:10"), ("T2", "INFY", 6, 4.5, "10:11"), ("T3", "TCS", 7, 5.5, "10:12")]
    with open(os.path.join(folder, "g.csv"), "w") as fh:
        fh.write("trader_id,stock,quantity,price\nT1,TCS,5,3.5\n")
    with pytest.raises(src.MissingColumnsError, match="timestamp"):
        src.read_orders_csv(spark, literally(folder))


def test_unsorted_csv_files_are_rebalanced(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    files.write_csv(spark.range(0, 5000, 1, 64), path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 8
    files.write_csv(spark.range(0, 5000, 1, 4).orderBy(F.desc("id")), path, ordered=True)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    values = [int(x) for f in parts for x in open(os.path.join(path, f)).read().split()[1:]]
    assert values == sorted(values, reverse=True)


def test_alert_ids_do_not_depend_on_splits(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "orders")
    os.makedirs(folder)
    with open(os.path.join(folder, "o.csv"), "w") as fh:
        fh.write("trader_id,stock,quantity,price,timestamp\n")
        fh.writelines(f"T{i % 50},S{i % 7},{i % 90 + 1},3.5,10:{i % 60:02d}\n" for i in range(4000))
    ids = []
    for size in ("2k", "64m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        trades = src.orders_to_trades(src.read_orders_csv(spark, folder, keep_file=True), F.to_date(F.lit("2026-03-04")))
        rows = results.to_results(trades.withColumn("reason", F.lit("r")).withColumn("suspicion_score", F.lit(1)), "2026-03-04 12:00:00")
        ids.append(sorted(r.id for r in rows.select("id").collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids[0] == ids[1] and len(set(ids[0])) == 4000  # identical lines are numbered


def test_price_rows_do_not_depend_on_the_columns_selected(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "prices")
    os.makedirs(folder)
    with open(os.path.join(folder, "p.csv"), "w") as fh:
        fh.write("datetime,stock,price\n2026-03-04,TCS,5\n2026-03-04,TCS,x\n2026-03-04,TCS,0\n2026-03-04,,5\nbad,TCS,5\n2026-03-05,TCS,\n")
    p = src.read_prices_csv(spark, folder)
    assert len(p.collect()) == p.count() == p.select("stock").count() == 1


def test_large_quantities_and_bad_last_prices_on_the_csv_path(spark, tmp_dir):
    """A quantity beyond 32 bits is kept; a zero or empty last price is not the last price."""
    for name, lines in {
        "orders": ["trader_id,stock,quantity,price,timestamp", "T1,TCS,3000000000,5,10:10", *[f"T{i},TCS,1,5,10:10" for i in range(2, 12)], "T20,XYZ,1,1,10:00"],
        "prices": ["datetime,stock,price", "2026-03-02,TCS,100", "2026-03-03,TCS,110", "2026-03-04,TCS,0", "2026-03-05,TCS,", "2025-01-01,XYZ,5"],
    }.items():
        os.makedirs(os.path.join(tmp_dir, name))
        with open(os.path.join(tmp_dir, name, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    out = os.path.join(tmp_dir, "out")
    res = pipeline.run_from_csv(spark, os.path.join(tmp_dir, "orders"), os.path.join(tmp_dir, "prices"), out, LATEST_PAIR, "2026-03-05", "r1")
    rows = spark.read.parquet(os.path.join(out, "results", "run_id=r1")).collect()
    # 3.0 spreads (45 points) and +10 % (40 points)
    assert [(r.trader_id, r.quantity, r.suspicion_score) for r in rows] == [("T1", 3000000000, 85)]
    assert [r.stock for r in res.unpriced.collect()] == ["XYZ"]  # its price is older than the window
    exported = spark.read.option("header", True).csv(os.path.join(out, "suspicious_trades", "run_id=r1")).collect()
    assert [r.trader_id for r in exported] == ["T1"]
    assert spark.read.text(os.path.join(out, "raw", "run_id=r1")).count() == 13


def test_landed_lines_keep_carriage_returns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.txt")
    with open(path, "wb") as fh:
        fh.write(b"a,b\r\nc,d\r\n")
    out = files.land_raw(src.read_lines(spark, path).coalesce(1), os.path.join(tmp_dir, "raw"))
    part = next(f for f in os.listdir(out) if f.startswith("part-"))
    with open(os.path.join(out, part), "rb") as fh:
        assert fh.read() == b"a,b\r\nc,d\r\n"


def test_untruncated_print_of_results(spark, capsys):
    hits = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    hits.show(truncate=False)
    out = capsys.readouterr().out
    assert "Trade followed by significant price increase (>5%)" in out


def test_command_line_run_and_alerts(spark, tmp_dir, capsys):
    """Orders CSV in, pipeline out: the committed sample gives its four alerts."""
    from fixtures import SAMPLE_LAST_TWO, SAMPLE_ORDERS
    from tradewatch.__main__ import main

    orders_dir = os.path.join(tmp_dir, "orders")
    os.makedirs(orders_dir)
    with open(os.path.join(orders_dir, "orders.csv"), "w") as fh:
        fh.write("trader_id,stock,quantity,price,timestamp\n")
        fh.writelines(f"{a},{b},{c},{d},{e}\n" for a, b, c, d, e in SAMPLE_ORDERS)
    prices_dir = os.path.join(tmp_dir, "prices")
    os.makedirs(prices_dir)
    with open(os.path.join(prices_dir, "prices.csv"), "w") as fh:
        fh.write("datetime,stock,price\n")
        for s, (a, b) in SAMPLE_LAST_TWO.items():
            fh.write(f"2026-03-03,{s},{a * 0.99}\n2026-03-04,{s},{a}\n2026-03-04,{s},{b}\n")
    out = os.path.join(tmp_dir, "out")
    assert main(["run", "--orders", orders_dir, "--prices", prices_dir, "--out", out, "--as-of", "2026-03-04",
                 "--run-id", "r1"]) == 0
    printed = capsys.readouterr().out
    assert "orders_in: 15" in printed and "flagged: 4" in printed
    assert main(["alerts", "--results", os.path.join(out, "results", "run_id=r1")]) == 0
    printed = capsys.readouterr().out
    assert "10,000" in printed and "57%" in printed


def test_file_arrival_of_reference_style_orders(spark, tmp_dir):
    """Five text columns with time-only timestamps, as the reference's uploads."""
    from fixtures import SAMPLE_ORDERS

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "orders.CSV"), "w") as fh:
        fh.write("trader_id,stock,quantity,price,timestamp\n")
        fh.writelines(f"{a},{b},{c},{d},{e}\n" for a, b, c, d, e in SAMPLE_ORDERS)
    with open(os.path.join(landing, "notes.txt"), "w") as fh:
        fh.write("not an upload\n")
    table = _name("suspicious_trades")
    q = run_on_arrival(spark, landing, sample_closes(spark), table, os.path.join(tmp_dir, "ckpt"), LATEST_PAIR,
                       None, os.path.join(tmp_dir, "res"), layout="orders", run_date="2026-03-04")
    q.awaitTermination()
    got = {(r.trader_id, r.stock, r.quantity, r.suspicion_score) for r in src.read_results(spark, table).collect()}
    assert got == SAMPLE_FLAGGED


def test_fractional_quantity_per_profile(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    os.makedirs(path)
    with open(os.path.join(path, "o.csv"), "w") as fh:
        fh.write("trader_id,stock,quantity,price,timestamp\nT1,TCS,1.5,3500,10:10\nT2,TCS,7,3500,10:15\n")
    local = {(r.trader_id, r.quantity) for r in src.read_orders_csv(spark, path, LATEST_PAIR.truncate_quantity).collect()}
    cluster = {(r.trader_id, r.quantity) for r in src.read_orders_csv(spark, path, POST_TRADE.truncate_quantity).collect()}
    assert local == {("T1", 1), ("T2", 7)}
    assert cluster == {("T1", None), ("T2", 7)}  # unparsed -> dropped by the validity rule


def test_pipeline_failure_in_a_concurrent_output_is_raised(spark, tmp_dir):
    bad_closes = sample_closes(spark).withColumn("close", F.raise_error(F.lit("price feed broken")).cast("double"))
    with pytest.raises(Exception, match="price feed broken"):
        pipeline.run(spark, sample_trades(spark), bad_closes, os.path.join(tmp_dir, "out"), LATEST_PAIR, "r1")
