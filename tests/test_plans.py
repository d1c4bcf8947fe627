"""Plan checks: broadcast joins for derived sides, no Python in the plans,
partial top-k, pushdown and pruning at the scan, and the as-of rewrite
against a brute-force form."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewatch.operators import prices, score
from tradewatch.plans.queries import QUERIES
from tradewatch.profiles import LATEST_PAIR, POST_TRADE
from tradewatch.sources.events import daily_closes, load_trades, read_events

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("profile", [POST_TRADE, LATEST_PAIR])
def test_score_is_broadcast_without_trade_shuffle(spark, profile):
    t = load_trades(spark, SF)
    plan = plan_of(score.score(t, daily_closes(t), profile))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    # the trade side streams straight from the scan: no exchange in the main plan
    assert "Exchange hashpartitioning" not in plan


def test_no_python_evaluation_in_any_query(spark):
    for name in ("flagged_post_trade", "flagged_latest_pair", "clean_orders", "asof_next_price", "stock_profile"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_last_two_uses_partial_window_group_limit(spark):
    t = load_trades(spark, SF)
    df = prices.last_two_prices(daily_closes(t))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scan_prunes_columns(spark):
    df = load_trades(spark, SF).groupBy("stock").agg(F.avg("quantity"))
    plan = plan_of(df)
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    # stock, quantity and the validity filter need user_id, event_type, value, props only
    assert "event_type" in read and "value" in read
    assert "ts:" not in read and "event_id" not in read


def test_asof_matches_brute_force(spark):
    """Equi-join rewrite of the forward as-of join against a union + window form."""
    t = load_trades(spark, SF)
    c = daily_closes(t)
    fast = {(r.trade_id, r.next_price, r.next_price_ts) for r in prices.asof_next_price(t, c).collect()}
    reused = {(r.trade_id, r.next_price, r.next_price_ts) for r in prices.asof_next_price(t, c, days_from_closes=True).collect()}
    assert reused == fast
    events = t.select("trade_id", "stock", F.col("trade_ts").alias("ts"), F.lit(None).cast("double").alias("px"),
                      F.lit(None).cast("timestamp_ntz").alias("px_ts"), F.lit(1).alias("k"))
    obs = c.select(F.lit(None).cast("long").alias("trade_id"), "stock", F.col("close_ts").alias("ts"),
                   F.col("close").alias("px"), F.col("close_ts").alias("px_ts"), F.lit(0).alias("k"))
    # closes sort before trades at equal times: "strictly after" excludes them
    w = Window.partitionBy("stock").orderBy("ts", "k").rowsBetween(1, Window.unboundedFollowing)
    both = events.unionByName(obs)
    nxt = F.first(F.when(F.col("k") == 0, F.struct("px", "px_ts")), ignorenulls=True).over(w)
    brute = both.withColumn("n", nxt).where("k = 1").select("trade_id", F.col("n.px").alias("p"), F.col("n.px_ts").alias("pt"))
    slow = {(r.trade_id, r.p, r.pt) for r in brute.collect()}
    assert fast == slow and len(fast) == t.count()


def test_events_scan_pushdown(spark):
    df = read_events(spark, SF).where(F.col("event_type") == "click").select("event_id")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan


def test_over_bound_side_falls_back_to_shuffle_join(spark):
    from tradewatch.operators.joins import join_small

    t = load_trades(spark, SF)
    stats = t.groupBy("stock").agg(F.avg("quantity").alias("a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        small = join_small(t, stats, "stock", "left", max_rows=4)  # 5 stocks > 4
        plan = plan_of(small)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        wide = join_small(t, stats, "stock", "left", max_rows=5)
        assert "BroadcastHashJoin" in plan_of(wide)
        assert small.count() == wide.count() == t.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_stats_and_closes_single_pass_matches_separate(spark):
    from tradewatch.operators import stats as st

    t = load_trades(spark, SF)
    s_side, c_side = st.stats_and_closes(t)
    sep_stats = {tuple(r) for r in st.stock_stats(t, "samp").collect()}
    one_stats = {tuple(r) for r in s_side.df.select("stock", "avg_qty", "stddev_qty", "trade_count").collect()}
    assert {(a, round(b, 9), round(c, 9), d) for a, b, c, d in sep_stats} == {
        (a, round(b, 9), round(c, 9), d) for a, b, c, d in one_stats
    }
    assert {tuple(r) for r in c_side.df.collect()} == {tuple(r) for r in daily_closes(t).collect()}
    assert (s_side.rows, c_side.rows) == (5, 150)
    # reading one level prunes the other level's folder
    assert "PartitionFilters: [isnotnull(level" in plan_of(s_side.df)


def test_fallback_join_splits_a_hot_stock(spark):
    """A stock holding most trades: above the broadcast bound the shuffle join
    is split by AQE's skew handling instead of landing in one task."""
    from fixtures import trades_from_rows
    from tradewatch.operators.joins import join_small

    rows = [("HOT", i % 97 + 1) for i in range(30000)] + [(f"S{j}", 5) for j in range(40) for _ in range(50)]
    t = trades_from_rows(spark, rows).repartition(8)
    stats = t.groupBy("stock").agg(F.avg("quantity").alias("a"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        j = join_small(t, stats, "stock", "left", max_rows=10)  # 41 stocks > 10: no broadcast
        assert len(j.collect()) == 32000
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_binding_stays_in_whole_stage_codegen(spark):
    t = load_trades(spark, SF)
    jvm = spark.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(t._jdf.queryExecution(), "formatted").split("\n\n\n")[0]
    ops = [line.strip("+-: ") for line in text.splitlines()[1:] if "(" in line]
    assert all(op.startswith("*") or op.startswith("Scan") for op in ops), ops


def test_closes_use_hash_aggregation(spark):
    """The last-trade-of-day arg-max keeps hash aggregation (no sort of trade partitions)."""
    from tradewatch.functions.ordering import time_then_id_key

    t = load_trades(spark, SF)
    both_levels = t.groupingSets([["stock"], ["stock", "trade_date"]], "stock", "trade_date").agg(
        F.max_by("price", time_then_id_key("trade_ts", "trade_id"))
    )
    for df in (daily_closes(t), both_levels):
        plan = plan_of(df)
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_time_then_id_key_orders_like_the_pair(spark):
    import datetime as dt

    from tradewatch.functions.ordering import time_then_id_key

    rows = [(dt.datetime(2024, 1, 1, h, m, s, us), i) for h, m, s, us, i in
            [(0, 0, 0, 0, -5), (0, 0, 0, 0, 7), (0, 0, 0, 1, -9), (9, 59, 59, 999999, 3), (10, 0, 0, 0, 2),
             (23, 59, 59, 999999, 2**62), (23, 59, 59, 999999, -(2**62))]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id long").select("ts", "id", time_then_id_key("ts", "id").alias("k"))
    got = [(r.ts, r.id) for r in df.orderBy("k").collect()]
    assert got == sorted(rows)


def test_lookback_window_reaches_the_scan(spark):
    from tradewatch.plans.queries import QUERIES as Q

    df = Q["prices_lookback"](spark, SF)
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(ts,2023-12-26T00:00)" in p and "LessThan(ts,2024-01-26T00:00)" in p for p in pushed)


def test_byte_bound_also_limits_broadcast(spark):
    from tradewatch.operators.joins import join_small, small_side

    t = load_trades(spark, SF)
    stats = t.groupBy("stock").agg(F.avg("quantity").alias("a"))
    side = small_side(stats)
    texts = sum(len(r.stock) for r in stats.collect())
    assert (side.rows, side.text_bytes, side.size()) == (5, texts, texts + 5 * (8 + 16))  # texts are measured, not guessed
    spark.conf.set("tradewatch.broadcast.maxBytes", str(side.size() - 1))  # just over the bound
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(join_small(t, stats, "stock", "left"))
        spark.conf.set("tradewatch.broadcast.maxBytes", str(side.size()))
        assert "BroadcastHashJoin" in plan_of(join_small(t, stats, "stock", "left"))
    finally:
        for k in ("tradewatch.broadcast.maxBytes", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
