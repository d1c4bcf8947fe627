"""Goldens from the reference's committed sample run (FIXTURES.md §2)."""

import pytest

from fixtures import SAMPLE_FLAGGED, SPIKE_REASON, col_set, sample_closes, sample_trades
from tradewatch.operators import prices, score, stats, summaries
from tradewatch.profiles import LATEST_PAIR, POST_TRADE


def test_flagged_latest_pair_matches_committed_run(spark):
    got = score.flagged(sample_trades(spark), sample_closes(spark), LATEST_PAIR)
    assert col_set(got, "trader_id", "stock", "quantity", "suspicion_score") == SAMPLE_FLAGGED
    assert {r.reason for r in got.collect()} == {SPIKE_REASON}


def test_price_change_of_last_two_closes(spark):
    pc = {r.stock: r.price_change_pct for r in prices.price_change_latest_pair(sample_closes(spark)).collect()}
    assert pc["TCS"] == pytest.approx(9.999936, abs=1e-6)
    assert pc["INFY"] == pytest.approx(10.0, abs=1e-6)
    assert pc["RELIANCE"] == pytest.approx(10.000090, abs=1e-6)
    assert pc["WIPRO"] == pytest.approx(2.001963, abs=1e-6)
    assert pc["HDFCBANK"] == pytest.approx(1.999851, abs=1e-6)


def test_stock_summary_sample_and_population(spark):
    t = sample_trades(spark)
    samp = {r.stock: r for r in summaries.stock_summary(t, "samp").collect()}
    pop = {r.stock: r for r in summaries.stock_summary(t, "pop").collect()}
    assert samp["TCS"].trade_count == 4
    assert samp["TCS"].avg_quantity == pytest.approx(5337.5)
    assert samp["TCS"].stddev_quantity == pytest.approx(5975.976210349792)
    assert samp["WIPRO"].stddev_quantity == pytest.approx(4769.696007084728)
    assert samp["RELIANCE"].stddev_quantity == pytest.approx(8559.546327541742)
    assert samp["INFY"].stddev_quantity == pytest.approx(6755.738301621815)
    assert samp["HDFCBANK"].stddev_quantity == pytest.approx(5550.788232314398)
    assert samp["TCS"].avg_price == pytest.approx(3542.5)
    assert pop["TCS"].stddev_quantity == pytest.approx(5175.347211, abs=1e-6)
    assert pop["HDFCBANK"].stddev_quantity == pytest.approx(3925.0)
    order = [r.stock for r in summaries.stock_summary(t, "samp").collect()]
    assert order == ["WIPRO", "TCS", "RELIANCE", "INFY", "HDFCBANK"]


def test_trader_summary_and_high_volume(spark):
    t = sample_trades(spark)
    rows = summaries.trader_summary(t).collect()
    assert len(rows) == 15
    assert (rows[0].trader_id, rows[0].total_quantity, rows[0].avg_price, rows[0].max_price) == ("T203", 15000, 2500.0, 2500.0)
    assert summaries.high_volume_traders(t).count() == 0  # largest total is 15000


def test_no_large_trades_in_small_groups(spark):
    t = sample_trades(spark)
    assert stats.large_trades(t, 3.0, "pop").count() == 0
    assert stats.large_trades(t, 3.0, "samp").count() == 0


def test_post_trade_profile_on_sample_flags_nothing(spark):
    # same-day closes only: the next close after 2026-03-04 does not exist, and
    # size alone is capped below the > 70 threshold in groups this small
    assert score.flagged(sample_trades(spark), sample_closes(spark), POST_TRADE).count() == 0
