"""Randomised scoring check: Spark against the formulas computed directly in Python."""

import datetime as dt
import math
import random
import statistics

import pytest

from fixtures import closes_from_rows
from tradewatch import schemas
from tradewatch.operators import score
from tradewatch.profiles import LATEST_PAIR, POST_TRADE

DAY0 = dt.date(2024, 3, 1)


def make_case(seed):
    rnd = random.Random(seed)
    trades, closes = [], []
    tid = 0
    for s in ("A", "B", "C"):
        days = sorted(rnd.sample(range(6), rnd.randint(1, 4)))
        price = rnd.uniform(50, 150)
        for d in days:
            price *= 1 + rnd.uniform(-0.04, 0.12)
            closes.append((s, DAY0 + dt.timedelta(days=d), round(price, 4)))
        for _ in range(rnd.randint(1, 25)):
            tid += 1
            d = rnd.randrange(6)
            q = rnd.choice([rnd.randint(1, 500), rnd.randint(1, 500), rnd.randint(2000, 20000)])
            trades.append((tid, f"T{tid}", s, q, 10.0, "10:00", DAY0 + dt.timedelta(days=d),
                           dt.datetime.combine(DAY0 + dt.timedelta(days=d), dt.time(10, 0))))
    return trades, closes


def expected(trades, closes, profile):
    by_stock = {}
    for t in trades:
        by_stock.setdefault(t[2], []).append(t[3])
    cl = {}
    for s, d, c in closes:
        cl.setdefault(s, []).append((d, c))
    for v in cl.values():
        v.sort()
    out = {}
    for tid, tr, s, q, *_rest in trades:
        day = _rest[2]
        qs = by_stock[s]
        mean = statistics.fmean(qs)
        sd = statistics.stdev(qs) if len(qs) > 1 else None
        seq = cl.get(s, [])
        if profile is POST_TRADE:
            idx = [i for i, (d, _) in enumerate(seq) if d == day]
            cur = seq[idx[0]][1] if idx else None
            nxt = seq[idx[0] + 1][1] if idx and idx[0] + 1 < len(seq) else None
            ch = (nxt - cur) / cur * 100 if cur and nxt is not None and cur > 0 else 0.0
            size = 0.0 if not sd else min(60.0, max(0.0, (q - mean) / sd * 15))
            used_sd = sd
        else:
            ch = (seq[-1][1] - seq[-2][1]) / seq[-2][1] * 100 if len(seq) >= 2 else 0.0
            used_sd = max(sd or 0.0, mean * 0.01, 1.0)
            size = min(60.0, max(0.0, (q - mean) / used_sd * 15))
        price = min(40.0, ch * 4) if ch > 2 else 0.0
        raw = min(100.0, max(0.0, size + price))
        big = used_sd is not None and q > mean + profile.sigma * used_sd
        out[tid] = (raw, big, ch > 5)
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("profile", [POST_TRADE, LATEST_PAIR], ids=lambda p: p.name)
def test_scores_match_formulas(spark, seed, profile):
    trades, closes = make_case(seed)
    t = spark.createDataFrame(trades, schemas.TRADES)
    c = closes_from_rows(spark, closes)
    want = expected(trades, closes, profile)
    got = {r.trade_id: r for r in score.score(t, c, profile).collect()}
    assert set(got) == set(want)
    for tid, (raw, _, _) in want.items():
        if abs(raw - round(raw)) > 1e-9:  # exact integer boundaries may truncate either way
            assert got[tid].suspicion_score == math.floor(raw), tid
    flagged = {r.trade_id: r.reason for r in score.flagged(t, c, profile).collect()}
    for tid, (raw, big, spike) in want.items():
        if abs(raw - round(raw)) > 1e-9:
            assert (tid in flagged) == (math.floor(raw) > profile.threshold), tid
        if tid in flagged:
            both, large, spiked, other = profile.reasons
            assert flagged[tid] == (both if big and spike else large if big else spiked if spike else other)
