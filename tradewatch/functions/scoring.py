"""Scoring expressions (the domain core), one builder per formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch.functions.parsing import col


def zscore(q, avg, sd) -> Column:
    """(quantity - avg) / sd; null when sd is null or 0."""
    q, avg, sd = col(q), col(avg), col(sd)
    return F.when(sd.isNotNull() & (sd > 0), (q - avg) / sd)


def floored_spread(avg, sd) -> Column:
    """max(sd or 0, 1 % of mean, 1): the latest_pair divisor."""
    return F.greatest(F.coalesce(col(sd), F.lit(0.0)), col(avg) * P.FLOOR_FRACTION, F.lit(P.FLOOR_MIN))


def _clamp(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def size_score(q, avg, sd, floor: bool) -> Column:
    """z * 15 clamped to [0, 60].

    floor=False: 0 when sd is null or 0 (post_trade);
    floor=True: sd is already floored, never 0 (latest_pair).
    """
    q, avg, sd = col(q), col(avg), col(sd)
    raw = _clamp((q - avg) / sd * P.SIZE_WEIGHT, 0.0, P.SIZE_CAP)
    if floor:
        return raw
    return F.when(sd.isNotNull() & (sd > 0), raw).otherwise(F.lit(0.0))


def price_change_pct(cur, nxt) -> Column:
    """(next - cur) / cur * 100; 0 when either is missing or cur <= 0."""
    cur, nxt = col(cur), col(nxt)
    ok = cur.isNotNull() & nxt.isNotNull() & (cur > 0)
    return F.when(ok, (nxt - cur) / cur * 100).otherwise(F.lit(0.0))


def price_score(chg) -> Column:
    """min(40, change * 4) when change > 2 %, else 0."""
    chg = col(chg)
    return F.when(chg > P.PRICE_TRIGGER_PCT, F.least(F.lit(P.PRICE_CAP), chg * P.PRICE_WEIGHT)).otherwise(
        F.lit(0.0)
    )


def suspicion_score(size, price) -> Column:
    """Truncated min(100, size + price), floored at 0."""
    return _clamp(col(size) + col(price), 0.0, P.SCORE_CAP).cast("int")


def is_large(q, avg, sd, sigma: float) -> Column:
    """quantity > avg + sigma * sd (null sd -> not large)."""
    return F.coalesce(col(q) > col(avg) + F.lit(sigma) * col(sd), F.lit(False))


def reason(q, avg, sd, chg, profile: P.Profile) -> Column:
    big = is_large(q, avg, sd, profile.sigma)
    spike = col(chg) > P.SPIKE_PCT
    both, large, spiked, other = profile.reasons
    return (
        F.when(big & spike, F.lit(both))
        .when(big, F.lit(large))
        .when(spike, F.lit(spiked))
        .otherwise(F.lit(other))
    )


def severity(score) -> Column:
    s = col(score)
    return F.when(s >= P.CRITICAL_AT, F.lit("critical")).when(s >= P.MODERATE_AT, F.lit("moderate")).otherwise(
        F.lit("low")
    )
