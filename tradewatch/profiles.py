"""Scoring profiles.

The reference ships the same scoring twice with different constants; one set of
operators is parameterised by a frozen ``Profile`` instead of forking code.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Must equal the reference's output text and constants exactly.
# Reason texts are listed in branch order: large and spike, large, spike, other.
POST_TRADE_REASONS = (
    "Large trade immediately before a price spike (probable insider trading)",
    "Abnormally large trade volume relative to stock average",
    "Trade followed by significant price increase (>5%)",
    "Combined volume and price anomaly detected",
)
LATEST_PAIR_REASONS = (
    "Large trade before price spike (probable insider trading)",
    "Abnormally large trade volume relative to stock average",
    "Trade followed by significant price increase (>5%)",
    "Combined volume and price anomaly",
)
SIZE_WEIGHT = 15.0  # points per standard deviation
SIZE_CAP = 60.0  # most points from trade size
PRICE_TRIGGER_PCT = 2.0  # price move needed before price points count
PRICE_WEIGHT = 4.0  # points per percent of price move
PRICE_CAP = 40.0  # most points from the price move
SCORE_CAP = 100.0
SPIKE_PCT = 5.0  # "significant price increase" in reason text
FLOOR_FRACTION = 0.01  # latest_pair spread floor: 1 % of mean ...
FLOOR_MIN = 1.0  # ... and never below 1
CRITICAL_AT = 90  # severity bands of the dashboard
MODERATE_AT = 70
LARGE_TRADE_SIGMA = 3.0  # spreads above the mean that make a trade large in the large-trades step
HIGH_VOLUME_MIN = 20000  # high-volume trader total quantity
LOOKBACK_DAYS = 30  # price history look-back
ORDER_HEADER_FIRST = "trader_id"  # header rows recognised by first field (any case)
PRICE_HEADER_FIRST = "datetime"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Profile:
    """Constants that differ between the two reference pipelines.

    sigma        multiple of the spread that makes a trade "large"
    threshold    flag when suspicion_score > threshold
    spread       estimator for large_trades: 'pop' or 'samp'
    floor        latest_pair floors the spread at max(sd, 1% of mean, 1);
                 post_trade scores size 0 when sd is null or 0
    price_move   'post_trade': that day's close vs the next close;
                 'latest_pair': last two closes of the stock
    reasons      four reason texts (see POST_TRADE_REASONS)
    require_timestamp  typed cleaner drops rows without a time
    truncate_quantity  a fractional quantity such as 1.5 is truncated to 1
                       (typed cleaner) instead of dropping the row (text cleaner)
    """

    name: str
    sigma: float
    threshold: int
    spread: str
    floor: bool
    price_move: str
    reasons: tuple[str, str, str, str]
    require_timestamp: bool
    truncate_quantity: bool


POST_TRADE = Profile(
    name="post_trade",
    sigma=3.0,
    threshold=70,
    spread="pop",
    floor=False,
    price_move="post_trade",
    reasons=POST_TRADE_REASONS,
    require_timestamp=False,
    truncate_quantity=False,
)

LATEST_PAIR = Profile(
    name="latest_pair",
    sigma=2.0,
    threshold=50,
    spread="samp",
    floor=True,
    price_move="latest_pair",
    reasons=LATEST_PAIR_REASONS,
    require_timestamp=True,
    truncate_quantity=True,
)

PROFILES = {p.name: p for p in (POST_TRADE, LATEST_PAIR)}
