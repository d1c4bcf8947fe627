"""Literal fixtures: the reference's committed sample run (FIXTURES.md §2)."""

import datetime as dt

from pyspark.sql import functions as F

from tradewatch import schemas

# The 15 sample orders (trader_id, stock, quantity, price, timestamp).
SAMPLE_ORDERS = [
    ("T201", "TCS", 10000, 3500.0, "10:10"),
    ("T202", "INFY", 200, 1470.0, "10:15"),
    ("T203", "RELIANCE", 15000, 2500.0, "10:20"),
    ("T204", "TCS", 50, 3600.0, "10:25"),
    ("T205", "WIPRO", 500, 420.0, "10:30"),
    ("T206", "HDFCBANK", 8000, 1650.0, "10:35"),
    ("T207", "INFY", 12000, 1480.0, "10:40"),
    ("T208", "RELIANCE", 100, 2510.0, "10:45"),
    ("T209", "TCS", 300, 3550.0, "10:50"),
    ("T210", "WIPRO", 9000, 430.0, "10:55"),
    ("T211", "HDFCBANK", 150, 1660.0, "11:00"),
    ("T212", "INFY", 400, 1490.0, "11:05"),
    ("T213", "TCS", 11000, 3520.0, "11:10"),
    ("T214", "RELIANCE", 250, 2520.0, "11:15"),
    ("T215", "WIPRO", 8500, 425.0, "11:20"),
]

# Last two committed closes per stock; both carry 2026-03-04.
SAMPLE_LAST_TWO = {
    "TCS": (3125.42, 3437.96),
    "INFY": (1330.10, 1463.11),
    "RELIANCE": (2222.08, 2444.29),
    "WIPRO": (387.12, 394.87),
    "HDFCBANK": (1480.61, 1510.22),
}

# The committed flagged rows (latest_pair profile).
SAMPLE_FLAGGED = {
    ("T201", "TCS", 10000, 51),
    ("T203", "RELIANCE", 15000, 57),
    ("T207", "INFY", 12000, 57),
    ("T213", "TCS", 11000, 54),
}
SPIKE_REASON = "Trade followed by significant price increase (>5%)"

SAMPLE_DAY = dt.date(2026, 3, 4)


def sample_trades(spark):
    rows = []
    for i, (tr, st, q, p, t) in enumerate(SAMPLE_ORDERS):
        h, m = map(int, t.split(":"))
        rows.append((i + 1, tr, st, q, p, t, SAMPLE_DAY, dt.datetime(2026, 3, 4, h, m)))
    return spark.createDataFrame(rows, schemas.TRADES)


def sample_closes(spark):
    """Closes: one earlier day (lower price) plus the two same-day closes."""
    rows = []
    for st, (a, b) in SAMPLE_LAST_TWO.items():
        rows.append((st, dt.date(2026, 3, 3), a * 0.99, dt.datetime(2026, 3, 3, 15, 30)))
        rows.append((st, SAMPLE_DAY, a, dt.datetime(2026, 3, 4, 15, 29)))
        rows.append((st, SAMPLE_DAY, b, dt.datetime(2026, 3, 4, 15, 30)))
    return spark.createDataFrame(rows, "stock string, price_date date, close double, close_ts timestamp_ntz")


def trades_from_rows(spark, rows, day=SAMPLE_DAY):
    """(stock, quantity) or (trader, stock, quantity) tuples -> trades frame."""
    out = []
    for i, r in enumerate(rows):
        tr, st, q = (f"T{i}", *r) if len(r) == 2 else r
        out.append((i + 1, tr, st, q, 100.0, "10:00", day, dt.datetime.combine(day, dt.time(10, 0)) + dt.timedelta(seconds=i)))
    return spark.createDataFrame(out, schemas.TRADES)


def closes_from_rows(spark, rows):
    """(stock, date, close[, close_ts]) tuples -> closes frame."""
    out = []
    for r in rows:
        st, d, c = r[:3]
        ts = r[3] if len(r) > 3 else dt.datetime.combine(d, dt.time(23, 0))
        out.append((st, d, float(c), ts))
    return spark.createDataFrame(out, "stock string, price_date date, close double, close_ts timestamp_ntz")


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def col_set(df, *cols):
    return {tuple(r) for r in df.select(*[F.col(c) for c in cols]).collect()}
