"""Randomised cleaner check: Spark against a plain-Python model of the same rules."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import lines
from tradewatch.functions.parsing import FLOAT_PATTERN, INT_PATTERN
from tradewatch.operators import clean

NAMES = ["T1", "T22", "", " T3 ", "trader_id", "DateTime", "datetime", "x y"]
INTS = ["5", "+7", "-3", "0", "0012", "1.5", "99999999999", "", "abc", " 8 ", "1e3", "1_000"]
FLOATS = ["3.5", "1e3", ".5", "5.", "+.5", "nan", "inf", "-2", "0", "", "1.0d", "1e400", "abc", " 2.25 "]
TIMES = ["10:10", "", "25:99", " 09:05 "]
DATES = ["2026-03-04", "", "x"]


def model(line: str):
    """The cleaning rules, written directly in Python."""
    line = line.strip(" \t")
    if not line:
        return None
    parts = line.split(",")
    if parts[0].strip(" \t").lower() in ("trader_id", "datetime"):
        return None
    f = [p.strip(" \t") for p in parts]

    def num(s):
        if not re.fullmatch(FLOAT_PATTERN[1:-1], s):
            return None
        v = float(s)
        return v if math.isfinite(v) else None

    if len(f) == 5:
        tr, stock, q, p, tm = f
        if not re.fullmatch(INT_PATTERN[1:-1], q) or not (-(2**63) <= int(q) < 2**63):
            return None
        qty, px = int(q), num(p)
        if px is None or qty <= 0 or px <= 0 or not stock or not tr:
            return None
        return ("ORDER", tr, stock, qty, px, tm)
    if len(f) == 3:
        d, stock, p = f
        px = num(p)
        if px is None or px <= 0 or not stock:
            return None
        return ("PRICE", d, stock, px)
    return None


order_lines = st.tuples(st.sampled_from(NAMES), st.sampled_from(NAMES + ["TCS"]), st.sampled_from(INTS),
                        st.sampled_from(FLOATS), st.sampled_from(TIMES)).map(",".join)
price_lines = st.tuples(st.sampled_from(DATES), st.sampled_from(["TCS", "", " INFY "]), st.sampled_from(FLOATS)).map(",".join)
odd_lines = st.sampled_from(["", "   ", "a,b", "T1,TCS,5,3.5,10:10,extra", "\t"])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(order_lines, price_lines, odd_lines, order_lines.map(lambda s: "  " + s + " ")),
                min_size=40, max_size=120))
def test_cleaner_matches_python_model(spark, batch):
    df = lines(spark, batch)
    want_o = sorted(m[1:] for m in map(model, batch) if m and m[0] == "ORDER")
    want_p = sorted(m[1:] for m in map(model, batch) if m and m[0] == "PRICE")
    got_o = sorted(tuple(r) for r in clean.clean_orders(df).collect())
    got_p = sorted(tuple(r) for r in clean.clean_prices(df).collect())
    assert got_o == want_o
    assert got_p == want_p
    assert clean.tagged_records(df).count() == len(want_o) + len(want_p)
