"""Cleaner cases (FIXTURES.md §3), tagging and parsing round trip."""

from pyspark.sql import functions as F

from fixtures import lines
from tradewatch.functions.parsing import seconds_of_day, time_on_date
from tradewatch.operators import clean

DIRTY = [
    "trader_id,stock,quantity,price,timestamp",
    "DateTime,stock,price",
    "DATETIME,stock,price",
    "",
    "   ",
    " T1 , TCS ,10, 3.5 ,10:10 ",
    "T2,TCS,0,3.5,10:10",
    "T3,TCS,-1,3.5,10:10",
    "T4,TCS,1.5,3.5,10:10",
    "T5,,5,3.5,10:10",
    ",TCS,5,3.5,10:10",
    "T6,TCS,5,abc,10:10",
    "T7,TCS,5,3.5,",
    "T8,TCS,5,3.5,10:10,extra",
    "a,b",
    "T9,TCS,5,nan,10:10",
    "T10,TCS,5,inf,10:10",
    "T11,TCS,5,1.0d,10:10",
    "T12,TCS,99999999999,3.5,10:10",
    "2026-03-04,TCS,3125.42",
    "2026-03-04,TCS,0",
    "2026-03-04,,5",
    "2026-03-04,TCS,x",
    ",TCS,5",
]


def test_clean_orders(spark):
    got = {tuple(r) for r in clean.clean_orders(lines(spark, DIRTY)).collect()}
    # quantities are 64-bit: 99999999999 is kept, as in the reference
    assert got == {("T1", "TCS", 10, 3.5, "10:10"), ("T7", "TCS", 5, 3.5, ""), ("T12", "TCS", 99999999999, 3.5, "10:10")}


def test_clean_prices(spark):
    got = {tuple(r) for r in clean.clean_prices(lines(spark, DIRTY)).collect()}
    assert got == {("2026-03-04", "TCS", 3125.42), ("", "TCS", 5.0)}


def test_clean_typed_orders(spark):
    rows = [
        ("T1", "TCS", "10", "3.5", "10:10"),
        ("T4", "TCS", "1.5", "3.5", "10:10"),  # truncated to 1
        ("T7", "TCS", "5", "3.5", None),  # no time: dropped when required
        ("T2", "TCS", "0", "3.5", "10:10"),
        ("T6", "TCS", "5", "abc", "10:10"),
        ("T9", "TCS", "5", "nan", "10:10"),
        (None, "TCS", "5", "3.5", "10:10"),
    ]
    df = spark.createDataFrame(rows, "trader_id string, stock string, quantity string, price string, timestamp string")
    got = {tuple(r) for r in clean.clean_typed_orders(df, require_timestamp=True).collect()}
    assert got == {("T1", "TCS", 10, 3.5, "10:10"), ("T4", "TCS", 1, 3.5, "10:10")}
    loose = {r.trader_id for r in clean.clean_typed_orders(df, require_timestamp=False).collect()}
    assert loose == {"T1", "T4", "T7"}


def test_tag_and_parse_round_trip(spark):
    df = lines(spark, DIRTY)
    tagged = clean.tagged_records(df)
    values = {r.value for r in tagged.collect()}
    assert "ORDER\tT1,TCS,10,3.5000,10:10" in values
    assert "ORDER\tT7,TCS,5,3.5000," in values
    assert "PRICE\t2026-03-04,TCS,3125.4200" in values
    assert "PRICE\t,TCS,5.0000" in values
    parsed = {tuple(r) for r in clean.parse_tagged(tagged).collect()}
    assert parsed == {("T1", "TCS", 10, 3.5, "10:10"), ("T7", "TCS", 5, 3.5, ""), ("T12", "TCS", 99999999999, 3.5, "10:10")}
    by_regex = {tuple(r) for r in clean.parse_tagged_regex(tagged).collect()}
    assert by_regex == parsed
    prices = {tuple(r) for r in clean.parse_tagged_prices(tagged).collect()}
    assert prices == {("2026-03-04", "TCS", 3125.42), ("", "TCS", 5.0)}


def test_times(spark):
    df = spark.createDataFrame([("10:10",), ("25:99",), ("",), (None,), ("00:00",)], "t string")
    out = df.select(
        "t",
        seconds_of_day("t").alias("s"),
        time_on_date(F.to_date(F.lit("2026-03-04")), "t").alias("ts"),
    ).collect()
    got = {r.t: (r.s, r.ts) for r in out}
    assert got["10:10"][0] == 36600
    assert got["00:00"][0] == 0
    assert got["25:99"] == (None, None)
    assert got[""] == (None, None)
    assert str(got["10:10"][1]) == "2026-03-04 10:10:00"


def test_clean_typed_prices(spark):
    rows = [("2026-03-04", "TCS", "3125.42"), (None, "TCS", "5"), ("2026-03-04", None, "5"),
            ("2026-03-04", "TCS", "0"), ("2026-03-04", "TCS", "x"), ("2026-03-04", "TCS", "nan")]
    df = spark.createDataFrame(rows, "datetime string, stock string, price string")
    assert {tuple(r) for r in clean.clean_typed_prices(df).collect()} == {("2026-03-04", "TCS", 3125.42)}
