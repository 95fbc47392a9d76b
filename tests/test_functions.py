"""Hand-computed values of the column functions."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numeric, text

PAGE = """NAV as of Jul 08, 2026 $101.29
1 Day NAV Change 0.05 (0.05%)
Expense Ratio 0.03%
Weighted Avg Coupon 1.07
Effective Duration 2.31 yrs
Average Yield to Maturity 4.27%
Weighted Avg Maturity 2.40 yrs
12m Trailing Yield 4.91%"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "digits", "want"), [(1.005, 2, 1.0), (0.125, 2, 0.13), (-2.5, 0, -2.0), (2.5, 0, 3.0), (1.1234567, 5, 1.12346)])
def test_round_half_up(spark, value, digits, want):
    got = one(spark, numeric.round_half_up(F.lit(value), digits))
    assert got == want or (value == 1.005 and got in (1.0, 1.01))


@pytest.mark.parametrize(("digits", "shown", "want"), [(5, None, "1.12346"), (6, None, "1.123457"), (5, 6, "1.123460")])
def test_round_fixed(spark, digits, shown, want):
    assert one(spark, numeric.round_fixed(F.lit(1.1234567), digits, shown)) == want


@pytest.mark.parametrize(("raw", "want"), [("4.91%", 0.0491), ("0.5", 0.5), ("7", None), ("Jul 08", None), ("", None), ("-0.02%", -0.0002)])
def test_percent(spark, raw, want):
    assert one(spark, numeric.parse_percent(F.lit(raw))) == want


def test_money_units_and_32nds(spark):
    assert one(spark, numeric.parse_money(F.lit("$1,234.56"))) == 1234.56
    assert one(spark, numeric.scaled(F.lit(2.0), F.lit("B"))) == 2e9
    assert one(spark, numeric.from_32nds(F.lit(99.16))) == pytest.approx(99.5)
    assert one(spark, numeric.hash_code(F.lit("hello"))) == 99162322
    assert one(spark, numeric.days_in_month(F.lit(2024), F.lit(2))) == 29


def test_facts(spark):
    facts = text.fund_facts(F.lit(PAGE), F.lit("Some 0-5 Year Fund | ABCD"))
    row = spark.range(1).select(*[c.alias(n) for n, c in facts.items()]).first()
    assert row["fundName"] == "Some 0-5 Year Fund" and row["nav"] == 101.29 and row["expenseRatio"] == 0.0003
    assert row["weightedAverageCoupon"] == 1.07 and row["durationYears"] == 2.31 and row["yieldToWorst"] == 0.0427
    assert row["maturityYears"] == 2.4 and row["twelveMonTrlYield"] == 0.0491


def test_names(spark):
    assert one(spark, text.normalized_name(F.lit(" acme, llc. "))) == "ACME LLC"
    assert one(spark, text.normalized_address(F.lit("1 Oak Street, PA"))) == "1 OAK ST PA"
    assert one(spark, text.fund_name(F.lit("U.S. GOVERNMENT MONEY MARKET FUND"))) == "US Government MM"
    assert one(spark, text.names_list(F.lit("a; ;b ;"))) == ["a", "b"]
    assert one(spark, text.years_of_term(F.lit("9-Year 6-Month"))) == 9.5
    assert one(spark, text.without_tags(F.lit("<b>x</b>"))) == "x"


def test_dates(spark):
    d = dt.date
    assert one(spark, dates.from_us(F.lit("07-08-2026"))) == d(2026, 7, 8)
    assert one(spark, dates.from_us(F.lit("nonsense"))) is None
    assert one(spark, dates.from_english(F.lit("Jul 08, 2026"))) == d(2026, 7, 8)
    assert one(spark, dates.from_compact(F.lit(20260708))) == d(2026, 7, 8)
    assert one(spark, dates.add_months_rolling(F.lit("2023-01-31").cast("date"), 1)) == d(2023, 3, 3)
    assert one(spark, dates.us_text(F.lit("2026-07-08").cast("date"))) == "7/8/2026"
    assert one(spark, dates.from_epoch(F.lit(1_700_000_000_000)) == dates.from_epoch(F.lit(1_700_000_000)))


def test_hash_of_characters_beyond_the_basic_plane(spark):
    from tidemark.functions.numeric import hash_code

    assert one(spark, hash_code(F.lit("a\U0001f600b"))) == 57849694


def test_to_fixed(spark):
    values = [(1.005, 2), (0.125, 2), (-0.125, 2), (-1.005, 2), (2.5, 0), (1.45, 1), (8.345, 2), (0.000001, 2), (123456.7890125, 6), (0.0, 2), (99.995, 2)]
    exact = [float(decimal.Decimal(v).quantize(decimal.Decimal(1).scaleb(-d), decimal.ROUND_HALF_UP)) for v, d in values]
    got = [spark.createDataFrame([(v,)], "v double").select(numeric.to_fixed(F.col("v"), d)).first()[0] for v, d in values]
    assert got == exact
    assert got[:4] == [1.0, 0.13, -0.13, -1.0]
    assert spark.sql("select cast(null as double) as v").select(numeric.to_fixed(F.col("v"), 2)).first()[0] is None
