"""Whole jobs on a few rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import composites as c


def test_prices_and_quotes(spark):
    rows = spark.createDataFrame([(["X1", "NOTE", "4.250%", "05/15/2034", "", "99.5", "99.4", "99.45", "z"],), (["short"],)], "cells array<string>").withColumn("asOfDate", F.lit("2024-01-02").cast("date"))
    got = c.treasury_prices(rows).collect()
    assert len(got) == 1 and got[0]["rate"] == "0.04250" and got[0]["endofday"] == "99.45000" and got[0]["key"] == "2034-05-15-0.04250"
    q = spark.createDataFrame([(["5/15/2034", "1.125", "99.16", "99.24", "unch.", "2.1", "1,050"],)], "cells array<string>").withColumn("asOfDate", F.lit("2024-01-02").cast("date"))
    row = c.quotes(q).first()
    assert abs(row["bid"] - 99.5) < 1e-9 and row["chg"] == 0.0 and row["accruedprincipal"] == 1050 and row["key"] == "2034-05-15-1.125"


def test_calendar_and_notes(spark):
    got = c.release_calendar(spark.createDataFrame([("June CPI Jul 14, 2026 08:30\nnothing\n",)], "text string")).collect()
    assert [tuple(r) for r in got] == [(dt.date(2026, 7, 14), dt.date(2026, 6, 1), dt.date(2026, 9, 1))]
    note = spark.createDataFrame([("C", "0.125", "9-Year 10-Month", "s", "2034-01-15T00:00:00", "2024-01-15", "307.123456")], "cusip string, interest_rate string, security_term string, series string, maturity_date string, dated_date string, ref_cpi_on_dated_date string")
    assert c.note_metadata(note).first()[1:3] == ("0.00125", 9.8333)


def test_filings(spark):
    schema = "cik string, fiscalYearEnd string, filings struct<accessionNumber array<string>, filingDate array<string>, reportDate array<string>, form array<string>, primaryDocument array<string>>"
    rows = spark.createDataFrame([("00123", "0930", (["1-2-3", "4"], ["2024-02-01", "2024-02-02"], ["2024-01-31", None], ["N-MFP3", "8-K"], ["p.xml", "q"]))], schema)
    got = c.filing_rows(rows, "MFP", "2019-01-01").collect()
    assert len(got) == 1 and got[0]["cik"] == "0000000123" and got[0]["url"] == "/data/123/123/p.xml"
    yields = spark.createDataFrame([("T", [("d1", 0.1), ("d2", 0.2)], [("d2", 1.001)])], "ticker string, yields array<struct<date string, value double>>, navs array<struct<date string, nav double>>")
    assert sorted(map(tuple, c.daily_yields(yields).collect())) == [("T", "d1", 0.1, 1.0), ("T", "d2", 0.2, 1.001)]
    assert c.daily_yields(yields, skip_first=True).count() == 1


def test_metadata_and_lists(spark):
    companies = spark.createDataFrame([("T", 123, "U.S. GOVERNMENT MONEY MARKET FUND")], "ticker string, cik long, series_name string")
    years = spark.createDataFrame([("0000000123", "0930"), ("1234", "1231")], "cik string, fiscalYearEnd string")
    cost = spark.createDataFrame([("T", 0.1, "2024-01-01"), ("T", 0.2, "2024-02-01")], "ticker string, expenseRatio double, timestamp string")
    row = c.fund_metadata(companies, years, cost).first()
    assert row["fiscalYearEnd"] == "0930" and row["expenseRatio"] == 0.2 and row["mmName"] == "US Government MM"
    one = spark.createDataFrame([(" ab",), ("",), ("AB",)], "t string")
    assert [r["t"] for r in c.consolidated([one, one], "t").collect()] == ["AB"]


def test_cases_offers_and_snapshots(spark):
    cases = spark.createDataFrame([("", "u1", "$1,000.00 and $5.50 and $5.50", 1), ("", "u1", "dup", 2), ("n", "u2", "none", 3), ("", " ", "x", 4)], "caseNumber string, detailUrl string, detail string, ord int")
    got = {r["detailUrl"]: (r["judgmentAmounts"], r["judgmentTotal"]) for r in c.judgments(cases).collect()}
    assert got == {"u1": ("$1,000.00 | $5.50", 1005.5), "u2": ("", None)}
    old = spark.createDataFrame([("s", "12", "d", "9", "a"), ("s", "6", "d", "9", "a")], "supplier string, term string, asOfDate string, rate string, url string")
    new = spark.createDataFrame([("s", "12", "d", "8", "b")], old.schema)
    assert sorted((r["term"], r["rate"]) for r in c.offers_history(old, new).collect()) == [("12", "8"), ("6", "9")]
    snaps = spark.createDataFrame([("A", "X", "1,234", "$5,000.5", "Jul 08, 2026"), ("B", "Y", "2", "$9,000", "Jul 08, 2026")], "index_name string, price_ticker string, num_companies string, market_cap string, as_of string")
    assert [r["index_name"] for r in c.index_snapshot(snaps).collect()] == ["B", "A"]
    cells = spark.createDataFrame([(1, 0, "2020", "$5.00"), (1, 1, "2021", "$6.25"), (1, 2, "Total", "$11.25")], "lot int, pos int, label string, amount string")
    assert c.running_balance(cells, "lot", "pos", "label", "amount").first()["total"] == 11.25


def test_payloads(spark):
    schema = "quotes array<struct<date long, close double>>, timestamp array<long>, close array<double>"
    rows = spark.createDataFrame([([(1_700_000_000, 1.0)], None, None), (None, [1_700_100_000_000, 1_700_200_000], [2.0, None])], schema)
    assert sorted((r["day"].isoformat(), r["price"]) for r in c.payload_prices(rows).collect()) == [("2023-11-14", 1.0), ("2023-11-16", 2.0)]
    url = spark.range(1).select(c.query_url("/q", symbol=F.lit("A B"), range=F.lit("1D")).alias("u")).first()["u"]
    assert url == "/q?symbol=A+B&range=1D"
    assert spark.range(1).select(c.without_last(F.array(F.lit(1), F.lit(2))).alias("x")).first()["x"] == [1]
