"""Small tables with results worked out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import dedupe, diff, fiscal, series, stats
from tidemark.streaming import upsert

RATE = "ticker string, asOfDate string, source string, oneDayYield double, sevenDayYield double, thirtyDayYield double, timestamp string, ord long"


def rates(spark, rows):
    df = spark.createDataFrame([("T", d, s, a, b, c, t, i) for i, (d, s, a, b, c, t) in enumerate(rows)], RATE)
    return df.withColumn("asOfDate", F.col("asOfDate").cast("date")).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def winners(spark, rows):
    best = dedupe.best_source(dedupe.trusted_rates(rates(spark, rows), "2024-01-01", ("BASOX",)))
    return {r["asOfDate"].isoformat(): r["source"] for r in best.collect()}


def test_better_source_wins(spark):
    rows = [("2024-01-02", "edgar", None, 1.0, None, "2024-01-03"), ("2024-01-02", "fidelity", None, 2.0, None, "2024-01-02")]
    assert winners(spark, rows) == {"2024-01-02": "fidelity"}
    assert winners(spark, rows[::-1]) == {"2024-01-02": "fidelity"}


def test_ties_depend_on_the_order(spark):
    later, fuller = ("2024-01-02", "schwab", None, 1.0, None, "2024-01-05"), ("2024-01-02", "ally", 1.0, 1.0, None, "2024-01-04")
    assert winners(spark, [later, fuller]) == {"2024-01-02": "ally"}  # has a one-day yield
    assert winners(spark, [fuller, later]) == {"2024-01-02": "schwab"}  # is later


def test_untrusted_and_zero_rows_go(spark):
    rows = [
        ("2024-01-06", "cnbc", None, 1.0, None, None), ("2024-01-07", "fidelity", None, 1.0, None, None), ("2024-12-31", "mm.fun", None, 1.0, None, None),
        ("2024-01-09", "ally", None, 0.0, None, None), ("2024-01-10", "ally", None, None, 1.0, None), ("2024-01-11", "gapFiller (x)", None, 1.0, None, None), ("2023-12-29", "ally", None, 1.0, None, None),
    ]
    assert winners(spark, rows) == {"2024-01-07": "fidelity", "2024-01-10": "ally"}


def test_gaps_copy_the_winner(spark):
    best = dedupe.best_source(dedupe.trusted_rates(rates(spark, [("2024-01-02", "ally", None, 1.0, None, None), ("2024-01-05", "ally", None, 2.0, None, None)]), "2024-01-01"))
    got = sorted((r["asOfDate"].day, r["source"], r["sevenDayYield"]) for r in series.gap_filled(best, ["ticker"], "asOfDate", "source").collect())
    assert got == [(2, "ally", 1.0), (3, "gapFiller (ally)", 1.0), (4, "gapFiller (ally)", 1.0), (5, "ally", 2.0)]


def test_interpolation_bridges_months(spark):
    months = spark.createDataFrame([(dt.date(2024, 1, 1), 100.0), (dt.date(2024, 2, 1), 130.0)], "day date, v double")
    rows = sorted(map(tuple, series.interpolated(months, [], "day", "v").collect()))
    assert rows[0] == (dt.date(2024, 4, 1), 100.0) and rows[1] == (dt.date(2024, 4, 2), 101.0) and rows[-1] == (dt.date(2024, 5, 1), 130.0)
    assert len(rows) == 31


def test_total_return(spark):
    day = lambda n: dt.date(2024, 1, n)
    prices = spark.createDataFrame([("k", day(1), 10.0), ("k", day(3), 10.0), ("k", day(5), 20.0)], "k string, day date, price double")
    paid = spark.createDataFrame([("k", day(1), 5.0), ("k", day(2), 1.0), ("k", day(3), 1.0), ("k", day(9), 7.0)], "k string, day date, amount double")
    rows = sorted(map(tuple, series.total_return(prices, paid, ["k"]).collect()))
    assert rows == [("k", day(1), 10.0, 5.0, 10000.0), ("k", day(3), 10.0, 2.0, 12000.0), ("k", day(5), 20.0, 0.0, 24000.0)]


def test_upper_median_and_trimmed_mean(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (40.0,)], "v double")
    row = stats.valuation(df, [], "v", F.col("v") > 0, "a").first()
    assert row["a_median"] == 3.0 and row["a_avg"] == 12.0 and row["a_count"] == 4
    assert stats.valuation(df, [], "v", F.col("v") > 99, "a").first() == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert df.agg(stats.trimmed_mean("v").alias("x")).first()["x"] == 2.5


def test_fifty_percent_rule(spark):
    rows = [("f", "0930", y, m, s) for y, m, s in [(2023, 12, 0.6), (2024, 3, 0.5), (2024, 6, 0.7), (2024, 9, 0.9), (2024, 12, 0.4)]]
    q = fiscal.quarters(spark.createDataFrame(rows, "t string, year_end string, year int, month int, share double"), "t", "share").withColumn("q4_month", F.lit(9))
    got = {r["fiscal_year"]: r["passes"] for r in fiscal.fifty_percent_rule(q, "t").collect()}
    assert got == {2024: False, 2025: False}  # December 2024 is in the next fiscal year but in this calendar year


def test_write_if_changed(spark, tmp_path):
    a = spark.createDataFrame([(1, "x", "t1")], "id int, v string, timestamp string")
    assert diff.write_if_changed(a, f"{tmp_path}/t")
    assert not diff.write_if_changed(a.withColumn("timestamp", F.lit("t2")), f"{tmp_path}/t")
    assert diff.write_if_changed(a.withColumn("v", F.lit("y")), f"{tmp_path}/t")


def test_stream_windows(spark, tmp_path):
    events = spark.createDataFrame([(f"2024-01-0{d} 10:00:00", "a", 1.0) for d in (1, 1, 2, 5)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = upsert.windowed_counts(upsert.stream_of(spark, f"{tmp_path}/in", events.schema))
    q = stream.writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("windows").collect()) == [1, 2]
