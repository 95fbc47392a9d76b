"""Fiscal quarters and the fifty-per-cent rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_up

HALF = 0.5


def quarter_months(year_end: Column) -> list[Column]:
    """Months in which the four fiscal quarters end; December where the year's end is unknown."""
    q4 = F.coalesce(F.substring(year_end, 1, 2).try_cast("int"), F.lit(12))
    back = lambda q: F.when((q + 9) % 12 == 0, F.lit(12)).otherwise((q + 9) % 12)
    q3 = back(q4)
    q2 = back(q3)
    return [back(q2), q2, q3, q4]


def fiscal_year(year: Column, month: Column, q4: Column) -> Column:
    return year + F.when(month > q4, 1).otherwise(0)


def quarters(df: DataFrame, key: str, share: str) -> DataFrame:
    """(key, fiscal_year, q1..q4): shares in the months that end quarters. df: key, year_end, year, month."""
    ends = quarter_months(F.col("year_end"))
    marked = df.select(key, F.col("month"), F.col(share), fiscal_year(F.col("year"), F.col("month"), ends[3]).alias("fiscal_year"), *[e.alias(f"__m{i}") for i, e in enumerate(ends, 1)])
    at = lambda i: F.max(F.when(F.col("month") == F.col(f"__m{i}"), F.col(share))).alias(f"q{i}")
    return marked.groupBy(key, "fiscal_year").agg(*map(at, range(1, 5)))


def fifty_percent_rule(of_quarters: DataFrame, key: str, q4_month: str = "q4_month") -> DataFrame:
    """(key, fiscal_year, passes): no known quarter of the year under one half, nor any quarter of the next
    fiscal year that ends in this calendar year; years without a known quarter fail. of_quarters has the
    month that ends the fiscal year in q4_month."""
    names = ["q1", "q2", "q3", "q4"]
    after = of_quarters.select(key, (F.col("fiscal_year") - 1).alias("fiscal_year"), *[F.col(q).alias(f"n{q}") for q in names])
    low = lambda c: F.coalesce(F.col(c) < HALF, F.lit(False))
    own = low("q1") | low("q2") | low("q3") | low("q4")
    # the next fiscal year's quarter i ends 3 * i months after this one's last month
    ahead = F.lit(False)
    for i, q in enumerate(names, 1):
        ahead = ahead | (low(f"n{q}") & (F.col(q4_month) + 3 * i <= 12))
    known = F.coalesce(*[F.col(q) for q in names]).isNotNull()
    return of_quarters.join(after, [key, "fiscal_year"], "left").select(key, "fiscal_year", (known & ~own & ~ahead).alias("passes"))


def with_placeholder(years: DataFrame, key: str, current: int) -> DataFrame:
    """years, and last year's row as this year's where this year has none."""
    columns = [c for c in years.columns if c not in ("year", "estimate")]
    have = years.filter(F.col("year") == current).select(key)
    made = years.filter(F.col("year") == current - 1).join(have, key, "left_anti").select(*columns, F.lit(current).alias("year"), F.lit("new-year-placeholder").alias("estimate"))
    return years.unionByName(made)


def taxation(reports: DataFrame, key: str, current: int) -> DataFrame:
    """Shares of income by calendar year and whether the fifty-per-cent rule holds, from monthly reports
    (key, year_end as MMDD, year, month, assets, usgo, muni), one a month.

    usgo and muni are means by assets. q1 to q4 are the shares in the months that end the quarters of the fiscal year that ends in
    the year. A year of twelve reports is complete, others are YTD; `history` says what the rule rests on:
    complete, incomplete (a quarter is not known), current-year (a year in progress after a full one), or
    missing fiscal year. In a full year no known quarter may be low, nor one of the next fiscal year that
    ends in this calendar year. In a year in progress a quarter counts once its month is over, or if there is a
    last year; none may be low and one must be known. Where the current year has no report, a placeholder
    repeats the year before.
    """
    ends = quarter_months(F.col("year_end"))
    quarterly = quarters(reports, key, "usgo")
    share = lambda c: round_half_up(F.sum(F.col(c) * F.col("assets")) / F.sum("assets"), 5).alias(c)
    years = reports.groupBy(key, "year").agg(F.max("year_end").alias("year_end"), F.count("*").alias("months"), share("usgo"), share("muni"))
    qs = ["q1", "q2", "q3", "q4"]
    own = quarterly.withColumnRenamed("fiscal_year", "year")
    after = quarterly.select(key, (F.col("fiscal_year") - 1).alias("year"), *[F.col(q).alias(f"next_{q}") for q in qs])
    before = years.select(key, (F.col("year") + 1).alias("year"), F.col("months").alias("months_before"))
    all_of = years.join(own, [key, "year"], "left").join(after, [key, "year"], "left").join(before, [key, "year"], "left")
    low = lambda c: F.coalesce(c < HALF, F.lit(False))
    either = lambda tests: reduce(lambda a, b: a | b, tests)
    full, last = F.col("months") == 12, F.col("months_before").isNotNull()
    ahead = either([low(F.col(f"next_{q}")) & (ends[3] + 3 * i <= 12) for i, q in enumerate(qs, 1)])
    whole = ~either([low(F.col(q)) for q in qs]) & ~ahead
    seen = [F.when((F.col("months") >= m) | last, F.col(q)) for q, m in zip(qs, ends, strict=True)]
    partly = ~either([low(q) for q in seen]) & F.coalesce(*seen).isNotNull()
    unknown = either([F.col(q).isNull() for q in qs])
    history = F.when(full & unknown, "incomplete").when(full & F.col("year_end").isNull(), "missing fiscal year").when(full, "complete").when(F.coalesce(F.col("months_before") == 12, F.lit(False)), "current-year").otherwise("incomplete")
    judged = all_of.select(key, "year", "months", "usgo", "muni", *qs, F.when(full, whole).otherwise(partly).alias("passes"), history.alias("history"), F.when(full, "complete").otherwise("YTD").alias("estimate"))
    return with_placeholder(judged, key, current)
