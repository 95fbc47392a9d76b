"""Which of several rows of a key counts: ordered folds, winners, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.dates import is_weekend, is_year_end
from tidemark.shared import free_name

# Parts of source names in the order of the tests, with their priorities; others have 2.
PRIORITIES = (
    ("gapfiller", 1), ("vanguard", 10), ("fido14", 10), ("fidelity", 10), ("schwab", 10), ("ally", 10),
    ("blackrock", 9), ("ssga", 9), ("alphaarchitect", 8), ("edgar", 5), ("deep", 4), ("cnbc", 4),
    ("moneymarket.fun", 4), ("mm.fun", 4), ("nasdaq", 2), ("yieldfinder", 3), ("yieldmm", 2),
)
TRUSTED = 5
YIELDS = ("oneDayYield", "sevenDayYield", "thirtyDayYield")


def source_priority(source: Column) -> Column:
    """First part of the list that the lower-cased name contains. The name is made once: filters that Catalyst
    pushes below its projection would otherwise make it again for every part."""

    def found(name: Column) -> Column:
        out = F
        for part, priority in PRIORITIES:
            out = out.when(name.contains(part), priority)
        return out.otherwise(2)

    return F.get(F.transform(F.array(F.lower(source)), found), F.lit(0))


def trusted_rates(rates: DataFrame, oldest: str, dropped: tuple[str, ...] = ()) -> DataFrame:
    """Rates with their priority: without earlier filler, days before oldest, untrusted weekends and year
    ends, zero yields (a missing one stays) and dropped tickers."""
    day, priority = F.col("asOfDate"), F.col("priority")
    return (
        rates.withColumn("priority", source_priority(F.col("source")))
        .filter((priority > 1) & (day >= F.lit(oldest).cast("date")))
        .filter((priority >= TRUSTED) | ~(is_weekend(day) | is_year_end(day)))
        .filter(F.col("sevenDayYield").isNull() | (F.col("sevenDayYield") != 0))
        .filter(~F.col("ticker").isin(*dropped) if dropped else F.lit(True))
    )


def best_source(rates: DataFrame) -> DataFrame:
    """One row for each (ticker, asOfDate): a left fold in the order of ord. A row replaces the last winner
    if its source is better, or as good and it has a yield that the winner lacks, more yields, or is
    later. That is not transitive, so no ordering of the rows gives the same winners."""
    names = [c for c in rates.columns if c not in ("ticker", "asOfDate")]
    row = F.struct("ord", *[c for c in names if c != "ord"])
    folded = rates.groupBy("ticker", "asOfDate").agg(F.collect_list(row).alias("rows")).withColumn("w", best_of(F.col("rows")))
    return folded.select("ticker", "asOfDate", *[F.col(f"w.{c}").alias(c) for c in names])


def best_of(rows: Column) -> Column:
    """The winner of an array of rows of one ticker and day, whose first field is ord."""
    has = lambda x, c: x[c].isNotNull()
    count = lambda x: sum((F.when(has(x, c), 1).otherwise(0) for c in YIELDS), F.lit(0))
    at = lambda x: F.coalesce(F.unix_micros(x["timestamp"].cast("timestamp")), F.lit(0))

    def winner(a: Column, x: Column) -> Column:
        better = (has(x, "oneDayYield") & ~has(a, "oneDayYield")) | (has(x, "thirtyDayYield") & ~has(a, "thirtyDayYield")) | (count(x) > count(a)) | (at(x) > at(a))
        return F.when((x["priority"] > a["priority"]) | ((x["priority"] == a["priority"]) & better), x).otherwise(a)

    ordered = F.array_sort(rows)
    return F.aggregate(F.slice(ordered, 2, F.size(ordered)), F.get(ordered, F.lit(0)), winner)


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in that order, which must be total."""
    rank, at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), free_name(df, "rank")
    return df.withColumn(at, rank).filter(F.col(at) == 1).drop(at)


def widest_newest(df: DataFrame, keys: list[str], counted: list[str]) -> DataFrame:
    """The row with most values; of those the latest; of those the first."""
    filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in counted), F.lit(0))
    return first_by(df, keys, filled.desc(), F.col("timestamp").desc_nulls_last(), F.col("ord").asc())


def latest(df: DataFrame, key: str, day: str) -> DataFrame:
    """Each key's last row; one row a day is taken for granted."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(day)).alias("x")).select(key, "x.*")


def unique_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first of each key; put new rows first and they win."""
    return first_by(df, keys, *[F.col(c).asc() for c in order])


def unique_with_fallback(df: DataFrame, key: str, fallback: str, order: str) -> DataFrame:
    """The first of each key, or of its fallback where empty; rows with neither are dropped."""
    named, at = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")), free_name(df, "key")
    kept = df.withColumn(at, F.coalesce(named(key), named(fallback))).filter(F.col(at).isNotNull())
    return first_by(kept, [at], F.col(order).asc()).drop(at)


def newest_amendment(df: DataFrame, keys: list[str], filed: str, order: str) -> DataFrame:
    return first_by(df, keys, F.col(filed).desc_nulls_last(), F.col(order).asc())


def merged_changes(old: DataFrame, new: DataFrame, key: str, value: str, day: str) -> DataFrame:
    """Slowly changing rows: the old one stays while its value is the same or the new one isn't later;
    unknown keys are added. Each side has one row for a key."""
    columns = [c for c in old.columns if c != key]
    side = lambda df, p: df.select(key, F.struct(*columns).alias(p))
    both = side(old, "o").join(side(new, "n"), key, "full_outer")
    keep = F.col("n").isNull() | (F.col("o").isNotNull() & (F.col(f"o.{value}").eqNullSafe(F.col(f"n.{value}")) | (F.to_date(f"n.{day}") <= F.to_date(f"o.{day}"))))
    return both.withColumn("x", F.when(keep, F.col("o")).otherwise(F.col("n"))).select(key, "x.*")
