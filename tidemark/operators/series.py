"""Series over days and months: filling, interpolation, running products, as-of rolls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numeric import days_in_month, round_half_up
from tidemark.shared import broadcast_if_small, cut_lineage, free_name, written


def gap_filled(df: DataFrame, keys: list[str], day: str, source: str, label: Column | None = None) -> DataFrame:
    """Days between two rows of a key copy the earlier row, named as filler; one row a day is needed."""
    after, last, each = F.lead(day).over(Window.partitionBy(*keys).orderBy(day)), free_name(df, "last"), free_name(df, "each")
    spans = df.withColumn(last, F.coalesce(F.date_sub(after, 1), F.col(day)))
    days = spans.withColumn(each, F.explode(F.sequence(F.col(day), F.col(last)))).drop(last)
    filler = label if label is not None else F.concat(F.lit("gapFiller ("), F.col(source), F.lit(")"))
    named = F.when(F.col(each) > F.col(day), filler).otherwise(F.col(source))
    return days.withColumn(source, named).withColumn(day, F.col(each)).drop(each)


def interpolated(months: DataFrame, keys: list[str], month: str, value: str, shift: int = 3) -> DataFrame:
    """(keys, day, value) for each day: month m's value, shift months later, rises evenly to the next
    month's; the last month gives its first day only. Missing months are bridged."""
    w = Window.partitionBy(*keys).orderBy(month)
    start, after = F.add_months(F.col(month), shift), F.add_months(F.lead(month).over(w), shift)
    days = F.date_diff(after, start)
    step = round_half_up((F.lead(value).over(w) - F.col(value)) / days, 6)
    spans = months.select(*keys, start.alias("__start"), F.col(value).alias("__value"), F.coalesce(step, F.lit(0.0)).alias("__step"), F.coalesce(days, F.lit(1)).alias("__days"))
    each = spans.withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__days") - 1)))
    return each.select(*keys, F.date_add("__start", F.col("__j")).alias("day"), (F.col("__value") + F.col("__step") * F.col("__j")).alias("value"))


def circular_lead(value: str, keys: list[str], order: str) -> Column:
    """The next value, and the first after the last."""
    w = Window.partitionBy(*keys).orderBy(order)
    return F.coalesce(F.lead(value).over(w), F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def mid_month(df: DataFrame, keys: list[str], month: str, factor: str, year: int) -> DataFrame:
    """The daily change to the next month, round the year, and the value on the 15th."""
    delta = round_half_up((circular_lead(factor, keys, month) - F.col(factor)) / days_in_month(F.lit(year), F.col(month)), 3)
    return df.withColumn("dailyDelta", delta).withColumn("factor15th", round_half_up(F.col(factor) + F.lit(14) * F.col("dailyDelta"), 3))


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, day: str, roll: str = "next") -> DataFrame:
    """left with the nearest day of right at or after its own (next), or at or before it (prev); null where there
    is none, and where a key or the time is null. Times may be dates or timestamps, of any number for one key.

    Only the distinct keys and times of both sides are sorted. Spark deals them to ranges of key and time, so
    that a task sorts its range whatever one key holds. Within a range, days carry over to the rows that
    follow; what a range leaves to the next ones of its key is one row, and these rows (a key and a range each) are
    carried in a small table of their own. left then looks its times up by an equi-join.
    """
    times = left.select(*keys, F.col(at).alias("t"), F.lit(False).alias("is_day"))
    days = right.select(*keys, F.col(day).alias("t"), F.lit(True).alias("is_day"))
    named = [f"k{i}" for i in range(len(keys))]
    both = times.unionByName(days).dropna(subset=[*keys, "t"]).groupBy(*keys, "t").agg(F.max("is_day").alias("is_day"), F.min("is_day").alias("only_day")).toDF(*named, "t", "is_day", "only_day")
    ranged = written(both.repartitionByRange(*named, "t").withColumn("range", F.spark_partition_id()))
    own = F.when(F.col("is_day"), F.col("t"))
    nearest = F.min if roll == "next" else F.max
    towards = (lambda c: F.col(c).desc()) if roll == "next" else (lambda c: F.col(c).asc())
    left_over = cut_lineage(ranged.groupBy("range", *named).agg(nearest(own).alias("left")))
    over = (Window.partitionBy(*named) if named else Window).orderBy(towards("range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = left_over.select("range", *named, F.last("left", ignorenulls=True).over(over).alias("carried"))
    within = Window.partitionBy("range", *named).orderBy(towards("t")).rowsBetween(Window.unboundedPreceding, 0)
    seen = ranged.withColumn("seen", F.last(own, ignorenulls=True).over(within)).filter("not only_day")
    found = seen.join(broadcast_if_small(cut_lineage(carried)), ["range", *named]).select(*named, "t", F.coalesce("seen", "carried").alias("found")).filter("found is not null")
    found = broadcast_if_small(cut_lineage(found)).alias("asof_found")
    same = [F.col(f"asof_left.{k}") == F.col(f"asof_found.{n}") for k, n in zip(keys, named, strict=True)] + [F.col(f"asof_left.{at}") == F.col("asof_found.t")]
    kept = [F.col(f"asof_left.{c}") for c in [*keys, *[c for c in left.columns if c not in keys and c != day]]]
    return left.alias("asof_left").join(found, same, "left").select(*kept, F.col("asof_found.found").alias(day))


def total_return(prices: DataFrame, payments: DataFrame, keys: list[str], start: float = 10_000.0) -> DataFrame:
    """Growth of start with payments reinvested. prices: keys, day, price; payments: keys, day, amount.
    Payments between trading days count on the next one; several on one day add up; the first day's has
    no effect."""
    rolled = asof(payments.withColumnRenamed("day", "paid"), prices.select(*keys, "day"), keys, "paid", "day")
    daily = rolled.filter("day is not null").groupBy(*keys, "day").agg(F.sum("amount").alias("amount"))
    w = Window.partitionBy(*keys).orderBy("day")
    rows = prices.join(daily, [*keys, "day"], "left").withColumn("amount", F.coalesce("amount", F.lit(0.0))).withColumn("__before", F.lag("price").over(w))
    ratio = F.when(F.col("__before") > 0, (F.col("price") + F.col("amount")) / F.col("__before")).otherwise(F.lit(1.0))
    growth = F.product("__ratio").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__ratio", ratio).select(*keys, "day", round_half_up(F.col("price"), 4).alias("price"), round_half_up(F.col("amount"), 4).alias("distribution"), round_half_up(growth * start, 2).alias("growth"))


def trailing_months(df: DataFrame, month: str, years: int) -> DataFrame:
    """The last so many years of months, of all of df: the last month is one aggregate row."""
    last = df.agg(F.max(month).alias("__last"))
    return df.join(F.broadcast(last), F.col(month) > F.add_months("__last", -12 * years)).drop("__last")


def last_full_year(df: DataFrame, month: str) -> DataFrame:
    """One row: the last year that has a December."""
    return df.agg(F.max(F.when(F.month(month) == 12, F.year(month))).alias("last_full_year"))


def shifted_month(month: Column, by: int = 3) -> Column:
    return ((month + (by - 1)) % 12) + 1
