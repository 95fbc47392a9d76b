"""Statistics: trimmed means, upper medians, seasonal factors, rolling-origin back-tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numeric import round_half_up, round_whole


def valuation(df: DataFrame, keys: list[str], value: str, where: Column, prefix: str) -> DataFrame:
    """Count, total, whole mean, least, most and upper median of the rows that pass; zeros without any."""
    kept = df.withColumn("__v", F.when(where, F.col(value))).withColumn("__minus", -F.col("__v"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    total = F.sum("__v")
    return kept.groupBy(*keys).agg(
        F.count("__v").alias(f"{prefix}_count"),
        zero(round_half_up(total, 2)).alias(f"{prefix}_total"),
        zero(round_whole(F.avg("__v"))).cast("double").alias(f"{prefix}_avg"),
        zero(F.min("__v")).alias(f"{prefix}_min"),
        zero(F.max("__v")).alias(f"{prefix}_max"),
        # the lower median of the negated values is the upper one of the values
        zero(-F.expr("percentile_disc(0.5) within group (order by __minus)")).alias(f"{prefix}_median"),
    )


def trimmed_mean(value: str) -> Column:
    """Mean without one least and one greatest value, if there are more than two."""
    v, n = F.col(value), F.count(value)
    return F.when(n > 2, (F.sum(v) - F.min(v) - F.max(v)) / (n - 2)).otherwise(F.avg(v))


def monthly_means(df: DataFrame, keys: list[str], month: str, value: str, trim: bool = False, digits: int = 4) -> DataFrame:
    """Seasonal factors: the mean of each calendar month over years, with its dates and tested entries."""
    mean = trimmed_mean(value) if trim else F.avg(value)
    n = F.count(value)
    tested = F.when(n > 2, n - 2).otherwise(n) if trim else n
    return df.groupBy(*keys, month).agg(round_half_up(mean, digits).alias("factor"), F.min("day").alias("startDate"), F.max("day").alias("endDate"), tested.alias("entriesTested"))


def level_set(df: DataFrame, keys: list[str], value: str, total: float = 1200.0) -> DataFrame:
    """Values scaled so that each key's add up to total, at three digits."""
    w = Window.partitionBy(*keys)
    return df.withColumn(value, round_half_up(F.col(value) * (F.lit(total) / F.sum(value).over(w)), 3))


def backtest(factors: DataFrame, years: int, trim: bool = False) -> DataFrame:
    """(target, month, predicted, actual, error) for each year that has so many years before it: the
    profile is the mean (or trimmed, levelled mean) of those years' factors. factors: year, month, factor.
    Each factor meets only the targets it is a source of, by an equi-join on the exploded target."""
    targets = factors.select(F.col("year").alias("target")).distinct()
    first = factors.agg(F.min("year").alias("first"))
    targets = targets.join(F.broadcast(first), F.col("target") >= F.col("first") + years).drop("first")
    sources = factors.withColumn("target", F.explode(F.sequence(F.col("year") + 1, F.col("year") + years))).join(targets, "target", "left_semi")
    mean = trimmed_mean("factor") if trim else F.avg("factor")
    profile = sources.groupBy("target", "month").agg(mean.alias("predicted"))
    if trim:
        profile = level_set(profile, ["target"], "predicted")
    actual = factors.select(F.col("year").alias("target"), "month", F.col("factor").alias("actual"))
    return profile.join(actual, ["target", "month"]).withColumn("error", F.col("predicted") - F.col("actual"))


def error_metrics(errors: DataFrame, keys: list[str], recent_from: int) -> DataFrame:
    """MAE, RMSE, bias and shape MAE; recent targets weigh twice."""
    w = Window.partitionBy(*keys, "target")
    shape = F.col("predicted") / F.avg("predicted").over(w) - F.col("actual") / F.avg("actual").over(w)
    rows = errors.withColumn("shape", F.abs(shape)).withColumn("weight", F.when(F.col("target") >= recent_from, 2).otherwise(1))
    weighed = lambda x: F.sum(x * F.col("weight")) / F.sum("weight")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("monthsCompared"),
        F.avg(F.abs("error")).alias("overallMae"),
        weighed(F.abs("error")).alias("weightedMae"),
        F.sqrt(F.avg(F.pow("error", 2))).alias("overallRmse"),
        F.avg("error").alias("meanBias"),
        F.avg("shape").alias("overallShapeMae"),
        weighed(F.col("shape")).alias("weightedShapeMae"),
    )


def forecast_errors(factors: DataFrame, years: int, origins: list[int], horizons: list[int]) -> DataFrame:
    """(origin, horizon, shape_mae): the profile of the years up to each origin against each later year."""
    spark = factors.sparkSession
    starts = spark.createDataFrame([(o,) for o in origins], "origin int")
    sources = factors.withColumn("origin", F.explode(F.sequence(F.col("year"), F.col("year") + years - 1))).join(F.broadcast(starts), "origin")
    profile = sources.groupBy("origin", "month").agg(F.avg("factor").alias("predicted"))
    ahead = profile.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).withColumn("year", F.col("origin") + F.col("horizon"))
    both = ahead.join(factors.withColumnRenamed("factor", "actual"), ["year", "month"])
    w = Window.partitionBy("origin", "horizon")
    shape = F.abs(F.col("predicted") / F.avg("predicted").over(w) - F.col("actual") / F.avg("actual").over(w))
    return both.withColumn("shape", shape).groupBy("origin", "horizon").agg(F.avg("shape").alias("shape_mae"))


def conditional_counts(df: DataFrame, keys: list[str], tests: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in tests.items()])


def ranked(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """Rows with the metric, worst first."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.asc(tie))


def best(df: DataFrame, metric: str, tie: str) -> DataFrame:
    return df.filter(F.col(metric).isNotNull()).orderBy(F.asc(metric), F.asc(tie)).limit(1)
