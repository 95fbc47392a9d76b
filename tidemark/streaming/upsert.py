"""Incremental upkeep of a best-source history with Structured Streaming.

Each micro-batch of new rates touches some tickers. Their kept raw rows are read again with the new ones,
so that a late row re-enters the whole fold and replaces filler. Raw rows and histories lie in BUCKETS folders each, by a
hash of the ticker, so that files don't grow in number with the tickers; only the buckets that a batch
touches are read and rewritten. Rows without a ticker have no history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import dedupe, series


#: Folders of raw rows, and of histories.
BUCKETS = 64


def rebuilt(raw: DataFrame, oldest: str) -> DataFrame:
    """The filled history of raw rates."""
    best = dedupe.best_source(dedupe.trusted_rates(raw, oldest)).drop("timestamp", "priority", "ord")
    return series.gap_filled(best, ["ticker"], "asOfDate", "source")


def upkeep(batch: DataFrame, raw_path: str, history_path: str, oldest: str, batch_id: int) -> None:
    """Keep the batch's rows, then rewrite the histories of its tickers' buckets. A batch that comes again
    overwrites its own folder, so nothing counts twice."""
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64("ticker"), F.lit(BUCKETS)).cast("int")
    batch.withColumn("bucket", bucket).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(raw_path)
    buckets = [r[0] for r in batch.select(bucket).distinct().collect()]  # BUCKETS at most
    touched = spark.read.parquet(raw_path).filter(F.col("bucket").isin(buckets) & F.col("ticker").isNotNull()).drop("bucket", "batch")
    history = rebuilt(touched, oldest).withColumn("bucket", bucket)
    history.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(history_path)


def start(rates: DataFrame, raw_path: str, history_path: str, checkpoint: str, oldest: str) -> StreamingQuery:
    """Process what is there, in batches, and stop."""
    run = lambda batch, n: upkeep(batch, raw_path, history_path, oldest, n)
    return rates.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Counts and sums of event-time windows, closed once the watermark passes."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def stream_of(spark: SparkSession, path: str, schema) -> DataFrame:
    """What is new in a folder of files; a trigger takes all of it, each file in tasks of its own."""
    return spark.readStream.schema(schema).parquet(path)
