"""Published tables that change as a whole: versions of partitions, and a list of what counts that is switched last.

A table lies in versions/version=<v>/<key>=<k>. What counts is the last generation of its list: a row for each key with the version
that holds it. publish() writes the touched keys under a new version first and appends one file with the next generation
after that, so readers see the old table or the new one, and a job that fails in between changes nothing that
counts. Earlier generations stay readable until vacuum() drops them. One writer at a time is taken for granted.

Edge cases: a null key is a key of its own; publishing no rows and no dropped keys adds an equal generation; a table
that was never published can't be read; the key's column comes last when read, as Spark's partition columns do.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import cut_lineage


def _list(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/list")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def generation(spark: SparkSession, path: str, back: int = 0) -> tuple[int, DataFrame]:
    """The number of the last generation, or of one before it, and its (key, version)."""
    rows = _list(spark, path)
    if rows is None:
        raise ValueError(f"nothing is published at {path}")
    n = rows.agg(F.max("generation")).first()[0] - back
    return n, rows.filter((F.col("generation") == n) & F.col("version").isNotNull()).select("key", "version")


def publish(df: DataFrame, path: str, key: str, dropped: list | None = None) -> int:
    """Replace the keys of df, and drop others, in the table at path. The new generation's number."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version", key).parquet(f"{path}/versions")
    own = spark.read.parquet(f"{path}/versions").filter(F.col("version") == version).select(F.col(key).cast("string").alias("key")).distinct() if _has_rows(df) else df.select(F.col(key).cast("string").alias("key")).limit(0)
    touched = cut_lineage(own)
    n, kept = 0, None
    if _list(spark, path) is not None:
        n, before = generation(spark, path)
        gone = touched.unionByName(spark.createDataFrame([(str(k),) for k in dropped or []], "key string"))
        kept = before.alias("b").join(gone.distinct().alias("g"), F.col("b.key").eqNullSafe(F.col("g.key")), "left_anti")
    rows = touched.withColumn("version", F.lit(version))
    rows = rows.unionByName(kept) if kept is not None else rows
    mark = spark.createDataFrame([(None, None)], "key string, version string")  # so that an empty table is a generation too
    # keys are few against rows; one file, so that a generation is there whole or not at all
    rows.unionByName(mark).withColumn("generation", F.lit(n + 1)).coalesce(1).write.mode("append").parquet(f"{path}/list")
    return n + 1


def _has_rows(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def published(spark: SparkSession, path: str, key: str, back: int = 0) -> DataFrame:
    """The table as it counts now, or so many generations ago. Only the versions that count are read."""
    _, rows = generation(spark, path, back)
    rows = rows.select(F.col("key").alias("listed_key"), F.col("version").alias("listed_version"))
    data = spark.read.parquet(f"{path}/versions")
    same = (F.col("version") == F.col("listed_version")) & F.col(key).cast("string").eqNullSafe(F.col("listed_key"))
    return data.join(rows, same, "left_semi").drop("version")
