"""Comparing tables and runs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def without_ignored(value: Column, kind: DataType, ignored: tuple[str, ...]) -> Column:
    """A value without the ignored fields, in structs and arrays at every level; nulls stay null."""
    if isinstance(kind, StructType):
        kept = [f for f in kind.fields if f.name not in ignored]
        parts = [without_ignored(value.getField(f.name), f.dataType, ignored).alias(f.name) for f in kept]
        return F.when(value.isNotNull(), F.struct(*parts) if parts else F.struct(F.lit(1).alias("_")))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: without_ignored(x, kind.elementType, ignored))
    return value


def _compared(df: DataFrame, columns: list[str], ignored: tuple[str, ...]) -> list[Column]:
    return [without_ignored(F.col(c), df.schema[c].dataType, ignored).alias(c) for c in columns]


def keyed_diff(old: DataFrame, new: DataFrame, keys: list[str], ignored: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """(keys, status, changed): added, removed and changed rows with the names of changed columns. Each
    side has one row for a key. Ignored fields don't count at any level. A column that one side lacks is null there."""
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys and c not in ignored]
    filled = lambda df, other: df.select("*", *[F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns if c not in df.columns])
    old, new = filled(old, new), filled(new, old)
    side = lambda df, p: df.select(*keys, F.struct(*_compared(df, columns, ignored)).alias(p)) if columns else df.select(*keys, F.lit(1).alias(p))
    both = side(old, "o").join(side(new, "n"), keys, "full_outer")
    differ = F.array_compact(F.array(*[F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in columns]))
    status = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.size(differ) > 0, "changed")
    return both.select(*keys, status.alias("status"), F.when(F.col("o").isNotNull() & F.col("n").isNotNull(), F.array_join(differ, ",")).otherwise(F.lit("")).alias("changed")).filter("status is not null")


def canonical(columns: list[str]) -> Column:
    """A row as JSON with its columns in order, for comparing and hashing."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def equal_but(a: DataFrame, b: DataFrame, ignored: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """One row: how many rows only a and only b have, as often as they occur, and whether none."""
    columns = sorted(set(a.columns) - set(ignored))
    if columns != sorted(set(b.columns) - set(ignored)):
        raise ValueError("the tables have different columns")
    signed = lambda df, n: df.select(_compared(df, columns, ignored)).select(F.md5(canonical(columns)).alias("row"), F.lit(n).alias("n"))
    rest = signed(a, 1).union(signed(b, -1)).groupBy("row").agg(F.sum("n").alias("n"))
    over = lambda s: F.coalesce(F.sum(F.greatest(s * F.col("n"), F.lit(0))), F.lit(0))
    return rest.agg(over(1).alias("only_first"), over(-1).alias("only_second")).withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def write_if_changed(new: DataFrame, path: str, ignored: tuple[str, ...] = ("timestamp",)) -> bool:
    """Publish new as Parquet at path unless what is there is equal but for ignored columns."""
    spark = new.sparkSession
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # what can't be read is not overwritten
            raise
        new.write.mode("overwrite").parquet(path)
        return True
    if sorted(old.columns) == sorted(new.columns) and equal_but(old, new, ignored).first()["equal"]:
        return False
    new.write.mode("overwrite").parquet(path)
    return True


def changed_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, status): files (name, bytes) that were added, removed or differ in a byte (D3). Bytes are compared by their
    SHA-256, made where they are read, so that they don't travel."""
    side = lambda df, s: df.select("name", F.sha2("bytes", 256).alias(s))
    both = side(old, "o").join(side(new, "n"), "name", "full_outer")
    status = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed")
    return both.select("name", status.alias("status")).filter("status is not null")
