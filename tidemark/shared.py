"""What operators share: the shared folder for intermediate tables, free column names, checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side of a join is broadcast; both are counted first.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def row_bytes(df: DataFrame) -> Column:
    """The bytes of a row's values, about."""

    def size(field) -> Column:
        kind, c = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if kind in ("array<string>", "array<binary>"):
            return F.coalesce(F.aggregate(c, F.lit(0), lambda a, x: a + F.coalesce(F.octet_length(x), F.lit(0)) + 16), F.lit(0)) + 16
        return F.coalesce(F.size(c) * 8, F.lit(0)) + 16 if kind.startswith("array") else F.lit(8)

    return sum((size(f) for f in df.schema.fields), F.lit(0)).cast("long")


def is_small(df: DataFrame) -> bool:
    rows, data = df.agg(F.count("*"), F.sum(row_bytes(df))).first()
    return rows <= BROADCAST_ROWS and (data or 0) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if its counted rows and bytes are few; else Catalyst joins it by shuffle."""
    return F.broadcast(df) if is_small(df) else df


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that the session names in spark.checkpoint.dir. Where it is unset,
    a temporary folder serves a local session, as in tests; a cluster has to name one that its executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, kind: str = "table") -> str:
    """The path of a new folder in the shared one."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder: its lineage is cut, columns are read as needed, and Spark deals its
    rows anew in joins, so that it can split hot keys."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, name: str, *others: DataFrame) -> str:
    """name, or one like it that no column of df, or of the others, has."""
    taken = {c.lower() for x in (df, *others) for c in x.columns}
    while name.lower() in taken:
        name += "_"
    return name
