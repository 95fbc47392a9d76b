"""Upserts on streams with keyed state: late rows re-enter their key's fold, and nothing is read again.

kept_rows() keeps the rows of each key in Spark's state store, as an aggregate, and gives, for each key that a micro-batch
changes, all its rows so far. A fold over these arrays, in Spark's functions, is then right whatever order rows come in: the
best source of a day (A1), a slowly changing merge (A7) or the newest row (U2). What the fold gives is
appended to a log; the table is the log's last version of each key, which compacted() reads.

State is kept by key, so keys should be as fine as the fold allows: a ticker and day, not a ticker. Rows are
told apart by `order`, which must be unique within a key; a row that comes again counts once. A query that is stopped and
started again with the same checkpoint goes on where it was; its log has each version once, as a batch that runs again
overwrites its own folder.

Edge cases: null keys form a key of their own; a batch without rows changes nothing; of rows with one order, the first
batch's counts, and within a batch the smallest; they stay in the state, so each one that comes again takes its room there;
further columns are kept in the rows. Columns need an order, as arrays of rows are sorted: maps have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.shared import free_name

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: The log's column of batches, which are its folders.
BATCH = "log_batch"


def kept_rows(stream: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, rows, version): for each key with new rows all its rows so far, in order, and their number."""
    spark = stream.sparkSession
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKS)  # the store that needn't hold its keys in memory
    rest = [order, *[c for c in stream.columns if c not in keys and c != order]]
    came = free_name(stream, "came")
    stamped = stream.withColumn(came, F.current_timestamp())  # the batch's time, the same if it runs again
    kept = stamped.groupBy(*keys).agg(F.collect_list(F.struct(order, came, *rest[1:])).alias("rows")).withColumn("rows", F.array_sort("rows"))
    # each row meets the one before it in a zip: a lambda that looked into the array would sort it again for every row
    before = F.concat(F.array(F.lit(None)), F.slice("rows", 1, F.size("rows") - 1))
    told = F.zip_with("rows", before, lambda x, b: F.struct(x.alias("x"), (b.isNull() | ~x[order].eqNullSafe(b[order])).alias("first")))
    first = F.transform(F.filter(told, lambda t: t["first"]), lambda t: t["x"])
    changed = kept.withColumn("rows", first).filter(F.exists("rows", lambda x: x[came] == F.current_timestamp()))
    return changed.withColumn("rows", F.transform("rows", lambda x: F.struct(*[x[c].alias(c) for c in rest]))).withColumn("version", F.size("rows"))


def start(folded: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to the log, a folder for each batch, and stop."""
    run = lambda batch, n: batch.write.mode("overwrite").parquet(f"{log}/{BATCH}={n}")
    return folded.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


def compacted(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key of a log."""
    rest = [c for c in log.columns if c not in (*keys, "version", BATCH)]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("x")).select(*keys, "x.*")


def changes_of(rows: Column, value: str, day: str) -> Column:
    """The slowly changing merge over rows in order: one stays while the next has the same value or isn't later."""
    keep = lambda a, x: a[value].eqNullSafe(x[value]) | (F.to_date(x[day]) <= F.to_date(a[day]))
    return F.aggregate(F.slice(rows, 2, F.size(rows)), F.get(rows, F.lit(0)), lambda a, x: F.when(keep(a, x), a).otherwise(x))
