"""Incremental upkeep as queries: batches through foreachBatch and through keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import dedupe
from tidemark.plans.catalog import load, query
from tidemark.plans.rates import _YIELDS, FOLD, OLDEST, RATES, rates
from tidemark.shared import new_folder
from tidemark.streaming import state, upsert


@query(
    "incremental_upsert",
    f"""with {RATES}, {FOLD}, spans as (select *, coalesce(lead("asOfDate") over (partition by ticker order by "asOfDate") - 1, "asOfDate") as last from history),
days as (select *, unnest(generate_series("asOfDate"::timestamp, last::timestamp, interval 1 day))::date as day from spans)
select ticker, day as "asOfDate", case when day > "asOfDate" then 'gapFiller (' || source || ')' else source end as source, {_YIELDS} from days""",
)
def incremental_upsert(spark, sf_dir):
    rows, top = rates(spark, sf_dir).filter("ticker <> '7'"), new_folder(spark, "history")
    landing = f"{top}/landing"
    for late in (1, 0):  # later ids land first, so that the second batch is late data
        rows.filter((F.col("ord") % 3 == 0) if late else (F.col("ord") % 3 != 0)).write.mode("append").parquet(landing)
        upsert.start(upsert.stream_of(spark, landing, rows.schema), f"{top}/raw", f"{top}/history", f"{top}/checkpoint", OLDEST).awaitTermination()
    return spark.read.parquet(f"{top}/history").select(F.col("ticker").cast("string").alias("ticker"), "asOfDate", "source", *dedupe.YIELDS)


def _kept(spark, rows, keys, order, fold):
    """What a fold over state gives for rows that land in two batches, the later ones first, with a restart between."""
    top = new_folder(spark, "state")
    for late in (False, True):
        rows.filter((F.col(order) % 3 == 0) if late else (F.col(order) % 3 != 0)).write.mode("append").parquet(f"{top}/landing")
        stream = state.kept_rows(upsert.stream_of(spark, f"{top}/landing", rows.schema), keys, order)
        state.start(stream.select(*keys, "version", fold(F.col("rows")).alias("kept")), f"{top}/log", f"{top}/checkpoint").awaitTermination()
    return state.compacted(spark.read.parquet(f"{top}/log"), keys).select(*keys, "kept.*")


@query("stateful_best_source", f'with {RATES}, {FOLD} select ticker, "asOfDate", source, {_YIELDS}, ord from history')
def stateful_best_source(spark, sf_dir):
    trusted = dedupe.trusted_rates(rates(spark, sf_dir), OLDEST, ("7",))
    return _kept(spark, trusted, ["ticker", "asOfDate"], "ord", dedupe.best_of).select("ticker", "asOfDate", "source", *dedupe.YIELDS, "ord")


@query(
    "stateful_changes",
    """select user_id, w.value as value, w.day as day from (select user_id, list_reduce(list({'value': event_type, 'day': ts::date} order by event_id), lambda a, x: case when a.value = x.value or x.day <= a.day then a else x end) as w from events group by 1)""",
)
def stateful_changes(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("value"), F.to_date("ts").alias("day"))
    return _kept(spark, rows, ["user_id"], "event_id", lambda r: state.changes_of(r, "value", "day")).drop("event_id")
