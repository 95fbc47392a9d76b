"""Queries that write files from a given table and read them back: landed raw files, XML, CSV layouts, published tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.catalog import load, query
from tidemark.shared import new_folder
from tidemark.sources import files, landed, published

_PART = "<part><key>{k}</key><size>{s}</size><price>{p}</price></part>"


@query(
    "landed_payloads",
    """select event_type as name, cast(ts as date) as landed, count(*) as rows, cast(sum(cast(value as decimal(18, 4))) as double) as total from events
where cast(ts as date) >= date '2024-01-10' and event_type in ('click', 'view', 'error') group by all""",
)
def landed_payloads(spark, sf_dir):
    top, e = new_folder(spark, "landed"), load(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "value")).alias("value")
    e.select(line, F.to_date("ts").alias("landed"), F.col("event_type").alias("name")).repartition("landed", "name").write.partitionBy("landed", "name").text(top)
    raw = landed.landed_files(spark, top).filter((F.col("landed") >= F.lit("2024-01-10").cast("date")) & F.col("name").isin("click", "view", "error"))
    rows = raw.select("landed", "name", F.explode(F.split(F.rtrim(F.decode("bytes", "UTF-8")), "\\n")).alias("line"))
    x = F.from_json("line", "event_id long, value decimal(18,4)")
    return rows.filter("line <> ''").groupBy("name", "landed").agg(F.count("*").alias("rows"), F.sum(x["value"]).cast("double").alias("total"))


def _part_xml():
    size = F.when(F.col("p_size") % 11 == 0, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    body = F.concat(F.lit("<part><key>"), F.col("p_partkey").cast("string"), F.lit("</key><size>"), size, F.lit("</size>"), F.when(F.col("p_size") % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("<price>"), F.format_string("%.2f", "p_retailprice"), F.lit("</price>"))), F.when(F.col("p_size") % 7 == 0, F.lit("<broken></part>")).otherwise(F.lit("</part>")))
    return F.when(F.col("p_size") % 17 == 0, F.lit(" ")).otherwise(body)


_FAULT = "case when p_size % 17 = 0 then 'empty' when p_size % 7 = 0 or p_size % 11 = 0 then 'malformed' when p_size % 13 = 0 then 'missing price' end"


@query("xml_validation", f"select p_brand, {_FAULT} as fault, count(*) as rows from part group by all")
def xml_validation(spark, sf_dir):
    texts = load(spark, sf_dir, "part").select("p_brand", _part_xml().alias("xml"))
    return files.validation_report(files.validated_xml(texts, "xml", "key long, size int, price double", ("key", "size", "price")), "p_brand")


@query("xml_good_rows", "select p_partkey as key, p_size as size, cast(printf('%.2f', p_retailprice) as double) as price from part where p_size % 7 <> 0 and p_size % 11 <> 0 and p_size % 13 <> 0 and p_size % 17 <> 0")
def xml_good_rows(spark, sf_dir):
    top = new_folder(spark, "xml")
    load(spark, sf_dir, "part").select(_part_xml().alias("value")).write.text(top)
    return files.xml_rows(spark, top, "part", "key long, size int, price double").filter("malformed is null and price is not null").select("key", "size", "price")


@query("csv_named", "select '2024-05-01' as day, printf('%.2f', p_retailprice) as price, p_name as title, null::varchar as note from part")
def csv_named(spark, sf_dir):
    top = new_folder(spark, "csv")
    load(spark, sf_dir, "part").select(F.col("p_partkey").alias("Id"), F.col("p_name").alias("Full Name"), F.format_string("%.2f", "p_retailprice").alias("Unit Price")).write.option("header", True).csv(top, quoteAll=True, escape='"')
    named = files.csv_named(spark, top, {"price": "Unit Price", "title": "Full Name", "note": "Remarks"}, 4)
    return files.with_constant(named, "day", "2024-05-01")


@query(
    "published_changes",
    """select n_nationkey, 'second' as batch, count(c_custkey) as n from nation join customer on c_nationkey = n_nationkey and c_mktsegment = 'BUILDING' where n_nationkey % 2 = 0 group by 1
union all select n_nationkey, 'first', count(c_custkey) from nation join customer on c_nationkey = n_nationkey where n_nationkey % 2 = 1 and n_nationkey <> 3 group by 1""",
)
def published_changes(spark, sf_dir):
    top, c = new_folder(spark, "published"), load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    published.publish(c.withColumn("batch", F.lit("first")), top, "c_nationkey")
    even = c.filter("c_nationkey % 2 = 0")
    gone = [r[0] for r in even.select("c_nationkey").distinct().collect()] + [3]  # nations are few
    published.publish(even.filter("c_mktsegment = 'BUILDING'").withColumn("batch", F.lit("second")), top, "c_nationkey", gone)
    now = published.published(spark, top, "c_nationkey")
    return now.groupBy(F.col("c_nationkey").cast("long").alias("n_nationkey"), "batch").agg(F.count("c_custkey").alias("n"))
