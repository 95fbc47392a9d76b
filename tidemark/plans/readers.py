"""Queries that take a whole table through a reader, a parser or a writer and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, numeric, text
from tidemark.operators import composites, diff, lookups, rows
from tidemark.plans.catalog import load, query
from tidemark.plans.texts import _sql_rules
from tidemark.shared import new_folder
from tidemark.sources import files, html, landed


@query(
    "csv_round_trip",
    """select o_orderkey, 'a "' || o_orderpriority || '", ' || chr(10) || o_orderstatus || ' end' as note, o_orderstatus || ';' || o_orderpriority as tags from orders""",
)
def csv_round_trip(spark, sf_dir):
    top, o = new_folder(spark, "csv"), load(spark, sf_dir, "orders")
    note = F.concat(F.lit('a "'), "o_orderpriority", F.lit('", \n'), "o_orderstatus", F.lit(" end"))
    files.write_csv(o.select("o_orderkey", note.alias("note"), F.array("o_orderstatus", "o_orderpriority").alias("tags")), top)
    return files.csv_rows(spark, top, "o_orderkey long, note string, tags string")


@query("csv_unquoted", """select l_orderkey, '"' || l_returnflag as flag, l_linenumber from lineitem""")
def csv_unquoted(spark, sf_dir):
    top = new_folder(spark, "csv")
    lines = load(spark, sf_dir, "lineitem").select(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.concat(F.lit('"'), "l_returnflag"), F.col("l_linenumber").cast("string")).alias("value"))
    lines.write.text(top)
    return files.csv_rows(spark, top, "l_orderkey long, flag string, l_linenumber int", header=False, quoted=False)


@query("line_lists", "select p_name as line, count(*) as n from part where p_size % 3 <> 0 group by 1")
def line_lists(spark, sf_dir):
    top = new_folder(spark, "lines")
    load(spark, sf_dir, "part").select(F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("value")).write.text(top)
    return files.line_list(spark, top).groupBy("line").agg(F.count("*").alias("n"))


@query("json_published", "select p_partkey, case when p_size % 2 = 0 then p_name end as p_name, p_retailprice from part")
def json_published(spark, sf_dir):
    top = new_folder(spark, "json")
    files.write_json(load(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("p_name"), "p_retailprice"), top)
    return spark.read.schema("p_partkey long, p_name string, p_retailprice double").json(top)


@query(
    "daily_snapshots",
    """select o_custkey, o_orderkey, o_orderdate::date as day, case when o_orderstatus = 'F' then 'again' else 'first' end as written from orders
where o_orderstatus = 'F' or o_orderdate::date not in (select o_orderdate::date from orders where o_orderstatus = 'F')""",
)
def daily_snapshots(spark, sf_dir):
    top, o = new_folder(spark, "days"), load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    month = F.trunc("day", "MM").alias("month")
    again = o.filter("o_orderstatus = 'F'")
    first = o.join(again.select("day").distinct(), "day", "left_anti")
    files.write_by(first.select("o_custkey", "o_orderkey", "day", F.lit("first").alias("written"), F.lit(0).alias("part"), month), top, "part", "month")
    files.write_by(again.select("o_custkey", "o_orderkey", "day", F.lit("twice").alias("written"), F.lit(1).alias("part"), month), top, "part", "month")
    files.write_by(again.select("o_custkey", "o_orderkey", "day", F.lit("again").alias("written"), F.lit(1).alias("part"), month), top, "part", "month")
    return spark.read.parquet(top).select("o_custkey", "o_orderkey", "day", "written")


@query(
    "archived_runs",
    "select 'latest' as name, '003' as run, count(*) as rows from orders where o_orderstatus = 'P' union all select 'previous', '002', count(*) from orders where o_orderstatus = 'O'",
)
def archived_runs(spark, sf_dir):
    top, o = new_folder(spark, "runs"), load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for run, status in (("001", "F"), ("002", "O"), ("003", "P")):
        pointers = files.write_run(o.filter(F.col("o_orderstatus") == status), top, run)
    kept = spark.read.schema("o_orderkey long, o_orderstatus string, run string").parquet(f"{top}/runs")
    counts = kept.groupBy("run").agg(F.count("*").alias("rows"))
    return pointers.join(counts, "run", "left").select("name", "run", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("list_batches", "select c_custkey, ((row_number() over (order by c_custkey) - 1) // 10)::int as batch from customer")
def list_batches(spark, sf_dir):
    return files.batches_of(load(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@query("guarded_rows", "select o_orderstatus, count(*) as n from orders group by 1")
def guarded_rows(spark, sf_dir):
    return files.at_least(load(spark, sf_dir, "orders"), 100).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("purged_keys", "select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey where n_name not in ('NATION_1', 'NATION_2') group by 1")
def purged_keys(spark, sf_dir):
    named = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return files.without_keys(named, "n_name", ["NATION_1", "NATION_2"]).groupBy("n_name").agg(F.count("*").alias("n"))


@query(
    "callback_payloads",
    "select p_partkey, case when p_size % 2 = 0 then 1 else 2 end as n, p_size as first, case when p_size % 2 = 1 then p_size + 1 end as second from part",
)
def callback_payloads(spark, sf_dir):
    one = F.format_string('{"x": %d}', "p_size")
    both = F.when(F.col("p_size") % 2 == 0, one).otherwise(F.concat(F.lit("["), one, F.lit(", "), F.format_string('{"x": %d}', F.col("p_size") + 1), F.lit("]")))
    got = load(spark, sf_dir, "part").select("p_partkey", files.array_of(files.unwrapped(F.concat(F.lit("angular.cb_1("), both, F.lit(");"))), "struct<x:int>").alias("a"))
    return got.select("p_partkey", F.size("a").alias("n"), F.get("a", 0)["x"].alias("first"), F.get("a", 1)["x"].alias("second"))


@query("workbook_cells", "select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag)::int as row, l_returnflag as flag, l_linenumber::varchar as line from lineitem")
def workbook_cells(spark, sf_dir):
    row = F.concat(F.lit('<Row ss:Height="12"><Cell><Data ss:Type="String">'), "l_returnflag", F.lit('</Data></Cell>\n<Cell><Data ss:Type="Number">'), F.col("l_linenumber").cast("string"), F.lit("</Data></Cell></Row>"))
    books = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", row.alias("row")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))).alias("r"))
    sheet = F.concat(F.lit("<Worksheet><Table>"), F.array_join(F.col("r.row"), "\n"), F.lit("</Table></Worksheet>"))
    rows = books.select("l_orderkey", F.posexplode(files.workbook_rows(sheet)).alias("at", "c"))
    return rows.select("l_orderkey", (F.col("at") + 1).alias("row"), F.get("c", 0).alias("flag"), F.get("c", 1).alias("line"))


def _order_pages(spark, sf_dir):
    row = F.concat(F.lit("<tr><td>"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("<td> "), "l_returnflag", F.lit("&amp;</td><td>"), F.col("l_linenumber").cast("string"), F.lit("</tr>"))
    pages = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", row.alias("row")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))).alias("r"))
    page = F.concat(F.lit("<table><tr><td>Other</table><table><tr><th>Ship Date*<th>Dividend flag<th>Line</tr>"), F.array_join(F.col("r.row"), "\n"), F.lit("</table>"))
    return pages.select("l_orderkey", page.alias("html"))


@query("html_records", "select l_orderkey, l_shipdate::date::varchar as shipped, l_returnflag || '&' as flag, l_linenumber::varchar as line from lineitem")
def html_records(spark, sf_dir):
    pages = html.table_rows(_order_pages(spark, sf_dir), "l_orderkey", "html")
    found = pages.select("l_orderkey", F.explode(html.row_records(F.col("rows"), "dividend")).alias("record"))
    return found.select("l_orderkey", F.col("record.shipdate").alias("shipped"), F.col("record.dividendflag").alias("flag"), F.col("record.line").alias("line"))


@query(
    "grid_values",
    """with f as (select l_orderkey, l_shipdate::date::varchar as d, l_returnflag || '&' as flag, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_shipdate, l_returnflag) as n from lineitem),
k as (select distinct l_orderkey from lineitem) select k.l_orderkey, g.l_linenumber::varchar as last_cell, h.flag as after_label from k left join (select l_orderkey, min_by(l_linenumber, n) as l_linenumber from f where d like '%-03-%' group by 1) g using (l_orderkey)
left join f h on h.l_orderkey = k.l_orderkey and h.n = 1""",
)
def grid_values(spark, sf_dir):
    pages = html.table_rows(_order_pages(spark, sf_dir), "l_orderkey", "html").filter(F.size("rows") > 0)
    return pages.select("l_orderkey", html.row_value(F.col("rows"), "-03-").alias("last_cell"), html.row_cell_after(F.col("rows"), "Line", 2).alias("after_label"))


@query("marked_blocks", "select p_partkey, ' ' || p_name || ' END ' || p_brand || ' ' as block from part")
def marked_blocks(spark, sf_dir):
    page = F.concat(F.lit("head BEGIN "), "p_name", F.lit(" END "), "p_brand", F.lit(" END tail"))
    return load(spark, sf_dir, "part").select("p_partkey", html.between(page, "BEGIN", "END").alias("block"))


_FUND = "'u.s. ' || s_name || '® money market etf - growth investor shares fund™'"


@query(
    "text_forms",
    f"""select s_suppkey, {_sql_rules(f"array_to_string([upper(w[1]) || lower(substr(w, 2)) for w in string_split(lower({_FUND}), ' ')], ' ')", text.FUND_RULES)} as fund,
array_to_string([trim(x) for x in string_split('  a b ;; ' || s_name || ';c;', ';') if trim(x) <> ''], '|') as names, ' ' || s_name || ' > x' as bare, (timestamp '1970-01-01 00:00:00' + to_seconds(86400 * s_suppkey + 30)) as at,
(s_nationkey + 1) || '-7-' || s_suppkey || '.02' as parcel, case when s_suppkey % 2 = 0 then '5-7-1.2' end as checked from supplier""",
)
def text_forms(spark, sf_dir):
    raw = F.concat(F.lit("u.s. "), "s_name", F.lit("® money market etf - growth investor shares fund™"))
    names = F.array_join(text.names_list(F.concat(F.lit("  a b ;; "), "s_name", F.lit(";c;"))), "|")
    bare = text.without_tags(F.concat(F.lit("<b class='x'> "), "s_name", F.lit(" > x</b><br/>")))
    seconds = F.lit(86400).cast("long") * F.col("s_suppkey") + 30
    at = dates.from_epoch(F.when(F.col("s_suppkey") % 2 == 0, seconds).otherwise(F.when(seconds * 1000 > 100_000_000_000, seconds * 1000).otherwise(seconds)))
    parcel = text.parcel(F.concat(F.lit("12 Lane Mblu: "), (F.col("s_nationkey") + 1).cast("string"), F.lit("/ 7/\n"), F.col("s_suppkey").cast("string"), F.lit("/02/ ")))
    checked = text.parcel(F.when(F.col("s_suppkey") % 2 == 0, "Mblu:x Mblu:5/7/1/2/9").otherwise("Mblu:5//1/2"))
    return load(spark, sf_dir, "supplier").select("s_suppkey", text.fund_name(raw).alias("fund"), names.alias("names"), bare.alias("bare"), at.cast("timestamp_ntz").alias("at"), parcel.alias("parcel"), checked.alias("checked"))


@query("query_urls", "select c_custkey, 'https://example.org/q?name=' || replace(replace(c_name, '#', '%23'), ' ', '+') || '&segment=' || c_mktsegment as url, list_aggregate([1, 2, c_custkey][1:2], 'sum')::bigint as total from customer")
def query_urls(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    kept = composites.without_last(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"), "c_custkey"))
    return c.select("c_custkey", composites.query_url("https://example.org/q", name=F.col("c_name"), segment=F.col("c_mktsegment")).alias("url"), F.aggregate(kept, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(
    "class_lookup",
    """with f as (select n_regionkey as class, n_nationkey as place, n_name as fund from nation qualify row_number() over (partition by n_regionkey order by n_nationkey) = 1 and n_regionkey <> 4)
select c_custkey, f.class, f.fund from customer join f on c_nationkey % 6 = f.class""",
)
def class_lookup(spark, sf_dir):
    funds = load(spark, sf_dir, "nation").filter("n_regionkey <> 4").select(F.col("n_regionkey").alias("class"), F.col("n_nationkey").alias("place"), F.col("n_name").alias("fund"))
    return lookups.by_class(load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 6).alias("class")), funds, "class", "place").select("c_custkey", "class", "fund")


@query(
    "payload_dividends",
    """select ts::date as day, sum(cast(value as decimal(18, 4)))::double as amount, count(*) as n from events where event_id % 7 <> 0 group by 1""",
)
def payload_dividends(spark, sf_dir):
    e, odd = load(spark, sf_dir, "events"), F.col("event_id") % 7 == 0
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    a = F.when(F.col("event_id") % 2 == 0, F.array(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), F.when(odd, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("amount"))))
    named = lambda k: F.when((F.col("event_id") % 3 == k) & ~odd, F.col("value").cast("string"))
    entry = F.struct(F.when(F.col("event_id") % 5 == 1, at).alias("date"), F.when(F.col("event_id") % 5 == 2, at * 1000).alias("timestamp"), named(0).alias("amount"), named(1).alias("dividends"), named(2).alias("dividend"))
    b = F.when(F.col("event_id") % 2 == 1, F.create_map(at.cast("string"), entry))
    found = composites.payload_dividends(e.select(a.alias("dividends"), b.alias("by_time")))
    return found.groupBy("day").agg(F.sum(F.col("amount").cast("decimal(18,4)")).cast("double").alias("amount"), F.count("*").alias("n"))


@query(
    "index_pages",
    """select s_name as index_name, 'T' || s_suppkey as price_ticker, 1000 + s_suppkey % 1000 as num_companies, (1000 + s_suppkey)::double as market_cap_musd, floor((1000 + s_suppkey)::double + 0.5) / 1000 as market_cap_busd, date '2026-03-31' as as_of_date,
'https://example.org/indexes/us-' || s_suppkey as url from supplier where s_nationkey % 5 <> 0 and s_nationkey % 7 <> 0""",
)
def index_pages(spark, sf_dir):
    s = load(spark, sf_dir, "supplier")
    url = F.concat(F.lit("https://example.org/indexes/us-"), F.col("s_suppkey").cast("string"))
    many = F.concat(F.lit("1,"), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0"))
    ticker = F.when(F.col("s_nationkey") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("<td>Price Return Ticker</td><td>T"), F.col("s_suppkey").cast("string"), F.lit("</td>")))
    date = F.when(F.col("s_nationkey") % 5 == 0, "Dec 31, 2025").otherwise("Mar 31, 2026")
    page = F.concat(F.lit("<body><h1> "), "s_name", F.lit("</h1><p>as of "), date, F.lit("</p><table><tr>"), ticker, F.lit("<tr><td>Number of Companies<td>"), many, F.lit("<tr><td>Index Market Cap ($M)<td>$"), F.format_number(F.col("s_suppkey") + 1000, 0), F.lit("</table>"))
    return composites.index_pages(s.select(url.alias("url"), page.alias("html")), "Mar 31, 2026")


@query("index_links", "select 'https://example.org/indexes/' || n_name as url from nation where n_nationkey in (select c_nationkey from customer)")
def index_links(spark, sf_dir):
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    page = F.concat(F.lit("<p><a href='/indexes/"), "n_name", F.lit("'>x</a><a href='/other/"), F.col("c_custkey").cast("string"), F.lit("'>y</a><a>z</a>"))
    return composites.index_links(c.select(page.alias("html")), "html", "/indexes/", "https://example.org")


@query(
    "savings_rates",
    """select c_name as "accountType", floor(c_acctbal / 100 * 10000 + 0.5) / 10000 as apy, case when c_custkey % 3 > 0 then '2024-01-0' || c_custkey % 3 end as "asOfDate", 'finder' as source from customer where c_mktsegment = 'BUILDING'""",
)
def savings_rates(spark, sf_dir):
    day = F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("2024-01-0"), (F.col("c_custkey") % 3).cast("string")))
    rows = load(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("account_type"), F.col("c_name").alias("account_name"), F.col("c_acctbal").alias("value"), day.alias("date"))
    return composites.savings_rates(rows, "BUILDING", "finder")


@query("capped_lists", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) <= 3")
def capped_lists(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return rows.first_of_each(o, ["o_custkey"], 3, F.desc("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query(
    "membership_labels",
    "select c_custkey, case when c_custkey in (select o_custkey from orders where o_orderstatus = 'P') then 'F' when c_custkey in (select o_custkey from orders where o_orderpriority = '5-LOW') then 'W' end as label from customer",
)
def membership_labels(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    sets = {"F": o.filter("o_orderstatus = 'P'"), "W": o.filter("o_orderpriority = '5-LOW'")}
    return rows.labelled_by_membership(load(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", sets, "label")


@query(
    "coerced_numbers",
    """select p_partkey, p_size + 0.5::double as leading, case p_size % 4 when 0 then p_size::double when 1 then 0.0::double end as whole, case when p_size % 4 = 3 then null else p_size::double end as prefix, p_name as name from part""",
)
def coerced_numbers(spark, sf_dir):
    size = F.col("p_size").cast("string")
    odd = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(" "), size, F.lit("\n"))).when(F.col("p_size") % 4 == 1, F.lit(" ")).when(F.col("p_size") % 4 == 2, F.concat(size, F.lit("px"))).otherwise(F.lit("x1"))
    pre = F.when(F.col("p_size") % 4 == 3, F.concat(F.lit("x"), size)).otherwise(F.concat(size, F.lit(". of")))
    df = load(spark, sf_dir, "part").select("p_partkey", numeric.leading_number(F.concat(F.lit("  "), size, F.lit(".50abc"))).alias("leading"), numeric.whole_number(odd).alias("whole"), numeric.leading_number(pre).alias("prefix"), F.concat(F.lit(" \t"), "p_name", F.lit("\n")).alias("name"))
    return rows.trimmed(df, "name")


@query(
    "changed_files",
    """select event_type as name, case when event_type = 'click' then 'removed' when event_type = 'signup' then 'added' else 'changed' end as status from (select distinct event_type from events) where event_type in ('click', 'signup', 'view')""",
)
def changed_files(spark, sf_dir):
    e, runs = load(spark, sf_dir, "events"), []
    for gone, edit in (("signup", "none"), ("click", "view")):
        top = new_folder(spark, "landed")
        value = F.when((F.col("event_type") == edit) & (F.col("event_id") % 50 == 3), F.col("value") + 1).otherwise(F.col("value"))
        line = F.to_json(F.struct("event_id", value.alias("value")))
        landed.write_lines(e.filter(F.col("event_type") != gone).select(F.col("event_type").alias("name"), line.alias("value"), "event_id"), top, "2024-01-01", "event_id")
        lines = landed.landed_files(spark, top)
        # a name's files, in order, as one: their hashes stand for their bytes
        runs.append(lines.groupBy("name").agg(F.array_sort(F.collect_list(F.struct(F.regexp_extract("file", r"part-(\d+)", 1), F.sha2("bytes", 256)))).cast("string").cast("binary").alias("bytes")))
    return diff.changed_files(*runs)
