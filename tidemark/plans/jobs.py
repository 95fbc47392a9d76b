"""Whole jobs of operators.composites, on rows in the shape of their sources made of the tables' columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import composites, stats
from tidemark.plans.catalog import load, query, rounded
from tidemark.plans.months import _SETS, MONTHLY, _ranking, factor_ranking


def _text(*parts) -> Column:
    """The parts, names of columns or columns, as one text."""
    return F.concat(*[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])


def _orders(spark, sf_dir: str) -> DataFrame:
    """orders with the day d."""
    return load(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))


@query(
    "treasury_prices",
    f"""select l_shipdate::date as "asOfDate", 'P' || l_partkey as cusip, l_returnflag as securitytype, printf('%.5f', {rounded("(l_linenumber || '.250')::double / 100", 5)}) as rate,
l_shipdate::date as maturitydate, case when l_returnflag = 'R' then l_shipdate::date end as calldate, l_suppkey::varchar as buy, '' as sell,
printf('%.5f', {rounded("(l_quantity::int || '.123456')::double", 5)}) as endofday, strftime(l_shipdate, '%Y-%m-%d') || '-' || rate as key from lineitem where l_linestatus <> 'F'""",
)
def treasury_prices(spark, sf_dir):
    day = F.date_format("l_shipdate", "MM/dd/yyyy")
    cells = F.array(
        _text(F.lit("P"), "l_partkey"), F.col("l_returnflag"), _text("l_linenumber", F.lit(".250%")), day, F.when(F.col("l_returnflag") == "R", day).otherwise(""),
        _text("l_suppkey"), F.lit(" "), _text(F.col("l_quantity").cast("int"), F.lit(".123456")), F.lit("-"),
    )
    rows = load(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("asOfDate"), F.when(F.col("l_linestatus") == "F", F.array(F.lit("heading"))).otherwise(cells).alias("cells"))
    return composites.treasury_prices(rows)


@query(
    "quotes_32nds",
    """with q as (select *, o_orderdate::date as d, (90 + o_orderkey % 10 || '.' || lpad((o_orderkey % 32)::varchar, 2, '0'))::double as b from orders)
select d as "asOfDate", d as maturity, (o_custkey % 5 || '.125')::double as coupon, floor(b) + 100.0::double * (b % 1.0::double) / 32.0::double as bid, 99.0::double + 100.0::double * (99.16::double % 1.0::double) / 32.0::double as asked,
case when o_orderstatus = 'F' then 0.0 else -1250.5 end::double as chg, 2.1::double as yield, 1050.0::double as accruedprincipal, strftime(d, '%Y-%m-%d') || '-' || (o_custkey % 5) || '.125' as key from q""",
)
def quotes_32nds(spark, sf_dir):
    bid = _text(90 + F.col("o_orderkey") % 10, F.lit("."), F.lpad((F.col("o_orderkey") % 32).cast("string"), 2, "0"))
    change = F.when(F.col("o_orderstatus") == "F", "UNCH.").otherwise("-1,250.5")
    cells = F.array(F.date_format("d", "M/d/yyyy"), _text(F.col("o_custkey") % 5, F.lit(".125")), bid, F.lit("99.16"), change, F.lit("2.1%"), F.lit("1,050"))
    return composites.quotes(_orders(spark, sf_dir).select(F.col("d").alias("asOfDate"), cells.alias("cells")))


@query("release_calendar", """select d as "rlsDate", (date_trunc('month', d) - interval 1 month)::date as "cpiDate", (date_trunc('month', d) + interval 2 month)::date as "refcpiDate" from (select o_orderdate::date as d from orders)""")
def release_calendar(spark, sf_dir):
    line = F.concat(F.lit("heading\nCPI "), F.date_format("d", "MMM dd, yyyy"), F.lit(" 08:30\n"))
    return composites.release_calendar(_orders(spark, sf_dir).select(line.alias("text")))


@query(
    "note_metadata",
    f"""select o_orderkey::varchar as cusip, printf('%.5f', {rounded("(o_custkey % 5 || '.125')::double / 100", 5)}) as interest_rate, {rounded("(o_orderkey % 30)::double + (o_custkey % 12)::double / 12", 4)} as security_term,
o_orderpriority as series, o_orderdate::date as maturity_date, o_orderdate::date as dated_date, printf('%.6f', {rounded("('307.' || lpad((o_orderkey % 1000000)::varchar, 6, '0'))::double", 5)}) as ref_cpi_on_dated_date from orders""",
)
def note_metadata(spark, sf_dir):
    term = _text(F.col("o_orderkey") % 30, F.lit("-Year "), F.col("o_custkey") % 12, F.lit("-Month"))
    cpi = _text(F.lit("307."), F.lpad((F.col("o_orderkey") % 1_000_000).cast("string"), 6, "0"))
    rows = _orders(spark, sf_dir).select(
        _text("o_orderkey").alias("cusip"), _text(F.col("o_custkey") % 5, F.lit(".125")).alias("interest_rate"), term.alias("security_term"), F.col("o_orderpriority").alias("series"),
        F.date_format("d", "yyyy-MM-dd'T00:00:00'").alias("maturity_date"), F.date_format("d", "yyyy-MM-dd").alias("dated_date"), cpi.alias("ref_cpi_on_dated_date"),
    )
    return composites.note_metadata(rows)


@query(
    "filing_rows",
    """with f as (select *, o_orderdate::date as d, o_orderkey || '-1' as acc, o_orderdate::date as report, case when o_orderstatus = 'F' then '10-K' else 'N-MFP3' end as form, 'p.xml' as doc from orders
union all select *, o_orderdate::date + 1 as d, o_orderkey || '-2' as acc, null as report, 'N-MFP2/A' as form, 'q.xml' as doc from orders)
select lpad('00' || o_custkey, 10, '0') as cik, o_orderpriority as "fiscalYearEnd", acc as "accessionNumber", d as "filingDate", report as "reportDate",
'/data/' || regexp_replace('00' || o_custkey, '^0+', '') || '/' || replace(acc, '-', '') || '/' || doc as url from f where contains(form, 'MFP') and d >= date '1995-01-01'""",
)
def filing_rows(spark, sf_dir):
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    filings = F.struct(
        F.array(_text("o_orderkey", F.lit("-1")), _text("o_orderkey", F.lit("-2"))).alias("accessionNumber"),
        F.array(iso("d"), iso(F.date_add("d", 1))).alias("filingDate"),
        F.array(iso("d"), F.lit(None).cast("string")).alias("reportDate"),
        F.array(F.when(F.col("o_orderstatus") == "F", "10-K").otherwise("N-MFP3"), F.lit("N-MFP2/A")).alias("form"),
        F.array(F.lit("p.xml"), F.lit("q.xml")).alias("primaryDocument"),
    )
    rows = _orders(spark, sf_dir).select(_text(F.lit("00"), "o_custkey").alias("cik"), F.col("o_orderpriority").alias("fiscalYearEnd"), filings.alias("filings"))
    return composites.filing_rows(rows, "MFP", "1995-01-01")


@query(
    "daily_yields",
    """select o_orderkey as ticker, strftime(o_orderdate, '%Y-%m-%d') as "asOfDate", o_totalprice as "sevenDayYield", 1.0::double as nav from orders
union all select o_orderkey, strftime(o_orderdate::date + 1, '%Y-%m-%d'), o_totalprice / 2, 1.001::double from orders""",
)
def daily_yields(spark, sf_dir):
    one, two = F.date_format("d", "yyyy-MM-dd"), F.date_format(F.date_add("d", 1), "yyyy-MM-dd")
    entry = lambda day, value, name: F.struct(day.alias("date"), value.alias(name))
    yields = F.array(entry(one, F.col("o_totalprice"), "value"), entry(two, F.col("o_totalprice") / 2, "value"))
    return composites.daily_yields(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("ticker"), yields.alias("yields"), F.array(entry(two, F.lit(1.001), "nav")).alias("navs")))


@query(
    "fund_metadata",
    """with y as (select o_custkey, min(strftime(o_orderdate, '%m%d')) as "fiscalYearEnd", max(strftime(o_orderdate, '%Y-%m-%d') || '-' || lpad(o_orderkey::varchar, 12, '0')) as timestamp,
arg_max(o_totalprice, strftime(o_orderdate, '%Y-%m-%d') || '-' || lpad(o_orderkey::varchar, 12, '0')) as "expenseRatio" from orders group by 1)
select c_custkey as ticker, c_custkey as cik, lpad(c_custkey::varchar, 10, '0') as "cikTen", "fiscalYearEnd", "expenseRatio", timestamp from customer left join y on o_custkey = c_custkey""",
)
def fund_metadata(spark, sf_dir):
    o = _orders(spark, sf_dir)
    companies = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"), F.col("c_custkey").alias("cik"), F.col("c_mktsegment").alias("series_name"))
    years = o.select(F.col("o_custkey").alias("cik"), F.date_format("d", "MMdd").alias("fiscalYearEnd"))
    at = _text(F.date_format("d", "yyyy-MM-dd"), F.lit("-"), F.lpad(_text("o_orderkey"), 12, "0"))
    costs = o.select(F.col("o_custkey").alias("ticker"), F.col("o_totalprice").alias("expenseRatio"), at.alias("timestamp"))
    return composites.fund_metadata(companies, years, costs).select("ticker", "cik", "cikTen", "fiscalYearEnd", "expenseRatio", "timestamp")


@query(
    "index_snapshot",
    f"""select s_name as index_name, s_suppkey::varchar as price_ticker, 1000 + s_suppkey % 1000 as num_companies, s_suppkey * 1000 + 0.5::double as market_cap_musd,
{rounded("(s_suppkey * 1000 + 0.5::double) / 1000", 3)} as market_cap_busd, date '2026-07-08' as as_of_date from supplier""",
)
def index_snapshot(spark, sf_dir):
    count = _text(F.lit("1,"), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0"))
    cap = _text(F.lit("$"), "s_suppkey", F.lit(",000.5"))
    rows = load(spark, sf_dir, "supplier").select(F.col("s_name").alias("index_name"), _text("s_suppkey").alias("price_ticker"), count.alias("num_companies"), cap.alias("market_cap"), F.lit("Jul 08, 2026").alias("as_of"))
    return composites.index_snapshot(rows)


@query(
    "judgments",
    f"""with c as (select *, case when o_orderstatus = 'F' then '' else 'c' || o_custkey end as number, 'u' || o_orderkey as url from orders),
k as (select *, row_number() over (partition by coalesce(nullif(number, ''), url) order by o_orderkey) as n from c)
select number as "caseNumber", url as "detailUrl", case when o_orderpriority = '5-LOW' then '' else '$1,' || lpad((o_orderkey % 1000)::varchar, 3, '0') || '.25 | $5' end as "judgmentAmounts",
case when o_orderpriority <> '5-LOW' then {rounded("1000.25::double + o_orderkey % 1000 + 5", 2)} end as "judgmentTotal" from k where n = 1""",
)
def judgments(spark, sf_dir):
    amount = _text(F.lit("$1,"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit(".25"))
    detail = F.when(F.col("o_orderpriority") == "5-LOW", "dismissed").otherwise(F.concat(F.lit("For "), amount, F.lit(" and costs of $5; in all "), amount, F.lit(".")))
    number = F.when(F.col("o_orderstatus") == "F", " ").otherwise(_text(F.lit("c"), "o_custkey"))
    cases = _orders(spark, sf_dir).select(number.alias("caseNumber"), _text(F.lit("u"), "o_orderkey").alias("detailUrl"), detail.alias("detail"), F.col("o_orderkey").alias("ord"))
    return composites.judgments(cases).withColumn("caseNumber", F.trim("caseNumber"))


@query(
    "running_balance",
    f"""with e as (select l_orderkey as k, min(l_linenumber) as last from lineitem where l_returnflag = 'R' group by 1)
select l_orderkey, {rounded("cast(sum(cast(l_extendedprice as decimal(18, 2))) as double)", 2)} as total from lineitem left join e on k = l_orderkey where last is null or l_linenumber < last group by 1""",
)
def running_balance(spark, sf_dir):
    label = F.when(F.col("l_returnflag") == "R", "Total").otherwise("2024")
    cells = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"), _text(F.lit("$"), F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    return composites.running_balance(cells, "l_orderkey", "l_linenumber", "label", "amount")


@query("consolidated_names", "select distinct upper(trim(x)) as name from (select n_name as x from nation union all select c_mktsegment from customer union all select n_name || ' ' from nation) where trim(x) <> ''")
def consolidated_names(spark, sf_dir):
    names = load(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    segments = load(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("name"))
    return composites.consolidated([names, segments, names.select(F.concat("name", F.lit(" ")).alias("name")), names.select(F.lit(" ").alias("name"))], "name")


@query(
    "offers_history",
    """with o as (select o_custkey as supplier, o_orderpriority as term, o_orderdate::date as "asOfDate", (o_orderkey % 7)::varchar as rate, 'u' || o_orderkey as url, (o_orderstatus = 'F')::int as old from orders)
select supplier, term, "asOfDate", rate, url from (select *, row_number() over (partition by supplier, term, "asOfDate" order by old, rate, url) as n from o) where n = 1""",
)
def offers_history(spark, sf_dir):
    offers = lambda o: o.select(F.col("o_custkey").alias("supplier"), F.col("o_orderpriority").alias("term"), F.col("d").alias("asOfDate"), _text(F.col("o_orderkey") % 7).alias("rate"), _text(F.lit("u"), "o_orderkey").alias("url"))
    o = _orders(spark, sf_dir)
    return composites.offers_history(offers(o.filter("o_orderstatus = 'F'")), offers(o.filter("o_orderstatus <> 'F'")))


@query("payload_prices", "select o_orderdate::date as day, o_totalprice as price from orders where o_orderpriority <> '5-LOW'")
def payload_prices(spark, sf_dir):
    seconds, price = F.unix_timestamp(F.col("d").cast("timestamp")), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    first = F.col("o_orderstatus") == "F"
    rows = _orders(spark, sf_dir).select(
        F.when(first, F.array(F.struct(seconds.alias("date"), price.alias("close")))).alias("quotes"),
        F.when(~first, F.array(seconds * 1000)).alias("timestamp"),
        F.when(~first, F.array(price)).alias("close"),
    )
    return composites.payload_prices(rows)


_ALL_SETS = " union all ".join(f"select * from {_ranking(*s)}" for s in _SETS)


@query("factor_worst_first", f"with {MONTHLY} select * from ({_ALL_SETS}) where shape_pct is not null order by shape_pct desc, years")
def factor_worst_first(spark, sf_dir):
    return stats.ranked(factor_ranking(spark, sf_dir), "shape_pct", "years")


@query("factor_best", f"with {MONTHLY} select * from ({_ALL_SETS}) where shape_pct is not null order by shape_pct, years, trimmed limit 1")
def factor_best(spark, sf_dir):
    named = factor_ranking(spark, sf_dir).withColumn("name", _text("years", F.lit(" "), "trimmed"))
    return stats.best(named, "shape_pct", "name").drop("name")
