"""Queries that parse texts: names, amounts, facts, pages, JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import numeric, text
from tidemark.operators import lookups
from tidemark.plans.catalog import load, query, rounded
from tidemark.sources import html


def _sql_rules(column: str, rules: tuple) -> str:
    for pattern, new, every in rules:
        pattern, new = pattern.replace("'", "''"), new.replace("'", "''").replace("\\n", "\n")
        column = f"regexp_replace({column}, '{pattern}', '{new}'" + (", 'g')" if every else ")")
    return column


_NAME = "s_name || ', LLC AND SONS ' || case s_suppkey % 4 when 0 then 'THE BANK OF X N A' when 1 then 'Secretary of Housing and' when 2 then 'Nat''l Inc.' else 'x  y' end"


@query("normalize_names", f"select s_suppkey, {_sql_rules(f'upper(trim({_NAME}))', text.NAME_RULES)} as name, {_sql_rules("upper(trim('12 ' || s_name || ' Cove Drive, PA'))", text.ADDRESS_RULES)} as address from supplier")
def normalize_names(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    tail = F.when(k == 0, "THE BANK OF X N A").when(k == 1, "Secretary of Housing and").when(k == 2, "Nat'l Inc.").otherwise("x  y")
    name = F.concat("s_name", F.lit(", LLC AND SONS "), tail)
    return load(spark, sf_dir, "supplier").select("s_suppkey", text.normalized_name(name).alias("name"), text.normalized_address(F.concat(F.lit("12 "), "s_name", F.lit(" Cove Drive, PA"))).alias("address"))


_PAGE = "'Fund ' || p_name || ' NAV as of Jul 08, 2026 $' || printf('%.2f', p_retailprice) || ' Expense Ratio 0.' || lpad((p_size)::varchar, 2, '0') || '% Effective Duration ' || printf('%.2f', p_size / 10.0) || ' yrs Weighted Avg Maturity ' || p_size || ' yrs 12m Trailing Yield ' || printf('%.2f', p_size / 7.0) || '%'"


@query(
    "text_facts",
    f"""with t as (select p_partkey, {_PAGE} as x from part) select p_partkey, cast(regexp_extract(x, 'NAV as of.*?\\$([0-9,]+(?:\\.[0-9]+)?)', 1) as double) as nav,
{rounded("cast(regexp_extract(x, 'Expense Ratio[^\\n]*?([0-9,]+(?:\\.[0-9]+)?)%', 1) as double) / 100", 6)} as "expenseRatio", cast(regexp_extract(x, 'Duration[^\\n]*?([0-9,]+(?:\\.[0-9]+)?)', 1) as double) as "durationYears",
cast(regexp_extract(x, 'Weighted Avg Maturity[^\\n]*?([0-9,]+(?:\\.[0-9]+)?)', 1) as double) as "maturityYears", {rounded("cast(regexp_extract(x, '12m Trailing Yield[^\\n]*?([0-9,]+(?:\\.[0-9]+)?)%', 1) as double) / 100", 6)} as "twelveMonTrlYield" from t""",
)
def text_facts(spark, sf_dir):
    size = F.col("p_size")
    page = F.concat(
        F.lit("Fund "), "p_name", F.lit(" NAV as of Jul 08, 2026 $"), F.format_string("%.2f", "p_retailprice"), F.lit(" Expense Ratio 0."), F.lpad(size.cast("string"), 2, "0"), F.lit("% Effective Duration "),
        F.format_string("%.2f", size / 10.0), F.lit(" yrs Weighted Avg Maturity "), size.cast("string"), F.lit(" yrs 12m Trailing Yield "), F.format_string("%.2f", size / 7.0), F.lit("%"),
    )
    facts = text.fund_facts(F.col("page"), F.lit(""))
    return load(spark, sf_dir, "part").select("p_partkey", page.alias("page")).select("p_partkey", *[facts[c].alias(c) for c in ("nav", "expenseRatio", "durationYears", "maturityYears", "twelveMonTrlYield")])


@query(
    "money_mentions",
    f"""with t as (select p_partkey, 'Awarded $' || printf('%.2f', p_retailprice) || ' and $' || p_size || ',000.50; again $' || printf('%.2f', p_retailprice) as x from part),
m as (select p_partkey, list_distinct(regexp_extract_all(x, '\\$[0-9][0-9,]*(?:\\.[0-9]{{2}})?')) as l from t)
select p_partkey, cast(len(l) as bigint) as n, {rounded("list_sum(list_transform(l, lambda y: cast(regexp_replace(y, '[$,]', '', 'g') as double)))", 2)} as total from m""",
)
def money_mentions(spark, sf_dir):
    x = F.concat(F.lit("Awarded $"), F.format_string("%.2f", "p_retailprice"), F.lit(" and $"), F.col("p_size").cast("string"), F.lit(",000.50; again $"), F.format_string("%.2f", "p_retailprice"))
    m = load(spark, sf_dir, "part").select("p_partkey", F.array_distinct(text.money_mentions(x)).alias("l"))
    total = F.aggregate("l", F.lit(0.0), lambda a, y: a + numeric.parse_money(y))
    return m.select("p_partkey", F.size("l").cast("long").alias("n"), numeric.round_half_up(total, 2).alias("total"))


@query("price_32nds", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, {rounded('floor(q) + 100.0::double * (q % 1.0::double) / 32.0::double', 6)} as price from (select *, l_quantity + floor(l_discount * 100) / 100 as q from lineitem)")
def price_32nds(spark, sf_dir):
    q = F.col("l_quantity") + F.floor(F.col("l_discount") * 100) / 100
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numeric.round_half_up(numeric.from_32nds(q), 6).alias("price"))


@query(
    "percent_money_parse",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, {rounded("cast(printf('%.2f', l_tax * 100) as double) / 100", 6)} as pct, cast(printf('%.2f', l_extendedprice) as double) as money,
round(l_quantity)::double * case l_linenumber % 3 when 0 then 1e9 when 1 then 1e6 else 1.0 end as scaled from lineitem""",
)
def percent_money_parse(spark, sf_dir):
    unit = F.when(F.col("l_linenumber") % 3 == 0, "B").when(F.col("l_linenumber") % 3 == 1, "million").otherwise("")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        numeric.parse_percent(F.concat(F.format_string("%.2f", F.col("l_tax") * 100), F.lit("%"))).alias("pct"),
        numeric.parse_money(F.concat(F.lit("$"), F.format_string("%,.2f", "l_extendedprice"))).alias("money"),
        numeric.scaled(F.round("l_quantity"), unit).alias("scaled"),
    )


@query("html_title", "select page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) as title from pages")
def html_title(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("html_links", "select page_id, pos::int as pos, href from (select page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) as l from pages), lateral (select unnest(l) as href, unnest(range(len(l))) as pos)")
def html_links(spark, sf_dir):
    return html.attributes(load(spark, sf_dir, "pages"), "page_id", "html", "a", "href").withColumnRenamed("value", "href")


@query("html_lists", "select page_id, pos::int as pos, regexp_replace(item, '<[^>]*>', '', 'g') as item from (select page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) as l from pages), lateral (select unnest(l) as item, unnest(range(len(l))) as pos)")
def html_lists(spark, sf_dir):
    return html.elements(load(spark, sf_dir, "pages"), "page_id", "html", "li").withColumnRenamed("text", "item")


@query("props_json", "select event_id, cast(json_extract_string(props, '$.k') as integer) as k, coalesce(json_extract_string(props, '$.none'), '-') as none, props::json::varchar as again from events")
def props_json(spark, sf_dir):
    parsed = F.from_json("props", "k int, none string")
    return load(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), F.coalesce(parsed["none"], F.lit("-")).alias("none"), F.col("props").alias("again"))


@query(
    "parallel_arrays",
    """with a as (select user_id, list(event_type order by event_id) as kinds, list(value order by event_id) as vals from events group by 1)
select user_id, (pos - 1)::int as pos, kind, v from (select user_id, unnest(kinds) as kind, unnest(vals) as v, unnest(range(1, len(kinds) + 1)) as pos from a) where contains(kind, 'i')""",
)
def parallel_arrays(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value")))
    a = load(spark, sf_dir, "events").groupBy("user_id").agg(rows.alias("r")).select("user_id", F.col("r.event_type").alias("kind"), F.col("r.value").alias("v"))
    return a.select("user_id", F.posexplode(F.arrays_zip("kind", "v")).alias("pos", "x")).select("user_id", "pos", "x.*").filter(F.col("kind").contains("i"))


@query(
    "substring_lookup",
    """with w as (select doc_id, unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z0-9]+'))) as w from documents)
select doc_id, k.name from w join (select 'license' as name union all select 'public' union all select 'token' union all select 'general') k on k.name = w.w""",
)
def substring_lookup(spark, sf_dir):
    names = spark.createDataFrame([("license",), ("public",), ("token",), ("general",)], "name string")
    return lookups.substring_lookup(load(spark, sf_dir, "documents").select("doc_id", "text"), names, "text", "name").select("doc_id", "name")


@query(
    "containment_lookup",
    """with w as (select distinct w from (select unnest(regexp_extract_all(text, '[A-Za-z]{2,}')) as w from benchmark)),
m as (select w.w as word, conv_id, turn from w join conversations c on contains(c.text, w.w))
select w.w as word, count(m.conv_id) as turns, count(distinct m.conv_id) as conversations, min(struct_pack(conv_id := m.conv_id, turn := m.turn)).conv_id as first_conversation from w left join m on m.word = w.w group by 1""",
)
def containment_lookup(spark, sf_dir):
    words = load(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0))).alias("word")).distinct()
    found = lookups.containing(load(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), words, "text", "word")
    of = found.groupBy("word").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("conversations"), F.min("conv_id").alias("first_conversation"))
    return words.join(of, "word", "left").select("word", F.coalesce("turns", F.lit(0)).alias("turns"), F.coalesce("conversations", F.lit(0)).alias("conversations"), "first_conversation")


@query(
    "first_containing_id",
    """with f as (select o_orderkey, format('{:010d}', o_custkey) || '-' || o_orderstatus as path, o_orderstatus from orders), c as (select c_custkey, cast(c_custkey as varchar) as id from customer),
m as (select c_custkey, min(o_orderkey) as o_orderkey from c join f on contains(f.path, c.id) group by 1)
select c_custkey, f.o_orderkey, f.path from c left join m using (c_custkey) left join f on f.o_orderkey = m.o_orderkey""",
)
def first_containing_id(spark, sf_dir):
    files = load(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.format_string("%010d", "o_custkey"), F.lit("-"), F.col("o_orderstatus")).alias("path"))
    ids = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("id"))
    return lookups.first_containing(ids, files, "id", "path", "o_orderkey").drop("id")


@query(
    "nested_transform",
    """select o_custkey, string_agg(upper(trim(o_orderpriority)) || '=' || o_orderkey, ';' order by o_orderkey) as owners, count(distinct o_orderpriority) as kinds from orders group by 1""",
)
def nested_transform(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("r"))
    rows = rows.withColumn("r", F.transform("r", lambda x: x.withField("o_orderpriority", F.upper(F.trim(x["o_orderpriority"])))))
    return rows.select("o_custkey", F.array_join(F.transform("r", lambda x: F.concat(x["o_orderpriority"], F.lit("="), x["o_orderkey"].cast("string"))), ";").alias("owners"), F.size(F.array_distinct(F.col("r.o_orderpriority"))).cast("long").alias("kinds"))


@query(
    "term_years",
    f"""select p_partkey, {rounded("(p_size + (p_size % 12) / 12.0::double)", 6)} as years, 'line' || (p_size % 7) || '-x' as label from part""",
)
def term_years(spark, sf_dir):
    term = F.concat(F.col("p_size").cast("string"), F.lit("-Year "), (F.col("p_size") % 12).cast("string"), F.lit("-Month"))
    label = text.header_key(F.concat(F.lit(" Line * "), (F.col("p_size") % 7).cast("string"), F.lit("-X*")))
    return load(spark, sf_dir, "part").select("p_partkey", numeric.round_half_up(text.years_of_term(term), 6).alias("years"), label.alias("label"))


@query("percent_near", "select p_partkey, case when p_size % 5 = 0 then null else cast(printf('%.2f', p_size / 10.0) as double) end as apy from part")
def percent_near(spark, sf_dir):
    page = F.concat(F.when(F.col("p_size") % 5 != 0, "rates: Annual Percentage Yield is ").otherwise("none "), F.format_string("%.2f", F.col("p_size") / 10.0), F.lit(" % today"))
    return load(spark, sf_dir, "part").select("p_partkey", text.percent_near(page, "Annual Percentage Yield").alias("apy"))
