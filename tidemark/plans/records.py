"""Queries on records that share keys: indexes, related records, reports, statistics. Orders, customers,
parts and suppliers stand for lots, owners and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import hash_code, per_unit, round_half_up
from tidemark.operators import graph, nested, stats
from tidemark.plans.catalog import load, query, rounded


def _links(spark, sf_dir: str) -> DataFrame:
    """Orders with their customer and the customer's nation's name as owners of two kinds."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    both = F.explode(F.array(F.struct(F.col("c_name").alias("owner"), F.when(F.col("o_orderkey") % 4 == 0, "Previous").otherwise("Deed").alias("kind")), F.struct(F.concat(F.col("n_name"), F.lit(" "), F.col("o_custkey") % 50).alias("owner"), F.lit("General").alias("kind"))))
    return o.select(F.col("o_orderkey").alias("lot"), (F.col("o_orderstatus") == "F").alias("home"), both.alias("x")).select("lot", "home", "x.*")


_LINKS = """links as (select o_orderkey as lot, o_orderstatus = 'F' as home, c_name as owner, case when o_orderkey % 4 = 0 then 'Previous' else 'Deed' end as kind from orders join customer on o_custkey = c_custkey
union all select o_orderkey, o_orderstatus = 'F', n_name || ' ' || (o_custkey % 50), 'General' from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


@query(
    "owner_index",
    f"""with {_LINKS}, k as (select owner, lot, string_agg(distinct kind, '+' order by kind) as kinds, max((kind in ('Deed', 'General'))::int) as own, max(home::int) as home from links group by all)
select owner, string_agg(lot || ':' || kinds, ';' order by lot) as lots, count(*) filter (own = 1 and home = 1) as "homeLotCnt", count(*) filter (own = 1 and home = 0) as "emptyLotCnt", count(*) filter (own = 0) as "previousLotCnt" from k group by owner""",
)
def owner_index(spark, sf_dir):
    links = _links(spark, sf_dir)
    lots = graph.inverted_index(links, "owner", "lot", "kind")
    shown = F.array_join(F.transform("records", lambda x: F.concat(x["record"].cast("string"), F.lit(":"), F.array_join(x["kinds"], "+"))), ";")
    counts = graph.index_counts(links, "owner", "lot", "kind", ["Deed", "General"], F.col("home"))
    return lots.select("owner", shown.alias("lots")).join(counts, "owner")


@query("address_index", "select n_name as address, string_agg(distinct s_suppkey, ';' order by s_suppkey) as lots from supplier join nation on s_nationkey = n_nationkey where n_name <> 'NATION_0' group by n_name")
def address_index(spark, sf_dir):
    links = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).filter("n_name <> 'NATION_0'")
    return graph.key_groups(links, "n_name", "s_suppkey").select(F.col("n_name").alias("address"), F.array_join(F.transform("records", lambda x: x.cast("string")), ";").alias("lots"))


_PAIRS = "pairs as (select distinct l_orderkey as key, l_partkey as lot from lineitem)"


@query("related_keys", f"with {_PAIRS}, r as (select distinct a.lot, b.lot as related from pairs a join pairs b using (key) where a.lot <> b.lot) select lot, string_agg(related, ';' order by related) as related, count(*) as n from r group by lot")
def related_keys(spark, sf_dir):
    pairs = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("lot"))
    r = graph.related(pairs, "key", "lot").groupBy("lot").agg(F.array_sort(F.collect_list("related")).alias("r"))
    return r.select("lot", F.array_join(F.transform("r", lambda x: x.cast("string")), ";").alias("related"), F.size("r").cast("long").alias("n"))


@query(
    "related_sums",
    f"""with {_PAIRS}, r as (select distinct a.lot, b.lot as related from pairs a join pairs b using (key) where a.lot <> b.lot),
o as (select r.lot, sum(p_size) as others from r join part on related = p_partkey group by 1) select p_partkey as lot, p_size + coalesce(others, 0)::double as total from part left join o on p_partkey = lot""",
)
def related_sums(spark, sf_dir):
    pairs = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("lot"))
    values = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("lot"), F.col("p_size").cast("double").alias("v"))
    return graph.related_sums(pairs, "key", "lot", values, "v")


_LOT_KEYS = "k as (select 'c' || o_custkey as key, o_orderkey as lot from orders union all select 'd' || o_orderpriority || o_orderdate, o_orderkey from orders)"


def _lot_keys(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("key"), F.col("o_orderkey").alias("lot")).unionByName(o.select(F.concat(F.lit("d"), "o_orderpriority", F.col("o_orderdate").cast("string")).alias("key"), F.col("o_orderkey").alias("lot")))


@query(
    "related_totals",
    f"""with {_LOT_KEYS}, r as (select distinct a.lot, b.lot as other from k a join k b using (key))
select r.lot, cast(sum(cast(o_totalprice as decimal(18, 4))) as double) as total, count(*) - 1 as n from r join orders on other = o_orderkey group by 1""",
)
def related_totals(spark, sf_dir):
    values = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("lot"), F.col("o_totalprice").cast("decimal(18,4)").alias("v"))
    return graph.related_totals(_lot_keys(spark, sf_dir), "key", "lot", values, "v")


@query(
    "paged_owners",
    """with r as (select n_name as owner, c_custkey as lot, row_number() over (partition by n_name order by c_custkey) - 1 as rank from customer join nation on c_nationkey = n_nationkey)
select owner, rank // 20 as page, string_agg(lot, ';' order by lot) as lots from r group by all""",
)
def paged_owners(spark, sf_dir):
    links = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("owner"), F.col("c_custkey").alias("lot"), F.lit("owner").alias("kind"))
    return graph.paged_index(links, "owner", "lot", "kind", 20).select("owner", "page", F.array_join(F.transform("records", lambda x: x["record"].cast("string")), ";").alias("lots"))


@query(
    "nested_lookup",
    """with o as (select o_custkey, year(o_orderdate) as y, o_orderpriority as p, o_orderkey from orders), ids as (select distinct o_orderpriority as p, ord(substr(o_orderpriority, 3, 1)) as id from orders where o_orderpriority not like '%LOW'),
n as (select o_custkey, y, string_agg(coalesce(id::varchar, '-'), ',' order by o_orderkey) as ids, string_agg(lower(o.p), ',' order by o_orderkey) as names from o left join ids using (p) group by 1, 2)
select o_custkey, string_agg(y || ':' || ids, ';' order by y) as previous_ids, string_agg(y || ':' || names, ';' order by y) as previous from n group by 1""",
)
def nested_lookup(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", F.col("o_orderpriority").alias("name"))
    by_year = o.groupBy("o_custkey", "year").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "name"))).alias("x")).select("o_custkey", F.struct("year", F.col("x.name").alias("owners")).alias("p"))
    lots = by_year.groupBy("o_custkey").agg(F.array_sort(F.collect_list("p")).alias("previous"))
    ids = o.filter("name not like '%LOW'").select("name", F.ascii(F.substring("name", 3, 1)).alias("id")).distinct()
    found = nested.changed_at(nested.looked_up(lots, {"ids": "previous.owners"}, ids, "name", "id"), {"previous.owners": F.lower})
    joined = lambda years, lists: F.array_join(F.zip_with(years, lists, lambda p, x: F.concat(p["year"].cast("string"), F.lit(":"), F.array_join(x, ","))), ";")
    shown = F.transform("ids", lambda v: F.transform(v, lambda i: F.coalesce(i.cast("string"), F.lit("-"))))
    return found.select("o_custkey", joined(F.col("previous"), shown).alias("previous_ids"), joined(F.col("previous"), F.col("previous.owners")).alias("previous"))


@query(
    "full_report",
    f"""select o_orderkey, c_name, n_name, r_name, 'https://example.org/lot/' || o_orderkey || '?owner=' || c_custkey as link, case when c_acctbal > 0 then {rounded('o_totalprice / c_acctbal', 2)} end as per_balance,
case when c_nationkey = s.k then 'Y' end as resident from orders join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey left join (select distinct s_nationkey as k from supplier where s_suppkey % 5 = 0) s on s.k = c_nationkey""",
)
def full_report(spark, sf_dir):
    residents = load(spark, sf_dir, "supplier").filter("s_suppkey % 5 = 0").select(F.col("s_nationkey").alias("c_nationkey"), F.lit("Y").alias("resident")).distinct()
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    c = c.join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").join(residents, "c_nationkey", "left")
    link = F.format_string("https://example.org/lot/%d?owner=%d", "o_orderkey", "c_custkey")
    return load(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name", "r_name", link.alias("link"), per_unit(F.col("o_totalprice"), F.col("c_acctbal")).alias("per_balance"), "resident")


@query("filter_report", "select c_custkey, c_name from customer where c_mktsegment not in ('BUILDING', 'MACHINERY') and c_custkey % 2 = 0 and c_name like 'Customer#%1%'")
def filter_report(spark, sf_dir):
    return load(spark, sf_dir, "customer").filter(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_custkey") % 2 == 0) & F.col("c_name").like("Customer#%1%")).select("c_custkey", "c_name")


@query(
    "valuation_stats",
    f"""with v as (select c_mktsegment, list_sort(list(c_acctbal) filter (c_acctbal > 0)) as l, cast(sum(cast(c_acctbal as decimal(18, 2))) filter (c_acctbal > 0) as double) as s from customer group by 1)
select c_mktsegment, cast(len(l) as bigint) as home_count, {rounded("s", 2)} as home_total, floor(s / len(l) + 0.5) as home_avg, l[1] as home_min, l[len(l)] as home_max, l[len(l) // 2 + 1] as home_median from v""",
)
def valuation_stats(spark, sf_dir):
    return stats.valuation(load(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal", F.col("c_acctbal") > 0, "home")


@query(
    "conditional_counts",
    "select p_brand, count(*) filter (p_size < 10) as small, count(*) filter (p_size >= 10 and p_retailprice > 1000) as dear, count(*) filter (p_type like '%A%') as typed from part group by 1",
)
def conditional_counts(spark, sf_dir):
    tests = {"small": F.col("p_size") < 10, "dear": (F.col("p_size") >= 10) & (F.col("p_retailprice") > 1000), "typed": F.col("p_type").contains("A")}
    return stats.conditional_counts(load(spark, sf_dir, "part"), ["p_brand"], tests)


@query("lots_per_owner", f"select c_mktsegment, max(n) as most, {rounded('sum(n)::double / count(*)', 2)} as mean, count(*) as owners from (select c_mktsegment, c_custkey, count(*) as n from orders join customer on o_custkey = c_custkey group by all) group by 1")
def lots_per_owner(spark, sf_dir):
    n = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "c_custkey").agg(F.count("*").alias("n"))
    return n.groupBy("c_mktsegment").agg(F.max("n").alias("most"), round_half_up(F.sum("n").cast("double") / F.count("*"), 2).alias("mean"), F.count("*").alias("owners"))


@query(
    "hash_ids",
    """with h as (select c_custkey, list_reduce(list_concat([0::bigint], list_transform(string_split(c_name, ''), lambda c: ord(c)::bigint)), lambda a, x: ((a * 31 + x) & 4294967295)) as h from customer)
select c_custkey, abs(case when h >= 2147483648 then h - 4294967296 else h end)::bigint as oid from h""",
)
def hash_ids(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", hash_code(F.col("c_name")).alias("oid"))


@query(
    "text_sorted_numbers",
    "select s_nationkey, string_agg(s_suppkey, ';' order by s_suppkey::varchar) as lots from supplier group by 1",
)
def text_sorted_numbers(spark, sf_dir):
    lots = load(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.collect_list("s_suppkey").alias("x"))
    return lots.select("s_nationkey", F.array_join(F.transform(graph.in_text_order(F.col("x")), lambda v: v.cast("string")), ";").alias("lots"))
