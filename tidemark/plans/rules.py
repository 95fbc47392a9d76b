"""Queries of row rules (operators.rows) and of rounding by exact binary values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_up, to_fixed
from tidemark.functions.text import like_prefixes
from tidemark.operators import diff, lookups, rows
from tidemark.plans.catalog import load, query, rounded
from tidemark.sources import files


@query("sparse_projection", "select o_orderkey, nullif(o_custkey % 3, 0) as kind, case when o_orderstatus <> 'F' then o_orderstatus end as status, case when o_orderstatus = 'F' then true end as done from orders")
def sparse_projection(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).otherwise("")
    o = load(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("kind"), status.alias("status"), (F.col("o_orderstatus") == "F").alias("done"))
    return rows.sparse(o, ["o_orderkey"], ["kind", "status", "done"])


@query(
    "accepted_measures",
    """with m as (select event_id, case when event_id % 3 = 0 then value end as one, case when event_id % 5 = 0 then value * 2 end as two, case when event_type = 'view' then value else -value end as amount from events)
select event_id, coalesce(case when one >= 50 then one end, case when two >= 10 then two end) as accepted, case when amount > 0 then amount end as amount from m where one is not null or two is not null""",
)
def accepted_measures(spark, sf_dir):
    v, n = F.col("value"), F.col("event_id")
    e = load(spark, sf_dir, "events").select("event_id", F.when(n % 3 == 0, v).alias("one"), F.when(n % 5 == 0, v * 2).alias("two"), F.when(F.col("event_type") == "view", v).otherwise(-v).alias("amount"))
    accepted = rows.first_accepted([(F.col("one"), 50.0), (F.col("two"), 10.0)])
    return rows.with_any(e, ["one", "two"]).select("event_id", accepted.alias("accepted"), rows.positive(F.col("amount")).alias("amount"))


@query(
    "price_or_nav",
    """select o_orderkey, case when o_orderstatus = 'F' then coalesce(case when o_custkey % 2 = 0 then o_totalprice end, 1.0) else o_totalprice / 2 end as price, 'later' as source from orders where o_orderpriority = '1-URGENT'""",
)
def price_or_nav(spark, sf_dir):
    price = F.col("o_totalprice")
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, price).alias("price"), F.lit(1.0).alias("nav"), F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("form"), (price / 2).alias("half"))
    of_form = rows.by_version(F.col("form"), {"F": F.col("price")}, F.col("half"))
    return rows.relabelled(rows.renamed(o, "nav", "price"), "source", "1-URGENT", "later", price=of_form).select("o_orderkey", "price", "source")


@query("without_headings", "select n_nationkey, n_name from nation")
def without_headings(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return rows.without_headings(n.union(n.select("n_nationkey", F.lit(" Name "))), {"n_name": "NAME"})


@query("readable_pages", "select page_id, '2024-01-02' as report_date from pages where html is not null and not contains(html, '<form') and not contains(html, 'Unavailable')")
def readable_pages(spark, sf_dir):
    return rows.readable(load(spark, sf_dir, "pages"), "html", ["<form", "Unavailable"]).select("page_id", F.lit("2024-01-02").alias("report_date"))


@query("map_rows", "select o_orderkey, 'status' as name, o_orderstatus as value from orders union all select o_orderkey, 'priority', o_orderpriority from orders")
def map_rows(spark, sf_dir):
    entries = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    return rows.map_rows(load(spark, sf_dir, "orders").select("o_orderkey", entries.alias("m")), "m", "name", "value")


@query("fields_dropped", "select o_orderkey, o_orderstatus as status, o_custkey as custkey from orders")
def fields_dropped(spark, sf_dir):
    whole = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("at")).dropFields("at")
    return load(spark, sf_dir, "orders").select("o_orderkey", whole.alias("x")).select("o_orderkey", "x.*")


@query("long_report", "select 'orders' as section, 'rows' as metric, count(*)::varchar as value from orders union all select 'orders', 'customers', count(distinct o_custkey)::varchar from orders")
def long_report(spark, sf_dir):
    return rows.long_report(load(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.count_distinct("o_custkey").alias("customers")), "orders")


_COUNTED = ("customer", "orders", "lineitem", "events")


@query("row_counts", " union all ".join(f"select '{t}' as \"table\", count(*) as rows from {t}" for t in _COUNTED))
def row_counts(spark, sf_dir):
    return rows.row_counts({t: load(spark, sf_dir, t) for t in _COUNTED})


@query(
    "series_compared",
    f"""select l_returnflag, {rounded("avg(d)", 4)} as "meanDiff", {rounded("var_pop(d)", 4)} as variance, {rounded("stddev_pop(d)", 4)} as sd, {rounded("avg(case when l_tax <> 0 then abs(d) / abs(l_tax) * 100 end)", 3)} as "meanAbsPct"
from (select *, l_discount - l_tax as d from lineitem) group by 1""",
)
def series_compared(spark, sf_dir):
    c = rows.compared(load(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_discount", "l_tax")
    return c.select("l_returnflag", *[round_half_up(F.col(n), 3 if n == "meanAbsPct" else 4).alias(n) for n in ("meanDiff", "variance", "sd", "meanAbsPct")])


@query(
    "to_fixed",
    """with x as (select l_orderkey, l_linenumber, l_extendedprice / 1000 as a, (l_orderkey % 4096)::double / 8 - 100 as b from lineitem)
select l_orderkey, l_linenumber, case when a * 8 = floor(a * 8) then floor(a * 100 + 0.5) / 100 else printf('%.2f', a)::double end as a, sign(b) * floor(abs(b) * 100 + 0.5) / 100 as b from x""",
)
def to_fixed_texts(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", to_fixed(F.col("l_extendedprice") / 1000, 2).alias("a"), to_fixed((F.col("l_orderkey") % 4096).cast("double") / 8 - 100, 2).alias("b"))


@query("checked_join", "select o_orderkey, o_custkey, c_name from orders join customer on c_custkey = o_custkey")
def checked_join(spark, sf_dir):
    names = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return lookups.checked_join(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), names, ["o_custkey"])


@query("seeded_prefixes", "select n_nationkey, n_name, starts_with(n_name, 'A') or starts_with(n_name, 'U') or starts_with(n_name, 'N') as named from (select n_nationkey, n_name from nation union all select 100, 'UTOPIA (N)')")
def seeded_prefixes(spark, sf_dir):
    n = files.with_seed(load(spark, sf_dir, "nation").select("n_nationkey", "n_name"), [(100, "UTOPIA (N)")])
    return n.withColumn("named", like_prefixes(F.col("n_name"), ["A", "U", "N"]))


@query("ids_by_kind", "select c_custkey, coalesce(f, p, 'none') as id from customer left join (select o_custkey, min('F' || o_orderkey) filter (where o_orderstatus = 'F') as f, min('O' || o_orderkey) filter (where o_orderstatus = 'O') as p from orders group by 1) on o_custkey = c_custkey")
def ids_by_kind(spark, sf_dir):
    """The id of the first kind that a customer has."""
    id_ = F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))
    of = lambda kind: F.min(F.when(F.col("o_orderstatus") == kind, id_))
    ids = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.coalesce(of("F"), of("O")).alias("id"))
    return load(spark, sf_dir, "customer").select("c_custkey").join(ids, "c_custkey", "left").withColumn("id", F.coalesce("id", F.lit("none")))


@query("nested_diff", "select o_orderkey, 'changed' as status, 'x' as changed from orders where o_orderstatus = 'F'")
def nested_diff(spark, sf_dir):
    """Only changes outside of timestamps, which are ignored inside of structs and arrays also."""

    def run(at: int, total):
        part = F.struct(F.lit(at).alias("timestamp"), total.alias("total"))
        x = F.struct(F.col("o_custkey").alias("custkey"), F.array(part).alias("parts"), F.lit(at).alias("timestamp"))
        return load(spark, sf_dir, "orders").select("o_orderkey", x.alias("x"))

    total = F.col("o_totalprice")
    return diff.keyed_diff(run(1, total), run(2, F.when(F.col("o_orderstatus") == "F", total + 1).otherwise(total)), ["o_orderkey"])
