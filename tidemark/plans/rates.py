"""Queries on rates from many sources: winners, filling, pivots. The events table stands for rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import composites, dedupe, diff, lookups, pivots, series
from tidemark.plans.catalog import load, query, rounded

SOURCES = {"click": "fidelity", "view": "cnbc", "purchase": "edgar", "signup": "nasdaq", "error": "yieldFinder"}
OLDEST = "2024-01-03"
_SOURCE = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in SOURCES.items()) + " end"
_PRIORITY = "case event_type when 'click' then 10 when 'view' then 4 when 'purchase' then 5 when 'signup' then 2 else 3 end"
_K = "cast(json_extract_string(props, '$.k') as integer)"
RATES = f"""rates as (select cast(user_id as varchar) as ticker, cast(ts as date) as "asOfDate", {_SOURCE} as source, {_PRIORITY} as priority,
  case when {_K} % 5 = 0 then value / 2 end as "oneDayYield", case when {_K} % 7 = 0 then 0.0 else value end as "sevenDayYield",
  case when {_K} % 3 = 0 then value * 2 end as "thirtyDayYield", ts as timestamp, event_id as ord from events),
kept as (select * from rates where "asOfDate" >= date '{OLDEST}' and (priority >= 5 or not (isodow("asOfDate") in (6, 7)))
  and ("sevenDayYield" is null or "sevenDayYield" <> 0) and ticker <> '7')"""
_COUNT = "(({x}.one is not null)::int + ({x}.seven is not null)::int + ({x}.thirty is not null)::int)"
FOLD = f"""best as (select ticker, "asOfDate", list_reduce(list({{'ord': ord, 'source': source, 'priority': priority, 'one': "oneDayYield", 'seven': "sevenDayYield", 'thirty': "thirtyDayYield", 'ts': timestamp}} order by ord),
  lambda a, x: case when x.priority > a.priority or (x.priority = a.priority and ((x.one is not null and a.one is null) or (x.thirty is not null and a.thirty is null)
    or {_COUNT.format(x="x")} > {_COUNT.format(x="a")} or x.ts > a.ts)) then x else a end) as w from kept group by all),
history as (select ticker, "asOfDate", w.source as source, w.one as "oneDayYield", w.seven as "sevenDayYield", w.thirty as "thirtyDayYield", w.ord as ord from best)"""
_YIELDS = '"oneDayYield", "sevenDayYield", "thirtyDayYield"'


def rates(spark, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    source = F.element_at(F.create_map(*[F.lit(x) for kv in SOURCES.items() for x in kv]), F.col("event_type"))
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.to_date("ts").alias("asOfDate"),
        source.alias("source"),
        F.when(k % 5 == 0, F.col("value") / 2).alias("oneDayYield"),
        F.when(k % 7 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("sevenDayYield"),
        F.when(k % 3 == 0, F.col("value") * 2).alias("thirtyDayYield"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("ord"),
    )


def history(spark, sf_dir: str) -> DataFrame:
    best = dedupe.best_source(dedupe.trusted_rates(rates(spark, sf_dir), OLDEST, ("7",)))
    return best.select("ticker", "asOfDate", "source", *dedupe.YIELDS, "ord")


@query("rates_best_source", f'with {RATES}, {FOLD} select ticker, "asOfDate", source, {_YIELDS}, ord from history')
def rates_best_source(spark, sf_dir):
    return history(spark, sf_dir)


@query(
    "rates_gap_filled",
    f"""with {RATES}, {FOLD}, spans as (select *, coalesce(lead("asOfDate") over (partition by ticker order by "asOfDate") - 1, "asOfDate") as last from history),
days as (select *, unnest(generate_series("asOfDate"::timestamp, last::timestamp, interval 1 day))::date as day from spans)
select ticker, day as "asOfDate", case when day > "asOfDate" then 'gapFiller (' || source || ')' else source end as source, {_YIELDS} from days""",
)
def rates_gap_filled(spark, sf_dir):
    return series.gap_filled(history(spark, sf_dir).drop("ord"), ["ticker"], "asOfDate", "source").select("ticker", "asOfDate", "source", *dedupe.YIELDS)


_PRICED = f"""pr as (select *, case when {_K} % 2 = 0 then value end as nav, case when {_K} % 3 = 0 then value + 1 end as price, {_K} as k, event_id as ord2 from events)"""


@query(
    "combined_history",
    f"""with {RATES}, {FOLD}, {_PRICED}, h as (select history.*, coalesce(nav, price) as nav from history join pr on ord = ord2),
spans as (select *, coalesce(lead("asOfDate") over (partition by ticker order by "asOfDate") - 1, "asOfDate") as last from h), days as (select *, unnest(generate_series("asOfDate"::timestamp, last::timestamp, interval 1 day))::date as day from spans)
select ticker, day as "asOfDate", case when day > "asOfDate" then 'gapFiller (' || source || ')' else source end as source, {_YIELDS}, nav from days""",
)
def combined_history(spark, sf_dir):
    return composites.combined_history(_priced(spark, sf_dir), OLDEST, ("7",)).select("ticker", "asOfDate", "source", *dedupe.YIELDS, "nav")


def _priced(spark, sf_dir) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    own = load(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.when(k % 2 == 0, F.col("value")).alias("nav"), F.when(k % 3 == 0, F.col("value") + 1).alias("price"))
    return rates(spark, sf_dir).join(own, "ord")


@query(
    "all_facts",
    f"""with {RATES}, w as (select ticker, "asOfDate", source, {_YIELDS}, ord from rates qualify row_number() over (partition by ticker, "asOfDate"
order by ("oneDayYield" is not null)::int + ("sevenDayYield" is not null)::int + ("thirtyDayYield" is not null)::int desc, timestamp desc, ord) = 1)
select * from w qualify row_number() over (partition by ticker order by "asOfDate" desc) = 1""",
)
def all_facts(spark, sf_dir):
    return composites.all_facts(rates(spark, sf_dir), ["ticker"], "asOfDate", list(dedupe.YIELDS)).drop("timestamp")


@query("rates_latest", f"""with {RATES}, {FOLD} select ticker, max("asOfDate") as "asOfDate", arg_max(source, "asOfDate") as source, arg_max("sevenDayYield", "asOfDate") as "sevenDayYield" from history group by ticker""")
def rates_latest(spark, sf_dir):
    return dedupe.latest(history(spark, sf_dir).select("ticker", "asOfDate", "source", "sevenDayYield"), "ticker", "asOfDate")


@query(
    "facts_widest_newest",
    f"""with {RATES} select ticker, "asOfDate", source, {_YIELDS}, ord from rates qualify row_number() over (partition by ticker, "asOfDate"
order by ("oneDayYield" is not null)::int + ("sevenDayYield" is not null)::int + ("thirtyDayYield" is not null)::int desc, timestamp desc, ord) = 1""",
)
def facts_widest_newest(spark, sf_dir):
    return dedupe.widest_newest(rates(spark, sf_dir), ["ticker", "asOfDate"], list(dedupe.YIELDS)).drop("timestamp")


@query(
    "bank_gap_fill",
    """with days as (select event_type, cast(ts as date) as day, arg_min(value, event_id) as apy from events where day(ts) % 4 <> 1 group by all),
spans as (select *, coalesce(lead(day) over (partition by event_type order by day) - 1, day) as last from days),
filled as (select *, unnest(generate_series(day::timestamp, last::timestamp, interval 1 day))::date as d from spans)
select event_type as "accountType", d as "asOfDate", apy, case when d > day then 'gapFiller' else 'bank' end as source from filled""",
)
def bank_gap_fill(spark, sf_dir):
    rows = load(spark, sf_dir, "events").filter(F.dayofmonth("ts") % 4 != 1)
    rows = rows.select(F.col("event_type").alias("accountType"), F.to_date("ts").alias("asOfDate"), F.col("value").alias("apy"), "event_id", F.lit("bank").alias("source"))
    # one row for each type and day: the least event_id's, combined before the shuffle
    first = rows.groupBy("accountType", "asOfDate", "source").agg(F.min_by("apy", "event_id").alias("apy"))
    return series.gap_filled(first, ["accountType"], "asOfDate", "source", F.lit("gapFiller")).select("accountType", "asOfDate", "apy", "source")


@query(
    "unique_by_merge",
    """with rows as (select user_id, event_type, cast(ts as date) as day, value, event_id, case when event_id % 2 = 1 then 0 else 1 end as src_ord from events)
select user_id, event_type, day, value, event_id from rows qualify row_number() over (partition by user_id, event_type, day order by src_ord, event_id) = 1""",
)
def unique_by_merge(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "value", "event_id")
    new, old = e.filter("event_id % 2 = 1").withColumn("src_ord", F.lit(0)), e.filter("event_id % 2 <> 1").withColumn("src_ord", F.lit(1))
    return dedupe.unique_by(new.unionByName(old), ["user_id", "event_type", "day"], "src_ord", "event_id").drop("src_ord")


@query(
    "uniq_by_first",
    """with rows as (select event_id, case when event_id % 3 = 0 then ' ' else event_type || user_id end as a, case when event_id % 6 = 0 then '' else 'u' || user_id end as b from events),
keyed as (select *, coalesce(nullif(trim(a), ''), nullif(trim(b), '')) as key from rows)
select event_id, a, b from keyed where key is not null qualify row_number() over (partition by key order by event_id) = 1""",
)
def uniq_by_first(spark, sf_dir):
    a = F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.concat("event_type", F.col("user_id").cast("string")))
    b = F.when(F.col("event_id") % 6 == 0, "").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return dedupe.unique_with_fallback(load(spark, sf_dir, "events").select("event_id", a.alias("a"), b.alias("b")), "a", "b", "event_id")


@query(
    "newest_amendment",
    """select o_custkey, o_orderpriority, cast(o_orderdate as date) as filed, o_orderkey from orders
qualify row_number() over (partition by o_custkey, o_orderpriority order by o_orderdate desc, o_orderkey) = 1""",
)
def newest_amendment(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("filed"), "o_orderkey")
    return dedupe.newest_amendment(o, ["o_custkey", "o_orderpriority"], "filed", "o_orderkey")


@query(
    "scd_merge",
    """with o as (select p_partkey, p_size as ratio, date '2024-01-01' + p_size as day from part where p_partkey % 5 <> 0),
n as (select p_partkey, case when p_partkey % 2 = 0 then p_size + 1 else p_size end as ratio, date '2024-01-20' as day from part where p_partkey % 7 <> 0)
select p_partkey, case when n.p_partkey is null or (o.p_partkey is not null and (o.ratio = n.ratio or n.day <= o.day)) then o.ratio else n.ratio end as ratio,
case when n.p_partkey is null or (o.p_partkey is not null and (o.ratio = n.ratio or n.day <= o.day)) then o.day else n.day end as day from o full join n using (p_partkey)""",
)
def scd_merge(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    old = p.filter("p_partkey % 5 <> 0").select("p_partkey", F.col("p_size").alias("ratio"), F.expr("date_add(date '2024-01-01', p_size)").alias("day"))
    new = p.filter("p_partkey % 7 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("ratio"), F.lit("2024-01-20").cast("date").alias("day"))
    return dedupe.merged_changes(old, new, "p_partkey", "ratio", "day")


_TYPES = {"click": "ordinaryIncome", "view": "ltcg", "purchase": "stcg", "signup": "returnOfCapital"}


@query(
    "distribution_pivot",
    "with wide as (select user_id, cast(ts as date) as day, "
    + ", ".join(f"arg_max(value, event_id) filter (event_type = '{k}') as \"{v}\"" for k, v in _TYPES.items())
    + " from events group by all) select *, "
    + rounded(" + ".join(["0.0"] + [f'coalesce("{v}", 0.0)' for v in _TYPES.values()]), 6)
    + " as total from wide",
)
def distribution_pivot(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return pivots.latest_by_type(e, ["user_id", "day"], "event_type", "value", "event_id", _TYPES)


_CODES = {"1DISTYLD": "oneDayYield", "SEC": "sevenDayYield", "30DISTYLD": "thirtyDayYield"}


@query(
    "yield_code_pivot",
    """with rows as (select l_partkey, cast(l_shipdate as date) as day, l_discount as pct, l_orderkey * 1000 + l_linenumber * 100 + l_suppkey % 100 as ord, case when l_returnflag = 'A' then '1DISTYLD' when l_returnflag = 'N' and l_linenumber % 2 = 0 then '30DISTYLD'
 when l_returnflag = 'N' then 'SEC' else 'OTHER' end as code from lineitem where l_linestatus = 'F' or l_linestatus = 'O')
select l_partkey, day, max(pct) filter (code = '1DISTYLD') as "oneDayYield", max(pct) filter (code = 'SEC') as "sevenDayYield", max(pct) filter (code = '30DISTYLD') as "thirtyDayYield"
from rows group by all having count(*) filter (code <> 'OTHER') > 0""",
)
def yield_code_pivot(spark, sf_dir):
    flag, odd = F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    code = F.when(flag == "A", "1DISTYLD").when((flag == "N") & ~odd, "30DISTYLD").when(flag == "N", "SEC").otherwise("OTHER")
    rows = load(spark, sf_dir, "lineitem").filter(F.col("l_linestatus").isin("F", "O")).select("l_partkey", F.to_date("l_shipdate").alias("day"), F.col("l_discount").alias("pct"), code.alias("code"))
    wide = rows.groupBy("l_partkey", "day").agg(*[F.max(F.when(F.col("code") == c, F.col("pct"))).alias(n) for c, n in _CODES.items()])
    return wide.filter(F.coalesce(*_CODES.values()).isNotNull())


_RETURNS = ["A", "N", "R"]


@query(
    "category_share_pivot",
    "with v as (select p_brand, l_returnflag, sum(l_quantity) as x from lineitem join part on l_partkey = p_partkey group by all), t as (select p_brand, "
    + ", ".join(f"coalesce(sum(x) filter (l_returnflag = '{c}'), 0.0) as {c}" for c in _RETURNS)
    + " from v group by p_brand) select p_brand, A + N + R as total, "
    + ", ".join(f"{rounded(f'{c} / (A + N + R)', 5)} as \"{c}\"" for c in _RETURNS)
    + " from t",
)
def category_share_pivot(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return pivots.category_shares(rows, ["p_brand"], "l_returnflag", "l_quantity", _RETURNS)


@query("class_latest_yield", 'select user_id, event_type, max(ts) as "at", arg_max(value, ts) as value from events group by user_id, event_type')
def class_latest_yield(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("ts").alias("at"), F.max_by("value", "ts").alias("value"))


_LABELS = [c for c, _, _ in pivots.categories()]


@query(
    "holdings_report",
    "with cats(i, treatment, name) as (values "
    + ", ".join(f"({i}, '{t}', '{n}')" for i, (_, n, t) in enumerate(pivots.categories()))
    + """), rows as (select l_suppkey as fund, case l_suppkey % 3 when 0 then 'Muni' when 1 then 'Prime' else 'SingleState' end as kind, l_partkey % 21 as i, l_quantity as value from lineitem)
select fund, """
    + rounded("sum(case when treatment = 'USGO' then value else 0.0 end) / sum(value)", 5)
    + ' as "USGO", '
    + rounded("sum(case when treatment = 'exempt' or (name in ('financialCompanyCommercialPaper', 'nonFinancialCompanyCommercialPaper') and kind in ('Muni', 'SingleState')) then value else 0.0 end) / sum(value)", 5)
    + ' as "Muni", sum(value) as total from rows join cats using (i) group by fund',
)
def holdings_report(spark, sf_dir):
    kind = F.when(F.col("l_suppkey") % 3 == 0, "Other Tax Exempt").when(F.col("l_suppkey") % 3 == 1, "Prime").otherwise("Single State")
    label = F.element_at(F.array(*map(F.lit, _LABELS)), (F.col("l_partkey") % len(_LABELS) + 1).cast("int"))
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("fund"), pivots.fund_category(kind).alias("kind"), label.alias("category"), F.col("l_quantity").alias("value"))
    return pivots.holdings_report(rows, "fund", "kind")


@query("semi_anti", """select c_custkey, c_name, 'semi' as kind from customer semi join orders on c_custkey = o_custkey union all
select c_custkey, c_name, 'anti' from customer anti join orders on c_custkey = o_custkey""")
def semi_anti(spark, sf_dir):
    c, o = load(spark, sf_dir, "customer").select("c_custkey", "c_name"), load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.tracked(c, o, ["c_custkey"]).withColumn("kind", F.lit("semi")).union(lookups.missing(c, o, ["c_custkey"]).withColumn("kind", F.lit("anti")))


@query(
    "first_match_lookup",
    """with f as (select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderkey) = 1)
select c_custkey, o_totalprice as first_price from customer left join f on c_custkey = o_custkey""",
)
def first_match_lookup(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_totalprice").alias("first_price"))
    return lookups.first_match(load(spark, sf_dir, "customer").select("c_custkey"), o, ["c_custkey"], "o_orderkey")


@query("anti_append", """with known as (select c_custkey as k, c_name as name from customer where c_custkey % 3 = 0), manual as (select s_suppkey as k, s_name as name from supplier)
select * from known union all select * from manual where k not in (select k from known)""")
def anti_append(spark, sf_dir):
    known = load(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return lookups.with_missing(known, load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), ["k"])


@query(
    "set_ops",
    """with a as (select c_nationkey as n from customer where c_acctbal > 5000), b as (select s_nationkey as n from supplier)
select 'union_all' as op, n, cast(count(*) as bigint) as rows from (select * from a union all select * from b) group by n union all
select 'union', n, 1 from (select * from a union select * from b) union all select 'intersect', n, 1 from (select * from a intersect select * from b) union all
select 'except', n, 1 from (select * from a except select * from b) union all select 'except_all', n, count(*) from (select * from a except all select * from b) group by n""",
)
def set_ops(spark, sf_dir):
    a = load(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("n"))
    b = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"))
    counted = lambda df, op: df.groupBy("n").agg(F.count("*").alias("rows")).select(F.lit(op).alias("op"), "n", "rows")
    once = lambda df, op: df.select(F.lit(op).alias("op"), "n", F.lit(1).cast("long").alias("rows"))
    return counted(a.unionByName(b), "union_all").union(once(a.union(b).distinct(), "union")).union(once(a.intersect(b), "intersect")).union(once(a.subtract(b), "except")).union(counted(a.exceptAll(b), "except_all"))


@query(
    "run_diff",
    """with o as (select o_orderkey, o_orderstatus as status, o_totalprice as price from orders where o_orderkey % 11 <> 0),
n as (select o_orderkey, case when o_orderkey % 13 = 0 then 'X' else o_orderstatus end as status, case when o_orderkey % 17 = 0 then o_totalprice + 1 else o_totalprice end as price from orders where o_orderkey % 7 <> 0),
d as (select o_orderkey, case when o.status is null then 'added' when n.status is null then 'removed' when o.status <> n.status or o.price <> n.price then 'changed' end as kind,
case when o.status is null or n.status is null then '' else concat_ws(',', case when o.status <> n.status then 'status' end, case when o.price <> n.price then 'price' end) end as changed
from o full join n using (o_orderkey)) select o_orderkey, kind as status, changed from d where kind is not null""",
)
def run_diff(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("timestamp"))
    old, new = o.filter("o_orderkey % 11 <> 0"), o.filter("o_orderkey % 7 <> 0")
    new = new.withColumn("status", F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("status"))).withColumn("price", F.when(F.col("o_orderkey") % 17 == 0, F.col("price") + 1).otherwise(F.col("price")))
    return diff.keyed_diff(old, new, ["o_orderkey"])


@query(
    "struct_equal",
    """select cast(sum(greatest(n, 0)) as bigint) as only_first, cast(sum(greatest(-n, 0)) as bigint) as only_second, sum(abs(n)) = 0 as equal from (
select event_id, user_id, event_type, v, sum(s) as n from (select event_id, user_id, event_type, value as v, 1 as s from events union all
select event_id, user_id, event_type, case when event_id % 97 = 0 then value + 1 else value end, -1 from events) group by all)""",
)
def struct_equal(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").alias("timestamp"))
    changed = e.withColumn("value", F.when(F.col("event_id") % 97 == 0, F.col("value") + 1).otherwise(F.col("value"))).withColumn("timestamp", F.expr("timestamp + interval 1 day"))
    return diff.equal_but(e, changed)
