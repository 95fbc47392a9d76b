"""Queries on monthly and daily series: factors, back-tests, interpolation, returns, fiscal years. The
orders table's monthly mean price stands for a price index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.numeric import round_fixed, round_half_up
from tidemark.operators import fiscal, pivots, series, stats
from tidemark.plans.catalog import load, query, rounded
from tidemark.shared import cut_lineage

YEAR = 2023
_INDEX = """idx as (select date_trunc('month', o_orderdate)::date as day, avg(cast(o_totalprice as decimal(18, 2))::double) as sa0, sum(cast(o_totalprice as decimal(18, 2))) as s, count(*) as n from orders group by 1)"""
MONTHLY = f"""months as (select date_trunc('month', o_orderdate)::date as day, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) / count(*) as nsa,
  cast(sum(cast(l_q as decimal(18, 2))) as double) / count(*) as sa from (select o_orderdate, o_totalprice, coalesce(q, 0) + 1000 as l_q from orders left join (select l_orderkey, sum(l_quantity) as q from lineitem group by 1) on l_orderkey = o_orderkey) group by 1),
factors as (select day, year(day)::int as year, month(day)::int as m, ((month(day) + 2) % 12 + 1)::int as month, {rounded("100 * nsa / sa", 3)} as factor from months)"""


def index(spark, sf_dir: str) -> DataFrame:
    """(day, nsa, sa): months, with means of exact decimal sums."""
    exact = lambda c: F.col(c).cast("decimal(18,2)")
    q = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    o = load(spark, sf_dir, "orders").join(q, F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumn("lq", F.coalesce("q", F.lit(0.0)) + 1000)
    mean = lambda c: F.sum(exact(c)).cast("double") / F.count("*")
    return o.groupBy(F.trunc("o_orderdate", "MM").alias("day")).agg(mean("o_totalprice").alias("nsa"), mean("lq").alias("sa"))


def factors(spark, sf_dir: str) -> DataFrame:
    month = F.month("day")
    return index(spark, sf_dir).select("day", F.year("day").alias("year"), series.shifted_month(month).alias("month"), round_half_up(100 * F.col("nsa") / F.col("sa"), 3).alias("factor"))


def _mean(x: str = "factor") -> str:
    """Mean over exact decimals, whatever the order of the rows."""
    return f"cast(sum(cast({x} as decimal(18, 3))) as double) / count(*)"


def _exact(df: DataFrame) -> DataFrame:
    return df.withColumn("factor", F.col("factor").cast("decimal(18,3)"))


@query("monthly_factor", f"""with {MONTHLY} select month, {rounded(_mean(), 4)} as factor, min(day) as "startDate", max(day) as "endDate", count(*) as "entriesTested" from factors group by month""")
def monthly_factor(spark, sf_dir):
    f = factors(spark, sf_dir).withColumn("exact", F.col("factor").cast("decimal(18,3)"))
    mean = F.sum("exact").cast("double") / F.count("*")
    return f.groupBy("month").agg(round_half_up(mean, 4).alias("factor"), F.min("day").alias("startDate"), F.max("day").alias("endDate"), F.count("*").alias("entriesTested"))


_TRIMMED = "cast(sum(cast(factor as decimal(18, 3))) - min(cast(factor as decimal(18, 3))) - max(cast(factor as decimal(18, 3))) as double) / (count(*) - 2)"
_LEVEL = rounded("factor * (1200.0::double / sum(factor) over ())", 3)


@query("trimmed_factor", f"""with {MONTHLY}, t as (select month, {rounded(_TRIMMED, 4)} as factor, min(day) as "startDate", max(day) as "endDate", count(*) - 2 as "entriesTested" from factors group by month)
select month, {rounded(_LEVEL, 2)} as factor, "startDate", "endDate", "entriesTested" from t""")
def trimmed_factor(spark, sf_dir):
    f = factors(spark, sf_dir)
    means = stats.monthly_means(_exact(f), [], "month", "factor", trim=True)
    return stats.level_set(means.withColumn("factor", F.col("factor").cast("double")), [], "factor").withColumn("factor", round_half_up(F.col("factor"), 2))


@query(
    "factor_delta_15th",
    f"""with {MONTHLY}, p as (select month, {rounded(_mean(), 4)} as factor from factors group by month),
d as (select *, {rounded(f"(coalesce(lead(factor) over (order by month), first(factor) over (order by month)) - factor) / day(last_day(make_date({YEAR}, month, 1)))", 3)} as "dailyDelta" from p)
select *, {rounded('factor + 14 * "dailyDelta"', 3)} as factor15th from d""",
)
def factor_delta_15th(spark, sf_dir):
    return series.mid_month(monthly_factor(spark, sf_dir).select("month", "factor"), [], "month", "factor", YEAR)


_TARGETS = "targets as (select distinct year as target from factors where year >= (select min(year) from factors) + 2)"


@query(
    "backtest_errors",
    f"""with {MONTHLY}, {_TARGETS}, p as (select target, month, avg(factor) as predicted from targets join factors on year between target - 2 and target - 1 group by all),
e as (select target, month, predicted, factor as actual, predicted - factor as error from p join factors using (month) where year = target)
select target, count(*) as months, {rounded("avg(abs(error))", 4)} as mae, {rounded("sqrt(avg(error * error))", 4)} as rmse, {rounded("avg(error)", 4)} as bias from e group by target""",
)
def backtest_errors(spark, sf_dir):
    e = stats.backtest(factors(spark, sf_dir).select("year", "month", "factor"), 2)
    r = lambda c: round_half_up(c, 4)
    return e.groupBy("target").agg(F.count("*").alias("months"), r(F.avg(F.abs("error"))).alias("mae"), r(F.sqrt(F.avg(F.col("error") * F.col("error")))).alias("rmse"), r(F.avg("error")).alias("bias"))


def _ranking(years: int, trim: bool) -> str:
    mean = "case when count(*) > 2 then (sum(factor) - min(factor) - max(factor)) / (count(*) - 2) else avg(factor) end" if trim else "avg(factor)"
    level = rounded("p0 * (1200.0::double / sum(p0) over (partition by target))", 3) if trim else "p0"
    return f"""(with t as (select distinct year as target from factors where year >= (select min(year) from factors) + {years}),
p as (select *, {level} as predicted from (select target, month, {mean} as p0 from t join factors on year between target - {years} and target - 1 group by all)),
e as (select target, month, predicted, factor as actual from p join factors using (month) where year = target),
s as (select *, abs(predicted / avg(predicted) over (partition by target) - actual / avg(actual) over (partition by target)) as shape, case when target >= 2000 then 2 else 1 end as w from e)
select {years} as years, {str(trim).lower()} as trimmed, count(*) as months, {rounded("avg(abs(predicted - actual))", 3)} as mae, {rounded("sum(w * abs(predicted - actual)) / sum(w)", 3)} as weighted_mae,
{rounded("sqrt(avg((predicted - actual) * (predicted - actual)))", 3)} as rmse, {rounded("100 * avg(shape)", 3)} as shape_pct from s)"""


_SETS = [(1, False), (2, False), (3, False), (3, True)]


@query("factor_ranking", f"with {MONTHLY} " + " union all ".join(f"select * from {_ranking(*s)}" for s in _SETS))
def factor_ranking(spark, sf_dir):
    f = cut_lineage(factors(spark, sf_dir).select("year", "month", "factor"))  # the tables are read once for all sets
    out = None
    for years, trim in _SETS:
        m = stats.error_metrics(stats.backtest(f, years, trim), [], 2000)
        r = lambda c, n, k=1: round_half_up(k * F.col(c), 3).alias(n)
        row = m.select(F.lit(years).alias("years"), F.lit(trim).alias("trimmed"), F.col("monthsCompared").alias("months"), r("overallMae", "mae"), r("weightedMae", "weighted_mae"), r("overallRmse", "rmse"), r("overallShapeMae", "shape_pct", 100))
        out = row if out is None else out.union(row)
    return out


@query(
    "forecast_horizon",
    f"""with {MONTHLY}, o(origin) as (values (1996), (1997), (1998)), p as (select origin, month, avg(factor) as predicted from o join factors on year between origin - 1 and origin group by all),
h as (select origin, h.horizon, p.month, predicted, factor as actual from p cross join (values (1), (2)) h(horizon) join factors f on f.year = origin + h.horizon and f.month = p.month),
s as (select *, abs(predicted / avg(predicted) over w - actual / avg(actual) over w) as shape from h window w as (partition by origin, horizon))
select origin, horizon, {rounded("100 * avg(shape)", 3)} as shape_pct from s group by all""",
)
def forecast_horizon(spark, sf_dir):
    e = stats.forecast_errors(factors(spark, sf_dir).select("year", "month", "factor"), 2, [1996, 1997, 1998], [1, 2])
    return e.select("origin", "horizon", round_half_up(100 * F.col("shape_mae"), 3).alias("shape_pct"))


@query(
    "interp_daily",
    f"""with {MONTHLY}, m as (select (day + interval 3 month)::date as d, nsa, lead((day + interval 3 month)::date) over (order by day) as d2, lead(nsa) over (order by day) as nsa2 from months),
s as (select d, nsa, coalesce({rounded("(nsa2 - nsa) / (d2 - d)", 6)}, 0) as step, coalesce(d2 - d, 1) as n from m),
e as (select *, unnest(range(n)) as j from s) select (d + cast(j as int)) as day, printf('%.6f', {rounded("nsa + step * j", 5)}) as value from e""",
)
def interp_daily(spark, sf_dir):
    days = series.interpolated(index(spark, sf_dir).select("day", "nsa"), [], "day", "nsa")
    return days.select("day", round_fixed(F.col("value"), 5, 6).alias("value"))


@query(
    "total_return",
    f"""with p as (select cast(ts as date) as day, user_id as k, cast(sum(cast(value as decimal(18, 4))) as double) / count(*) as price from events where event_type <> 'purchase' group by all),
d as (select cast(ts as date) as paid, user_id as k, cast(sum(cast(value as decimal(18, 4))) as double) / 100 as amount from events where event_type = 'purchase' group by all),
r as (select d.k, p.day, amount from d asof left join p on d.k = p.k and d.paid <= p.day), a as (select k, day, cast(sum(cast(amount as decimal(18, 6))) as double) as amount from r where day is not null group by all),
j as (select p.k, p.day, price, coalesce(amount, 0) as amount, lag(price) over (partition by p.k order by p.day) as before from p left join a on a.k = p.k and a.day = p.day)
select k, day, {rounded("price", 4)} as price, {rounded("amount", 4)} as distribution, {rounded("product(case when before > 0 then (price + amount) / before else 1.0 end) over (partition by k order by day rows unbounded preceding) * 10000.0::double", 2)} as growth from j""",
)
def total_return(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("user_id").alias("k"), F.col("value").cast("decimal(18,4)").alias("v"), "event_type")
    total = F.sum("v").cast("double")
    prices = e.filter("event_type <> 'purchase'").groupBy("k", "day").agg((total / F.count("*")).alias("price"))
    paid = e.filter("event_type = 'purchase'").groupBy("k", "day").agg((total / 100).cast("decimal(18,6)").alias("amount"))
    return series.total_return(prices, paid.withColumn("amount", F.col("amount").cast("double")), ["k"])


for _roll in ("next", "prev"):

    def _asof(spark, sf_dir, roll=_roll):
        e = load(spark, sf_dir, "events")
        return series.asof(e.select("user_id", F.col("ts").alias("at"), "event_id"), e.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought")), ["user_id"], "at", "bought", roll)

    query(
        f"asof_{_roll}",
        f"""with r as (select user_id, ts as bought from events where event_type = 'purchase')
select l.user_id, l.ts as "at", event_id, r.bought from events l asof left join r on l.user_id = r.user_id and l.ts {"<=" if _roll == "next" else ">="} r.bought""",
    )(_asof)


@query(
    "asof_any_key",
    """with r as (select distinct o_orderdate::date as ordered from orders where o_orderstatus = 'P')
select l_orderkey, l_linenumber, l_shipdate::date as shipped, r.ordered from lineitem l asof left join r on l.l_shipdate::date >= r.ordered""",
)
def asof_any_key(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"))
    days = load(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.to_date("o_orderdate").alias("ordered"))
    return series.asof(lines, days, [], "shipped", "ordered", "prev")


_FISCAL = """rows as (select o_custkey % 50 as fund, year(o_orderdate)::int as year, month(o_orderdate)::int as month, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as assets, (sum(o_orderkey) % 1000)::double / 1000 as share from orders group by all),
f as (select *, (fund % 12 + 1)::int as q4, year + case when month > fund % 12 + 1 then 1 else 0 end as fiscal_year from rows),
q as (select fund, fiscal_year, q4 as q4_month, """ + ", ".join(f"max(case when month = (q4 + {3 * i} - 1) % 12 + 1 then share end) as q{i}" for i in range(1, 5)) + " from f group by all)"


def _funds(spark, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("fund"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    rows = o.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("assets"), ((F.sum("o_orderkey") % 1000).cast("double") / 1000).alias("share"))
    return rows.withColumn("year_end", F.format_string("%02d31", (F.col("fund") % 12 + 1).cast("int")))


@query("fiscal_quarters", f"with {_FISCAL} select fund, fiscal_year, q1, q2, q3, q4 from (select fund, fiscal_year, q1, q2, q3, q4 from q)")
def fiscal_quarters(spark, sf_dir):
    return fiscal.quarters(_funds(spark, sf_dir), "fund", "share")


def _low(c: str) -> str:
    return f"coalesce({c} < 0.5, false)"


@query(
    "fifty_pct_rule",
    f"""with {_FISCAL} select a.fund, a.fiscal_year, coalesce(a.q1, a.q2, a.q3, a.q4) is not null and not ({" or ".join(_low(f"a.q{i}") for i in range(1, 5))})
and not ({" or ".join(f"({_low(f'b.q{i}')} and a.q4_month + {3 * i} <= 12)" for i in range(1, 5))}) as passes from q a left join q b on a.fund = b.fund and b.fiscal_year = a.fiscal_year + 1""",
)
def fifty_pct_rule(spark, sf_dir):
    q = fiscal.quarters(_funds(spark, sf_dir), "fund", "share").withColumn("q4_month", (F.col("fund") % 12 + 1).cast("int"))
    return fiscal.fifty_percent_rule(q, "fund")


_PASSED = " or ".join(f"({_low(f'b.q{i}')} and y.q4_month + {3 * i} <= 12)" for i in range(1, 5))
_SEEN = [f"case when y.months >= (y.q4_month + {3 * i} - 1) % 12 + 1 or p.months is not null then a.q{i} end" for i in range(1, 5)]


@query(
    "taxation",
    f"""with {_FISCAL}, y as (select fund, year, max(q4) as q4_month, count(*) as months, {rounded("sum(share * assets) / sum(assets)", 5)} as usgo, {rounded("sum((1 - share) / 2 * assets) / sum(assets)", 5)} as muni from f group by 1, 2),
j as (select y.fund, y.year, y.months, y.usgo, y.muni, a.q1, a.q2, a.q3, a.q4,
case when y.months = 12 then not ({" or ".join(_low(f"a.q{i}") for i in range(1, 5))}) and not ({_PASSED})
else not ({" or ".join(_low(x) for x in _SEEN)}) and coalesce({", ".join(_SEEN)}) is not null end as passes,
case when y.months = 12 then case when a.q1 is null or a.q2 is null or a.q3 is null or a.q4 is null then 'incomplete' else 'complete' end when p.months = 12 then 'current-year' else 'incomplete' end as history,
case when y.months = 12 then 'complete' else 'YTD' end as estimate
from y left join q a on a.fund = y.fund and a.fiscal_year = y.year left join q b on b.fund = y.fund and b.fiscal_year = y.year + 1 left join y p on p.fund = y.fund and p.year = y.year - 1)
select * from j union all select * replace (2002 as year, 'new-year-placeholder' as estimate) from j where year = 2001 and fund not in (select fund from j where year = 2002)""",
)
def taxation(spark, sf_dir):
    funds = _funds(spark, sf_dir).withColumnRenamed("share", "usgo").withColumn("muni", (1 - F.col("usgo")) / 2)
    return fiscal.taxation(funds, "fund", 2002)


@query(
    "year_placeholder",
    """with y as (select o_custkey as ticker, year(o_orderdate)::int as year, count(*) as months, 'complete' as estimate from orders group by all)
select * from y union all select ticker, 2001, months, 'new-year-placeholder' from y where year = 2000 and ticker not in (select ticker from y where year = 2001)""",
)
def year_placeholder(spark, sf_dir):
    y = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("months")).withColumn("estimate", F.lit("complete"))
    return fiscal.with_placeholder(y, "ticker", 2001)


@query(
    "yearly_weighted",
    f"""with {_FISCAL} select fund, year, count(*) as months, {rounded("cast(sum(cast(share * assets as decimal(28, 4))) as double) / cast(sum(cast(assets as decimal(28, 4))) as double)", 5)} as share from rows group by all""",
)
def yearly_weighted(spark, sf_dir):
    rows = _funds(spark, sf_dir)
    return pivots.yearly_weighted(rows, ["fund", "year"], ["share"], "assets").drop("assets")


@query("trailing_window", f"with {MONTHLY} select day, {rounded('nsa', 4)} as nsa from months where day > (select max(day) from months) - interval 24 month")
def trailing_window(spark, sf_dir):
    return series.trailing_months(index(spark, sf_dir), "day", 2).select("day", round_half_up(F.col("nsa"), 4).alias("nsa"))


@query("last_full_year", "select max(case when month(o_orderdate) = 12 then year(o_orderdate) end)::int as last_full_year from orders")
def last_full_year(spark, sf_dir):
    return series.last_full_year(load(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "date_formats",
    """select o_orderkey, strftime(d, '%-m/%-d/%Y') as us, strftime(d, '%Y-%m-%d') as iso, d + 1 as plus_one, (date_trunc('month', d) + interval 3 month)::date as quarter, ((date_trunc('month', d) + interval 1 month)::date + (day(d) - 1)::int) as rolled,
isodow(d) in (6, 7) as weekend, month(d) = 12 and day(d) = 31 as year_end, strptime(strftime(d, '%m-%d-%Y'), '%m-%d-%Y')::date as back, (d - date '1995-01-01')::double as days
from (select o_orderkey, o_orderdate::date as d from orders)""",
)
def date_formats(spark, sf_dir):
    d = F.col("d")
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select(
        "o_orderkey",
        dates.us_text(d).alias("us"),
        F.date_format(d, "yyyy-MM-dd").alias("iso"),
        F.date_add(d, 1).alias("plus_one"),
        dates.first_of_month(d, 3).alias("quarter"),
        dates.add_months_rolling(d, 1).alias("rolled"),
        dates.is_weekend(d).alias("weekend"),
        dates.is_year_end(d).alias("year_end"),
        dates.from_us(F.date_format(d, "MMddyyyy")).alias("back"),
        dates.days_between(F.lit("1995-01-01").cast("timestamp"), d.cast("timestamp")).alias("days"),
    )


@query("topk_oldest", "select o_orderkey, o_orderdate::date as day from orders order by o_orderdate, o_orderkey limit 10")
def topk_oldest(spark, sf_dir):
    return load(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(10).select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "schedule_gate",
    """select event_id, not ((isodow(ts) = 6 and hour(ts) > 9) or isodow(ts) = 7 or (isodow(ts) = 1 and hour(ts) < 12)) as weekend_ok,
(ts - before >= interval 20 hour or isodow(ts) <> isodow(before)) and hour(ts) >= 5 as fresh_ok from (select event_id, ts, ts - to_hours((event_id % 40)::int) as before from events)""",
)
def schedule_gate(spark, sf_dir):
    before = F.expr("ts - make_interval(0, 0, 0, 0, cast(event_id % 40 as int), 0, 0)")
    return load(spark, sf_dir, "events").select("event_id", dates.weekend_gate(F.col("ts")).alias("weekend_ok"), dates.freshness_gate(F.col("ts"), before, 20, night_hour=5).alias("fresh_ok"))
