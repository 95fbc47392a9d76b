"""Whole jobs put together from the other operators, on tables as their sources give them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numeric, text
from tidemark.operators import dedupe, series
from tidemark.operators.rows import renamed
from tidemark.shared import free_name
from tidemark.sources import dom
from tidemark.sources.html import attributes


def treasury_prices(rows: DataFrame) -> DataFrame:
    """Daily prices from rows of nine cells (array column cells) and a day; other rows are dropped. Rates and
    prices stay texts of five digits, as the key is built from them."""
    c = lambda i: F.trim(F.get("cells", F.lit(i)))
    fixed = lambda x: numeric.round_fixed(x.try_cast("double"), 5)
    rate = fixed(F.regexp_replace(c(2), "%", "").try_cast("double") / 100)
    maturity = F.try_to_date(c(3), "MM/dd/yyyy")
    return rows.filter(F.size("cells") == 9).select(
        "asOfDate",
        c(0).alias("cusip"),
        c(1).alias("securitytype"),
        rate.alias("rate"),
        maturity.alias("maturitydate"),
        F.try_to_date(F.nullif(c(4), F.lit("")), "MM/dd/yyyy").alias("calldate"),
        c(5).alias("buy"),
        c(6).alias("sell"),
        fixed(c(7)).alias("endofday"),
        F.concat_ws("-", F.date_format(maturity, "yyyy-MM-dd"), rate).alias("key"),
    )


def quotes(rows: DataFrame, cells: int = 7) -> DataFrame:
    """Quotes in 32nds from rows of so many cells: maturity, coupon, bid, asked, change, yield, principal."""
    c = lambda i: F.get("cells", F.lit(i))
    price = lambda x: numeric.from_32nds(numeric.parse_number(x))
    coupon = numeric.parse_number(c(1))
    maturity = F.coalesce(F.try_to_date(c(0), "M/d/yyyy"), F.try_to_date(c(0), "yyyy MMM dd"))
    change = F.when(F.lower(c(4)).startswith("unch"), F.lit(0.0)).otherwise(numeric.parse_number(c(4)))
    shown = F.date_format(maturity, "yyyy-MM-dd")
    return rows.filter(F.size("cells") == cells).select(
        "asOfDate", maturity.alias("maturity"), coupon.alias("coupon"), price(c(2)).alias("bid"), price(c(3)).alias("asked"), change.alias("chg"),
        numeric.parse_number(c(5)).alias("yield"), numeric.parse_number(c(6)).alias("accruedprincipal"), F.concat_ws("-", shown, coupon.cast("string")).alias("key"),
    )


def release_calendar(block: DataFrame, column: str = "text") -> DataFrame:
    """(rlsDate, cpiDate, refcpiDate) from lines that start with an English date: the price index of the month
    before the release counts as reference three months on."""
    lines = block.select(F.explode(F.split(column, "\n")).alias("line"))
    released = dates.from_english(F.regexp_extract("line", r"([A-Z][a-z]{2} \d{2}, \d{4})", 1))
    found = lines.select(released.alias("rlsDate")).filter("rlsDate is not null")
    cpi = dates.first_of_month(F.col("rlsDate"), -1)
    return found.select("rlsDate", cpi.alias("cpiDate"), F.add_months(cpi, 3).alias("refcpiDate"))


def note_metadata(rows: DataFrame) -> DataFrame:
    """Clean security metadata: rates as fractions of five digits, terms in years."""
    return rows.select(
        "cusip",
        numeric.round_fixed(F.col("interest_rate").try_cast("double") / 100, 5).alias("interest_rate"),
        numeric.round_half_up(text.years_of_term(F.col("security_term")), 4).alias("security_term"),
        "series",
        dates.from_iso(F.col("maturity_date")).alias("maturity_date"),
        dates.from_iso(F.col("dated_date")).alias("dated_date"),
        numeric.round_fixed(F.col("ref_cpi_on_dated_date").try_cast("double"), 5, 6).alias("ref_cpi_on_dated_date"),
    )


def filing_rows(submissions: DataFrame, form: str, oldest: str) -> DataFrame:
    """One row for each filing whose form holds the text, from submissions kept as parallel arrays."""
    names = ["accessionNumber", "filingDate", "reportDate", "form", "primaryDocument"]
    each = submissions.select("cik", "fiscalYearEnd", F.explode(F.arrays_zip(*[F.col(f"filings.{n}").alias(n) for n in names])).alias("f")).select("cik", "fiscalYearEnd", "f.*")
    plain = F.regexp_replace("accessionNumber", "-", "")
    url = F.concat_ws("/", F.lit("/data"), F.regexp_replace("cik", "^0+", ""), plain, F.col("primaryDocument"))
    kept = each.filter(F.col("form").contains(form) & (dates.from_iso(F.col("filingDate")) >= F.lit(oldest).cast("date")))
    return kept.select(F.lpad("cik", 10, "0").alias("cik"), "fiscalYearEnd", "accessionNumber", dates.from_iso(F.col("filingDate")).alias("filingDate"), dates.from_iso(F.col("reportDate")).alias("reportDate"), url.alias("url"))


def daily_yields(classes: DataFrame, skip_first: bool = False) -> DataFrame:
    """(ticker, asOfDate, sevenDayYield, nav) from arrays of dated yields and prices of a class; a day without
    a price has one. skip_first leaves out each array's first element, as older results do."""
    some = F.slice("yields", 2, F.greatest(F.size("yields") - 1, F.lit(0))) if skip_first else F.col("yields")
    rows = classes.select("ticker", "navs", F.explode(some).alias("y"))
    nav = F.get(F.filter("navs", lambda n: n["date"] == F.col("y.date")), F.lit(0))["nav"]
    return rows.select("ticker", F.col("y.date").alias("asOfDate"), F.col("y.value").alias("sevenDayYield"), F.coalesce(nav, F.lit(1.0)).alias("nav"))


def fund_metadata(companies: DataFrame, years: DataFrame, expenses: DataFrame) -> DataFrame:
    """Funds with their fiscal year's end and last known expense ratio. Ids are compared at ten digits."""
    ten = lambda c: F.lpad(F.col(c).cast("string"), 10, "0")
    ends = dedupe.first_by(years.select(ten("cik").alias("cikTen"), "fiscalYearEnd"), ["cikTen"], F.col("fiscalYearEnd"))
    ratio = dedupe.latest(expenses.select("ticker", "expenseRatio", "timestamp"), "ticker", "timestamp")
    return companies.withColumn("cikTen", ten("cik")).withColumn("mmName", text.fund_name(F.col("series_name"))).join(ends, "cikTen", "left").join(ratio, "ticker", "left")


def index_links(pages: DataFrame, html: str, prefix: str, base: str) -> DataFrame:
    """(url): the addresses of index pages that pages link to, once each."""
    keyed = pages.select(F.xxhash64(html).alias("page"), html)
    return attributes(keyed, "page", html, "a", "href").filter(F.col("value").startswith(prefix)).select(F.concat(F.lit(base), "value").alias("url")).distinct()


def index_pages(pages: DataFrame, as_of: str) -> DataFrame:
    """The rows of index_snapshot() from index pages (url, html) that name the date, with their address: the heading, and what
    follows the labels (P18). Pages without a heading or a ticker are left out (C21)."""
    found = dom.nodes(pages.select("url", "html"), "html", apart=True).filter(F.col("text").contains(as_of))
    after = lambda label, value: F.nullif(F.regexp_extract("text", f"{label}\\s*({value})", 1), F.lit(""))
    rows = found.select(dom.Page().element("h1").alias("index_name"), after("Price Return Ticker", "[A-Z0-9]+").alias("price_ticker"), after("Number of Companies", r"[\d,]+").alias("num_companies"), after(r"Index Market Cap \(\$M\)", r"\$[\d,]+").alias("market_cap"), F.lit(as_of).alias("as_of"), "url")
    return index_snapshot(rows.filter("index_name is not null and price_ticker is not null"), "url")


def savings_rates(accounts: DataFrame, kind: str, source: str) -> DataFrame:
    """Yields of the accounts of one kind (P31), as fractions to four digits, under the source's name (P23), by account and
    day with missing days first (O2)."""
    kept = accounts.filter(F.col("account_type") == kind)
    return kept.select(F.col("account_name").alias("accountType"), numeric.round_half_up(F.col("value") / 100, 4).alias("apy"), F.col("date").alias("asOfDate"), F.lit(source).alias("source")).orderBy("accountType", F.asc_nulls_first("asOfDate"))


def index_snapshot(rows: DataFrame, *more: str) -> DataFrame:
    """Indexes with market caps from millions, largest first, and further columns."""
    cap = numeric.parse_money(F.col("market_cap"))
    out = rows.select("index_name", "price_ticker", F.regexp_replace("num_companies", ",", "").try_cast("bigint").alias("num_companies"), cap.alias("market_cap_musd"), numeric.round_half_up(cap / 1000, 3).alias("market_cap_busd"), dates.from_english(F.col("as_of")).alias("as_of_date"), *more)
    return out.orderBy(F.desc_nulls_last("market_cap_musd"), "index_name")


def judgments(cases: DataFrame) -> DataFrame:
    """Court cases once each, with the distinct amounts of their texts and the sum."""
    once = dedupe.unique_with_fallback(cases, "caseNumber", "detailUrl", "ord")
    amounts = F.array_distinct(text.money_mentions(F.col("detail")))
    total = F.aggregate(F.col("amounts"), F.lit(0.0), lambda a, x: a + numeric.parse_money(x))
    return once.withColumn("amounts", amounts).select("caseNumber", "detailUrl", F.array_join("amounts", " | ").alias("judgmentAmounts"), F.when(F.size("amounts") > 0, numeric.round_half_up(total, 2)).alias("judgmentTotal"))


def running_balance(cells: DataFrame, key: str, pos: str, label: str, amount: str) -> DataFrame:
    """(key, total): the amounts of the rows before the first one labelled Total."""
    end = cells.filter(F.col(label) == "Total").groupBy(key).agg(F.min(pos).alias("__end"))
    before = cells.join(end, key, "left").filter(F.col("__end").isNull() | (F.col(pos) < F.col("__end")))
    return before.groupBy(key).agg(numeric.round_half_up(F.sum(numeric.parse_money(F.col(amount))), 2).alias("total"))


def consolidated(lists: list[DataFrame], column: str) -> DataFrame:
    """One list of names from several, once each."""
    out = lists[0].select(F.upper(F.trim(column)).alias(column))
    for more in lists[1:]:
        out = out.union(more.select(F.upper(F.trim(column)).alias(column)))
    return out.filter(F.col(column) != "").distinct()


def offers_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Offers once for each supplier, term and day; new ones win."""
    src = free_name(new, "src", old)
    marked = new.withColumn(src, F.lit(0)).unionByName(old.withColumn(src, F.lit(1)), allowMissingColumns=True)
    return dedupe.first_by(marked, ["supplier", "term", "asOfDate"], F.col(src).asc(), F.col("rate").asc_nulls_last(), F.col("url").asc_nulls_last()).drop(src)


def query_url(base: str, **parts: Column) -> Column:
    """A URL whose query has the encoded parts."""
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in parts.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *pairs))


def payload_prices(payloads: DataFrame) -> DataFrame:
    """(day, price) of price payloads in either shape: an array of quotes, or timestamps and closes."""
    a = payloads.select(F.explode("quotes").alias("q")).select(dates.from_epoch(F.col("q.date")).alias("at"), F.col("q.close").alias("price"))
    b = payloads.select(F.explode(F.arrays_zip("timestamp", "close")).alias("q")).select(dates.from_epoch(F.col("q.timestamp")).alias("at"), F.col("q.close").alias("price"))
    return a.union(b).filter("price is not null").select(F.to_date("at").alias("day"), "price")


def payload_dividends(payloads: DataFrame) -> DataFrame:
    """(day, amount) of dividend payloads in either shape: `dividends`, an array of structs of date (ISO text) and amount, or
    `by_time`, a map by epoch of structs whose date or timestamp may be missing and whose amount may be named
    dividends or dividend. What has no day or no finite amount is dropped."""
    finite = lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    a = payloads.select(F.explode("dividends").alias("d")).select(dates.from_iso(F.col("d.date")).alias("day"), finite(F.col("d.amount").try_cast("double")).alias("amount"))
    b = payloads.select(F.explode("by_time").alias("at", "d"))
    epoch = F.coalesce("d.date", "d.timestamp", F.col("at").try_cast("long"))
    b = b.select(F.to_date(dates.from_epoch(epoch)).alias("day"), finite(F.coalesce(*[F.col(f"d.{c}").try_cast("double") for c in ("amount", "dividends", "dividend")])).alias("amount"))
    return a.union(b).filter("day is not null and amount is not null")


def without_last(rows: Column) -> Column:
    """An array without its last element."""
    return F.slice(rows, 1, F.greatest(F.size(rows) - 1, F.lit(0)))


def combined_history(rates: DataFrame, oldest: str, dropped: tuple[str, ...] = ()) -> DataFrame:
    """The yield history of each ticker (C1): trusted rates of all sources, the best source of each day, its price
    under the name nav where it has no nav, and days between filled with the day before."""
    best = dedupe.best_source(dedupe.trusted_rates(rates, oldest, dropped)).drop("timestamp", "priority", "ord")
    return series.gap_filled(renamed(best, "price", "nav"), ["ticker"], "asOfDate", "source")


def all_facts(facts: DataFrame, keys: list[str], day: str, counted: list[str]) -> DataFrame:
    """The newest facts of each key (C3): of each day the row with most values and then the latest, of these
    the last day's."""
    return dedupe.first_by(dedupe.widest_newest(facts, [*keys, day], counted), keys, F.col(day).desc())
