"""Text columns: ordered rewrite rules, facts near labels, parsing helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import parse_number, parse_percent

# Ordered rules: pattern, replacement, and whether all matches are rewritten or the first only.
# Rules of addresses, in order.
ADDRESS_RULES = (
    (' $', '', False),
    ('  ', ' ', True),
    ('\\n+', '\n', True),
    (', PA', ' PA', False),
    (', NJ', ' NJ', False),
    ('BLACK HAWK', 'BLACKHAWK', False),
    ('773 PENNSYLVANIA 183', '773 RT 183', False),
    ('773 ROUTE 183 S', '773 RT 183', False),
    ('773 S ROUTE 183', '773 RT 183', False),
    ('773 S RT 183', '773 RT 183', False),
    (' COVE', ' CV', False),
    (' DRIVE', ' DR', False),
    (' ROAD', ' RD', False),
    (' STREET', ' ST', False),
)
# Rules of owner names, in order.
NAME_RULES = (
    (' $', '', False),
    ('  ', ' ', True),
    (', LLC', ' LLC', True),
    (',LLC', ' LLC', True),
    ('LLC,$', 'LLC', False),
    (', INC', ' INC', True),
    (',INC', ' INC', True),
    ('INC\\.$', 'INC', False),
    ('INC,', 'INC', False),
    ('\\.$', '', False),
    ('^LANDS EDGE ENT$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LANDS EDGE ENT INC$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LANDS EDGE ENTER$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LANDS EDGE ENTER INC$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LANDS EDGE ENTERPRISES$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LANDS EDGW ENTER INC$', 'LANDS EDGE ENTERPRISES INC', False),
    ('^LAKE WYNONAH MUNI AUTH$', 'PCMA', False),
    ('^LAKE WYNONAH MUNICIPAL AUTHY$', 'PCMA', False),
    ('^LAKE WYNONAH UTILITIES INC$', 'PCMA', False),
    ('^LKAE WYNONAH MUNICIPAL AUTHY$', 'PCMA', False),
    ('^PLUM CREEK MUNICIPAL AUTHY$', 'PCMA', False),
    ('^LAKE WYNONAH PROP OWNRS ASN IN$', 'LWPOA', False),
    ('^LAKE WYNONAH PROP OWNERS ASSN$', 'LWPOA', False),
    ('^LAKE WYNONAH PROP OWNERS ASSO$', 'LWPOA', False),
    ('^LAKE WYNONAH PROP OWNERS INC$', 'LWPOA', False),
    ('^LAKE WYNONAH PROPERTY OWNERS$', 'LWPOA', False),
    ('^LAKE WYNONAH PRPTY OWNRS ASSN$', 'LWPOA', False),
    ('^LAKE WYNONAH P O ASSOC$', 'LWPOA', False),
    ('^LAKE WYNONAH UTIL INC$', 'LAKE WYNONAH UTILITIES INC', False),
    ('^LAKE WYNONAH UTILITIS INC$', 'LAKE WYNONAH UTILITIES INC', False),
    (' N A$', ' NA', False),
    ('^THE BANK OF', 'BANK OF', False),
    ("NAT'L ", 'NATL ', False),
    ('SECRETARY ', 'SEC ', False),
    ('SEC\\. ', 'SEC ', True),
    ('SECRETARY FO ', 'SEC OF ', True),
    ('SEC FO ', 'SEC OF ', True),
    ('HOUSING AND$', 'HUD', False),
    ('HOUSING &$', 'HUD', False),
    ('HOUSING & URBAN DEVL$', 'HUD', False),
    ('HOUSING AND URBAN DEVL$', 'HUD', False),
    ('HOUSING & URBAN$', 'HUD', False),
    ('HOUSING AND URBAN$', 'HUD', False),
    ('AND SONS', '& SONS', True),
    (' AND ', ' & ', True),
    ('J M A C', 'JMAC', True),
    ('  ', ' ', True),
    (' $', '', False),
)
# Rules of fund names, in order.
FUND_RULES = (
    (' Fund$', '', False),
    ('® ', ' ', False),
    ('™', '', False),
    (' - ', ' ', False),
    ('Etf', 'ETF', False),
    ('etf', 'ETF', False),
    ('Money Market', 'MM', False),
    ('Money Fund', 'MM', False),
    ('Fidelity Investments Money Market', 'FIMM', False),
    (' MM Fund', ' MM', False),
    (' Investor Shares', ' Investor', False),
    (' Premium Class', ' Premium', False),
    ('U\\.S\\. ', 'US ', False),
    ('U\\.S ', 'US ', False),
    ('U\\.s ', 'US ', False),
    ('U\\.s\\. ', 'US ', False),
)
# Facts of a fund's page with their labels, and what their numbers are.
FACTS = (
    ("expenseRatio", ("Expense Ratio",), "percent"),
    ("weightedAverageCoupon", ("Weighted Average Coupon", "Weighted Avg Coupon"), "number"),
    ("durationYears", ("Effective Duration", "Duration"), "number"),
    ("yieldToWorst", ("Weighted Avg YTM", "Average Yield to Maturity"), "percent"),
    ("maturityYears", ("Weighted Average Maturity", "Weighted Avg Maturity"), "number"),
    ("twelveMonTrlYield", ("12m Trailing Yield",), "percent"),
    ("aum", ("Assets Under Management", "Total Net Assets", "Net Assets", "AUM"), "number"),
)
#: Characters after a label in which its number is sought.
REACH = 200


def rewritten(text: Column, rules: tuple[tuple[str, str, bool], ...]) -> Column:
    """The rules, one after another."""
    for pattern, new, every in rules:
        if every or pattern.endswith("$") or pattern.startswith("^"):
            text = F.regexp_replace(text, pattern, new)
        else:  # only the first match: all before it stays
            text = F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", f"$1{new}")
    return text


def normalized_name(text: Column) -> Column:
    return rewritten(F.upper(F.trim(text)), NAME_RULES)


def normalized_address(text: Column) -> Column:
    return rewritten(F.upper(F.trim(text)), ADDRESS_RULES)


def fund_name(text: Column) -> Column:
    return rewritten(title_case(text), FUND_RULES)


def title_case(text: Column) -> Column:
    return F.initcap(F.lower(text))


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " "))


def names_list(text: Column) -> Column:
    """The names of a text separated by semicolons."""
    return F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def without_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]*>", "")


def parcel(text: Column) -> Column:
    """A parcel number as <map>-<block>-<lot>.<unit>, from what follows the last "Mblu:" with slashes between; null if
    one of the four is missing or empty."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "(?s)^.*Mblu:", ""), r"\s", ""), "/$", "")
    p = F.split(F.replace(bare, F.lit("/"), F.lit("-")), "-")
    whole = (F.size(p) >= 4) & F.forall(F.slice(p, 1, 4), lambda x: x != "")
    return F.when(whole, F.concat(F.get(p, 0), F.lit("-"), F.get(p, 1), F.lit("-"), F.get(p, 2), F.lit("."), F.get(p, 3)))


def header_key(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[\s*]+", ""))


def years_of_term(text: Column) -> Column:
    """'9-Year 6-Month' is 9.5."""
    part = lambda unit: F.coalesce(F.regexp_extract(text, rf"(\d+)-{unit}", 1).try_cast("double"), F.lit(0.0))
    return part("Year") + part("Month") / 12


def money_mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\$[0-9][0-9,]*(?:\.[0-9]{2})?"), F.lit(0))


def percent_near(text: Column, anchor: str, reach: int = 250) -> Column:
    """The first percentage within reach of the anchor's first place."""
    at = F.instr(text, anchor)
    around = F.substring(text, F.greatest(at - reach, F.lit(1)), F.lit(2 * reach) + len(anchor))
    return F.when(at > 0, F.regexp_extract(around, r"([0-9]+(?:\.[0-9]+)?)\s*%", 1).try_cast("double"))


def after_label(text: Column, labels: tuple[str, ...]) -> Column:
    """What follows the first of these labels, up to REACH characters; empty if there is none."""
    return F.regexp_extract(text, "(?i)(?:" + "|".join(map(re.escape, labels)) + f")(.{{0,{REACH}}})", 1)


def fund_facts(text: Column, title: Column) -> dict[str, Column]:
    """Facts of a fund's page: of each row of FACTS, the first number after the label (the first with a per
    cent sign, as a fraction, where it is a percentage); the price after "NAV as of", with a dollar sign or
    decimals; and the name, which stands before a bar and the ticker in the title."""
    page = collapsed(text)
    number = r"\d[\d,]*(?:\.\d+)?"

    def fact(labels: tuple[str, ...], kind: str) -> Column:
        rest = after_label(page, labels)
        if kind == "percent":
            return parse_percent(F.regexp_extract(rest, number + r"\s?%", 0))
        return parse_number(F.regexp_extract(rest, number, 0))

    quoted = after_label(page, ("NAV as of",))
    price = F.coalesce(*[parse_number(F.nullif(F.regexp_extract(quoted, p, 1), F.lit(""))) for p in (rf"\$({number})", r"(\d[\d,]*\.\d+)(?![\d%])")])
    parts = F.split(collapsed(title), r"\s*\|\s*", 2)
    name = F.when((F.size(parts) == 2) & F.get(parts, 1).rlike(r"^[A-Za-z0-9.-]"), F.nullif(F.trim(F.get(parts, 0)), F.lit("")))
    return {"fundName": name, "nav": price} | {n: fact(labels, kind) for n, labels, kind in FACTS}


def like_prefixes(text: Column, prefixes: list[str]) -> Column:
    """Whether a text starts with any of them."""
    return text.rlike("^(?:" + "|".join(map(re.escape, prefixes)) + ")")
