"""Numeric columns with the rounding and parsing rules of the published figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16
# Fixed value: month names that make a text a date and not a percentage.
_MONTH = r"(?i)\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\b"
#: A sign, digits with or without thousands separators, decimals.
_NUMBER = r"[-+]?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"


def round_half_up(v: Column, digits: int) -> Column:
    """Halves go toward plus infinity."""
    p = float(10**digits)
    return F.floor((v + F.lit(EPSILON)) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def round_fixed(v: Column, digits: int, shown: int | None = None) -> Column:
    """round_half_up as text with so many digits shown."""
    return F.format_string(f"%.{shown if shown is not None else digits}f", round_half_up(v, digits))


def to_fixed(v: Column, digits: int) -> Column:
    """Rounded by the exact binary value, ties away from zero (1.005 is 1.0, 0.125 is 0.13), for at most six digits
    and absolute values below 2**53 / 10**digits. The fraction is taken apart into two integers of 32 bits, so that
    each product with a power of ten is exact; bits of it below 2**-64 don't count."""
    unit, p = float(2**32), 10**digits
    size = F.abs(v)
    whole = F.floor(size)
    scaled_up = (size - whole) * F.lit(unit)
    high = F.floor(scaled_up)
    low = F.floor((scaled_up - high) * F.lit(unit))
    sum_ = high * F.lit(p).cast("bigint") + F.shiftright(low * F.lit(p).cast("bigint"), 32)
    n = F.shiftright(sum_, 32) + F.shiftright(sum_, 31).bitwiseAND(F.lit(1).cast("bigint"))
    return F.signum(v) * ((whole * F.lit(p).cast("bigint") + n).cast("double") / F.lit(float(p)))


def round_whole(v: Column) -> Column:
    return F.floor(v + F.lit(0.5))


def parse_number(text: Column) -> Column:
    """The first number of a text, thousands separators dropped; null if there is none."""
    return F.regexp_replace(F.regexp_extract(text, _NUMBER, 0), ",", "").try_cast("double")


def parse_percent(text: Column) -> Column:
    """A fraction: per cent signs divide by 100; without one only values below 1 count; month names don't."""
    value = parse_number(F.trim(F.regexp_replace(text, "%", "")))
    share = F.when(text.contains("%"), round_half_up(value / 100, 6)).when(value < 1, round_half_up(value, 6))
    return F.when(~text.rlike(_MONTH), share)


def parse_money(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("double")


def scaled(value: Column, unit: Column) -> Column:
    """Values in billions or millions, by a suffix."""
    unit = F.lower(unit)
    return value * F.when(unit.startswith("b"), F.lit(1e9)).when(unit.startswith("m"), F.lit(1e6)).otherwise(F.lit(1.0))


def from_32nds(price: Column) -> Column:
    """A quote whose two decimals count 32nds."""
    whole = F.floor(price)
    return whole + F.lit(100.0) * (price % F.lit(1.0)) / F.lit(32.0)


def hash_code(text: Column) -> Column:
    """31 * h + c over the UTF-16 units (two for a character beyond the basic plane), in 32 bits, without its sign."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))
    step = lambda a, u: (a * 31 + F.conv(u, 16, 10).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF))
    h = F.aggregate(units, F.lit(0).cast("bigint"), step)
    return F.abs(F.when(h >= 2**31, h - 2**32).otherwise(h))


def per_unit(amount: Column, units: Column, digits: int = 2) -> Column:
    """Null where there are no units."""
    return F.when(units > 0, round_half_up(amount / units, digits))


def days_in_month(year: Column, month: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))


def leading_number(text: Column) -> Column:
    """The number that a text starts with, after white space, whatever follows; null if there is none (as parseFloat)."""
    return F.regexp_extract(text, r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)", 1).try_cast("double")


def whole_number(text: Column) -> Column:
    """A text that is a number and nothing else; blank is zero, anything else null (as Number)."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(bare == "", F.lit(0.0)).when(bare.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), bare.try_cast("double"))
