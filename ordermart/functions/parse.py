"""Strict parsers for raw CSV text.

ANSI mode is on by default, so a plain ``cast`` of bad input aborts the
job.  Every parser here uses ``try_*`` forms and returns null for input
that does not parse; callers turn null-for-non-null-input into a
violation.  Input is stripped like Python's ``str.strip()`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import RAW_PRICE_TYPE
from .clean import _col, strip_all

# Fixed value: Python ``int(text)`` syntax (sign, digits, single
# underscores between digits; no decimal point, no exponent).
INT_SYNTAX = r"^[+-]?[0-9]+(_[0-9]+)*\z"
# Python ``Decimal(text)`` syntax for finite numbers.
_DIGITS = r"[0-9]+(_[0-9]+)*"
DECIMAL_SYNTAX = (rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})"
                  rf"([eE][+-]?{_DIGITS})?\z")
# Python ``Decimal(text)`` also accepts these non-finite spellings.
NON_FINITE_SYNTAX = r"(?i)^[+-]?(inf|infinity|s?nan[0-9]*)\z"
# ISO date, zero padded, year 1000-9999 (a round trip through
# strptime/strftime rejects anything else).
STRICT_DATE_SYNTAX = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
# ``strptime('%Y-%m-%d')`` alone: 4-digit year, 1-2 digit month, day may
# also be a space and one digit.
LENIENT_DATE_SYNTAX = r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])\z"


def is_int_text(c) -> Column:
    return strip_all(c).rlike(INT_SYNTAX)


def parse_int(c) -> Column:
    """INT value of Python-int syntax, null otherwise (and on overflow)."""
    s = F.regexp_replace(strip_all(c), "_", "")
    return F.when(is_int_text(c), s.try_cast("int"))


def parse_int_wide(c) -> Column:
    """Integer value without the INT range limit (for range rules)."""
    s = F.regexp_replace(strip_all(c), "_", "")
    return F.when(is_int_text(c), s.try_cast("decimal(38,0)"))


def is_decimal_text(c) -> Column:
    return strip_all(c).rlike(DECIMAL_SYNTAX)


def is_non_finite_text(c) -> Column:
    return strip_all(c).rlike(NON_FINITE_SYNTAX)


def parse_decimal(c, dtype=RAW_PRICE_TYPE) -> Column:
    """Finite decimal value; NaN / Infinity and junk give null."""
    s = F.regexp_replace(strip_all(c), "_", "")
    return F.when(is_decimal_text(c), s.try_cast(dtype.simpleString()))


def has_excess_decimals(c) -> Column:
    """More fraction digits than RAW_PRICE_TYPE holds, trailing zeros left out."""
    s = F.regexp_replace(strip_all(c), "_", "")
    fraction = F.regexp_replace(F.regexp_extract(s, r"[.]([0-9]*)", 1), "0+$", "")
    exponent = F.coalesce(F.regexp_extract(s, r"[eE]([+-]?[0-9]+)", 1).try_cast("int"), F.lit(0))
    # short texts without an exponent cannot have too many: only others go through the patterns
    long = (F.length(s) > RAW_PRICE_TYPE.scale) | s.contains("e") | s.contains("E")
    return long & is_decimal_text(c) & s.rlike("^[^eE]*[1-9]") & (F.length(fraction) - exponent > RAW_PRICE_TYPE.scale)


def is_strict_date_text(c) -> Column:
    s = strip_all(c)
    return s.rlike(STRICT_DATE_SYNTAX) & F.try_to_date(s, "yyyy-MM-dd").isNotNull()


def parse_date_strict(c) -> Column:
    """P10: zero-padded YYYY-MM-DD that exists in the calendar."""
    s = strip_all(c)
    return F.when(s.rlike(STRICT_DATE_SYNTAX), F.try_to_date(s, "yyyy-MM-dd"))


def parse_date_lenient(c) -> Column:
    """``strptime(v, '%Y-%m-%d')``: month/day may be unpadded."""
    s = strip_all(c)
    y = F.regexp_extract(s, LENIENT_DATE_SYNTAX, 1)
    m = F.regexp_extract(s, LENIENT_DATE_SYNTAX, 2)
    d = F.trim(F.regexp_extract(s, LENIENT_DATE_SYNTAX, 3))
    iso = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(s.rlike(LENIENT_DATE_SYNTAX) & (y != "0000"),
                  F.try_to_date(iso, "yyyy-MM-dd"))


def parse_date_loose(c) -> Column:
    """Strict first, then lenient; used to type staging dates."""
    return F.coalesce(parse_date_strict(c), parse_date_lenient(_col(c)))
