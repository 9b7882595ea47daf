"""Cleaning, parsing and predicate functions on small hand-made rows."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermart.functions import amounts, clean, parse, predicates


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("  anne-marie   o'neil ", "Anne-Marie O'Neil"),
    ("\tHOUSEHOLD  mc\tdonald", " Household Mc Donald"),   # trim removes spaces only
    ("customer 12TH", "Customer 12th"),
    ("nation_7", "Nation_7"),
    ("", ""),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, raw, clean.clean_text) == expected


def test_clean_text_null(spark):
    assert one(spark, None, clean.clean_text) is None


@pytest.mark.parametrize("raw", [" a\t", " b ", "\x1fc\n", "d", "  ", "​x"])
def test_strip_matches_python(spark, raw):
    assert one(spark, raw, clean.strip_all) == raw.strip()


def test_lower_trim_keeps_newline(spark):
    assert one(spark, "  A@B.COM\n ", clean.lower_trim) == "a@b.com\n"


@pytest.mark.parametrize("raw", [" 4 ", "+4", "-3", "4.0", "1_000", "1__0", "12abc", "", "\t7 ", "99999999999"])
def test_parse_int_matches_python(spark, raw):
    try:
        expected = int(raw)
        if not -2**31 <= expected < 2**31:
            expected = None
    except ValueError:
        expected = None
    assert one(spark, raw, parse.parse_int) == expected


@pytest.mark.parametrize("raw", ["1.5", " 2 ", "1e3", ".5", "1.", "-0.25", "1_000.5", "NaN", "Infinity", "abc", "1.2.3"])
def test_parse_decimal_matches_python(spark, raw):
    try:
        d = Decimal(raw)
        expected = d if d.is_finite() else None
    except Exception:
        expected = None
    got = one(spark, raw, parse.parse_decimal)
    assert (got is None and expected is None) or got == expected


@pytest.mark.parametrize("raw", ["2026-09-01", "2026-9-1", "2026-02-30", "0999-01-01", "10/9/2026",
                                 " 2026-09-01\t", "2026-09-01T00:00", "2026-09- 1", "0000-01-01", ""])
def test_dates_match_strptime(spark, raw):
    v = raw.strip()
    try:
        parsed = dt.datetime.strptime(v, "%Y-%m-%d")
        lenient = parsed.date()
        strict = lenient if parsed.strftime("%Y-%m-%d") == v else None
    except ValueError:
        lenient = strict = None
    assert one(spark, raw, parse.parse_date_lenient) == lenient
    assert one(spark, raw, parse.parse_date_strict) == strict


@pytest.mark.parametrize("email,bad", [("a.b@example.com", False), ("bad@", True), ("a@b.c", True),
                                       ("x@y.com\n", True), (None, True), ("x_y%z+1@sub.dom-1.io", False)])
def test_email(spark, email, bad):
    assert one(spark, email, predicates.email_invalid) is bad


def test_totals_round_differently(spark):
    df = spark.createDataFrame([(3, "0.125"), (1, "0.005"), (1, "0.015")], "q int, p string")
    out = df.select(
        amounts.total_refresh("q", amounts.to_price(parse.parse_decimal("p"))).alias("refresh"),
        amounts.total_incremental("q", parse.parse_decimal("p")).alias("incr")).collect()
    # refresh: price rounded half-up to cents first; incremental: half-even on the product
    assert [r.refresh for r in out] == [Decimal("0.39"), Decimal("0.01"), Decimal("0.02")]
    assert [r.incr for r in out] == [Decimal("0.38"), Decimal("0.00"), Decimal("0.02")]
