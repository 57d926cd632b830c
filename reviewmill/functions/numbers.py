"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.text import _col

_NUMBER = r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
_INTEGER = r"(?U)^\s*([+-]?[0-9]+)\s*$"


def finite(c: Column | str) -> Column:
    """The number itself, or null for NaN (larger than every number here) and the infinities."""
    c = _col(c)
    return F.when(F.abs(c) < float("inf"), c)


def text_to_number(c: Column | str) -> Column:
    """Numeric text to a finite double, anything else to null."""
    return finite(F.regexp_extract(_col(c), _NUMBER, 1).try_cast("double"))


def text_to_integer(c: Column | str) -> Column:
    """Integer text to bigint; ``5.0`` is not an integer text."""
    return F.regexp_extract(_col(c), _INTEGER, 1).try_cast("bigint")


def parse_number(c: Column | str) -> Column:
    """Lenient number: thousands separators and dollar signs are dropped first."""
    return text_to_number(F.regexp_replace(_col(c), r"[,$]", ""))


def canonical_number(c: Column | str) -> Column:
    """``5.0`` as ``5``, other values with up to twelve significant digits."""
    c = _col(c).cast("double")
    whole = (c == F.floor(c)) & (F.abs(c) < 9.0e18)
    # Twelve significant digits, then plain notation without trailing zeros.
    digits = F.format_string("%.11e", c).try_cast("double")
    plain = F.regexp_replace(digits.cast("decimal(38,17)").cast("string"), r"\.?0+$", "")
    in_plain_range = F.abs(digits).between(1e-4, 999_999_999_999.0)
    return (
        F.when(whole, c.cast("bigint").cast("string"))
        .when(in_plain_range, plain)
        .otherwise(digits.cast("string"))
    )


def safe_rate(numerator: Column | str, denominator: Column | str) -> Column:
    """Fraction as double; 0.0 when there is nothing to divide by."""
    num, den = _col(numerator), _col(denominator)
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def whole_or_null(c: Column | str) -> Column:
    """Whole double to bigint, other values to null."""
    c = _col(c)
    return F.when((c == F.floor(c)) & (F.abs(c) < 9.2e18), c.cast("bigint"))
