"""Numeric expressions (inventory M1-M8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col, lit_or_col


def safe_divide(a, b) -> Column:
    """Division that yields NULL on a zero divisor instead of raising."""
    return F.try_divide(as_col(a), lit_or_col(b) if not isinstance(b, str) else F.col(b))


def round_half_up(c, scale: int = 0) -> Column:
    """SQL ROUND (HALF_UP); negative scale rounds to tens, hundreds..."""
    return F.round(as_col(c), scale)


def round_half_even(c, scale: int = 0) -> Column:
    """Python/pandas ``round`` (banker's rounding)."""
    return F.bround(as_col(c), scale)


def py_mod(a, b) -> Column:
    """Python ``%``: the result takes the sign of the divisor (SQL ``%``
    follows the dividend, ``pmod`` is non-negative)."""
    a = as_col(a)
    b = lit_or_col(b) if not isinstance(b, str) else F.col(b)
    r = a % b
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def floor_div(a, b) -> Column:
    """Python ``//`` on integers, exact for the full long range."""
    a = as_col(a)
    b = lit_or_col(b) if not isinstance(b, str) else F.col(b)
    return ((a - py_mod(a, b)) / b).cast("long")


def trunc_div(a, b) -> Column:
    """SQL ``div``: truncates toward zero."""
    a = as_col(a)
    b = lit_or_col(b) if not isinstance(b, str) else F.col(b)
    return ((a - a % b) / b).cast("long")


def power(c, p) -> Column:
    return F.pow(as_col(c), p)


def sqrt(c) -> Column:
    return F.sqrt(as_col(c))


def cbrt(c) -> Column:
    return F.cbrt(as_col(c))


def abs_(c) -> Column:
    return F.abs(as_col(c))


# M5 ---------------------------------------------------------------------
# The transform names accepted by the feature dispatcher.
FEATURE_KINDS = ("log", "reciprocal", "square", "square_root", "cube", "power", "custom")

#: name -> (domain of x, or None for all; expression on it)
_FEATURES = {
    "log": (lambda x: x > 0, F.ln),
    "reciprocal": (lambda x: x != 0, lambda x: 1.0 / x),
    "square_root": (lambda x: x >= 0, F.sqrt),
    "square": (None, lambda x: x * x),
    "cube": (None, lambda x: x * x * x),
    "power": (None, lambda x: F.pow(x, F.lit(4.0))),
    "custom": (None, lambda x: x / 100.0),
}


def feature_transform(c, kind: str) -> Column:
    """One numeric feature transform; values outside its domain give NULL
    (log of x <= 0, reciprocal of 0, square root of x < 0). Unknown kinds
    return the value as double."""
    x = as_col(c).cast("double")
    domain, value = _FEATURES.get(kind, (None, lambda x: x))
    return value(x) if domain is None else F.when(domain(x), value(x))


# M6 ---------------------------------------------------------------------
def safe_cast(c, to: str) -> Column:
    """Cast that yields NULL for malformed input instead of raising."""
    return as_col(c).try_cast(to)


# M7 ---------------------------------------------------------------------
def percentage(part, whole, scale: int | None = None) -> Column:
    v = F.try_divide(as_col(part).cast("double"), as_col(whole)) * 100
    return F.round(v, scale) if scale is not None else v


def simple_interest(principal, rate_pct, years) -> Column:
    return as_col(principal) * as_col(rate_pct) * as_col(years) / 100


def compound_amount(principal, rate_pct, years) -> Column:
    return as_col(principal) * F.pow(1 + as_col(rate_pct) / 100, as_col(years))


def compound_interest(principal, rate_pct, years) -> Column:
    return compound_amount(principal, rate_pct, years) - as_col(principal)


def fahrenheit_to_celsius(c) -> Column:
    return (as_col(c) - 32) * 5 / 9


def degrees_to_radians(c) -> Column:
    return F.radians(as_col(c))


def hypotenuse(a, b) -> Column:
    return F.hypot(as_col(a), as_col(b))


# M8 ---------------------------------------------------------------------
def vector_add(a, b) -> Column:
    """Element-wise sum of two arrays (shorter side padded with NULL)."""
    return F.zip_with(as_col(a), as_col(b), lambda x, y: x + y)


def array_sum(a) -> Column:
    """Sum of a numeric array; NULL elements are skipped, empty -> 0."""
    return F.aggregate(as_col(a), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0)))


def row_sums(matrix) -> Column:
    """Per inner array sum of an array<array<number>>."""
    return F.transform(as_col(matrix), lambda row: array_sum(row))


def row_maxes(matrix) -> Column:
    return F.transform(as_col(matrix), lambda row: F.array_max(row))
