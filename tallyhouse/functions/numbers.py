"""Sums and rounding whose results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = float(2**53)


def is_cents(x: Column) -> Column:
    """True when the DOUBLE is the nearest one to a whole number of cents."""
    scaled = F.rint(x * 100)
    return (F.abs(scaled) < _EXACT) & (scaled / 100 == x)


def to_cents(x: Column) -> Column:
    """Whole cents as BIGINT; NULL where ``is_cents`` is false."""
    return F.when(is_cents(x), F.rint(x * 100).cast("bigint"))


def from_cents(cents: Column, rest: Column) -> Column:
    """Total of a BIGINT cent sum and a DOUBLE sum, either of which may be NULL."""
    whole = cents / F.lit(100.0)
    return F.coalesce(whole + rest, whole, rest)


def exact_sum(x: Column) -> Column:
    """Sum of DOUBLEs, added in integer cents wherever that loses nothing.

    Floating-point addition depends on the order in which tasks finish. Values
    with at most two decimals, that is money, are added as BIGINT, which is
    exact and cheap; all others are added as they are.
    """
    return from_cents(F.sum(to_cents(x)), F.sum(F.when(~is_cents(x), x)))


def exact_avg(x: Column) -> Column:
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0))


def two_decimals(x: Column) -> Column:
    """Round to two decimals on the exact binary value, halves to even (2.675 -> 2.67).

    Only values next to half a cent need all their digits; text formatting,
    which sees them, is slow and kept for those.
    """
    nearest = F.rint(x * 100)
    plain = (F.abs(x) < 1e9) & (F.abs(x * 100 - nearest) < 0.4999)
    by_digits = F.call_function("format_number", x, F.lit("0.00")).cast("double")
    return F.when(plain, nearest / 100).when(F.abs(x) < 1e13, by_digits).otherwise(x)
