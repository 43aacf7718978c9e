"""Fail-soft and strict casts from raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ORDER_TIME_FORMAT


# Checked before the cast: what it rejects is common in exports (blanks, words),
# and a failing cast costs an exception per cell.
_NUMBER = (
    r"(?i)^\s*(?:nan|[+-]?(?:inf|infinity"
    r"|(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?))\s*$"
)


def to_double(text: Column) -> Column:
    """Text to DOUBLE, NULL when it is not a number.

    Java would also read ``1.5d``, ``12f`` and hexadecimal floats; those are
    not numbers here. ``1_000`` is.
    """
    digits = F.when(F.contains(text, F.lit("_")), F.replace(text, F.lit("_"))).otherwise(text)
    return F.when(text.rlike(_NUMBER), digits.try_cast("double"))


def to_int(text: Column) -> Column:
    """Text to INTEGER, halves rounded away from zero, NULL when out of range.

    ``0x10`` and ``0b11`` are whole numbers too.
    """
    hexadecimal, binary = r"^\s*0[xX]([0-9a-fA-F]{1,8})\s*$", r"^\s*0[bB]([01]{1,32})\s*$"
    return (
        F.when(text.rlike(hexadecimal), F.conv(F.regexp_extract(text, hexadecimal, 1), 16, 10).try_cast("int"))
        .when(text.rlike(binary), F.conv(F.regexp_extract(text, binary, 1), 2, 10).try_cast("int"))
        .otherwise(F.round(to_double(text)).try_cast("int"))
    )


def to_timestamp(text: Column) -> Column:
    """ISO text to TIMESTAMP_NTZ; a zone suffix is ignored, a bare year is no time."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))


def _single_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def order_time(text: Column) -> Column:
    """Export order time; bad text stops the job, whatever the session's settings."""
    bad = F.raise_error(F.concat(F.lit("order time cannot be read: "), text)).cast("timestamp_ntz")
    found = try_order_time(text)
    return F.when(text.isNull() | found.isNotNull(), found).otherwise(bad)


def try_order_time(text: Column) -> Column:
    """Export order time; bad text gives NULL. For probing before the strict parse."""
    return F.try_to_timestamp(_single_blanks(text), F.lit(ORDER_TIME_FORMAT)).cast("timestamp_ntz")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def distance_km(text: Column) -> Column:
    """``<1 km`` -> 1.0: every character but digits and points is dropped."""
    return to_double(F.regexp_replace(text, "[^0-9.]", ""))
