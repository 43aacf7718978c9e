"""Line-item text and dish names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank characters in the Unicode sense, with the ASCII separators that Java leaves out.
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove Unicode blanks at both ends (SQL ``trim`` removes spaces only)."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def split_items(text: Column) -> Column:
    """``"1 x A, Large, 2 x B"`` -> ``["1 x A, Large", "2 x B"]``.

    A comma separates two lines only when a count and an ``x`` follow it, so
    commas inside a name survive. NULL or empty text has no lines.
    """
    return F.when(text != "", F.split(text, rf"(?U),{_BLANK}*(?=\d+{_BLANK}*x{_BLANK})", -1))


_LINE = rf"(?U)^(\d+){_BLANK}*x{_BLANK}*([^\n]*)\z"


def line_quantity(line: Column) -> Column:
    """Count in front of a stripped line; NULL when the line has none."""
    return F.regexp_extract(line, _LINE, 1).try_cast("int")


def line_name(line: Column) -> Column:
    """Name behind the count, or the whole stripped line when there is no count."""
    return strip(F.regexp_replace(line, _LINE, "$2"))


def _undecorated(name: Column) -> Column:
    plain = strip(F.regexp_replace(F.coalesce(name, F.lit("")), r"^[^\p{L}\p{N}_(]+", ""))
    return strip(F.regexp_replace(plain, rf"(?iU)^(most ordered|bestseller){_BLANK}+", ""))


def dish_size(name: Column) -> Column:
    """First bracketed size, lower-cased; empty when there is none."""
    return F.lower(strip(F.regexp_extract(_undecorated(name), r"\[([^\]]*)\]", 1)))


def dish_base(name: Column) -> Column:
    """Dish name without decoration, badge, sizes and a closing ``(...)`` note."""
    base = F.regexp_replace(_undecorated(name), rf"(?U){_BLANK}*\[[^\]]*\]{_BLANK}*", " ")
    base = F.regexp_replace(base, rf"(?U){_BLANK}*\([^)]*\){_BLANK}*\z", "")
    return F.lower(strip(F.regexp_replace(base, rf"(?U){_BLANK}+", " ")))
