"""Gaps between date ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_gaps(ranges: DataFrame, covering: bool = False) -> DataFrame:
    """Days no range covers, as ``gap_start, gap_end``, from ``start_date, end_date``.

    By default a range is compared with the one right after it in (start, end)
    order only, so a short range inside a long one leaves an apparent gap.
    ``covering=True`` compares with the furthest end so far instead.

    The ordered window has no partition key, but it sees one row per start
    date, which the calendar bounds.
    """
    per_range = ranges.groupBy("start_date", "end_date").agg(F.count(F.lit(1)).alias("_copies"))
    # Ranges that end before they start leave a gap to the next range of the same start too.
    inverted = F.date_add("end_date", 1) < F.col("start_date")
    per_start = per_range.groupBy("start_date").agg(
        F.max("end_date").alias("_last_end"),
        F.collect_list(F.when(inverted, F.struct("end_date", "_copies"))).alias("_inverted"),
    )
    by_start = Window.orderBy("start_date")
    steps = per_start.select(
        "*",
        (F.max("_last_end").over(by_start) if covering else F.col("_last_end")).alias("_reach"),
        F.lead("start_date").over(by_start).alias("_next"),
    )

    def gap(first: Column, last: Column) -> Column:
        return F.struct(first.alias("gap_start"), last.alias("gap_end"))

    none = F.array().cast("array<struct<gap_start:date,gap_end:date>>")
    after = gap(F.date_add("_reach", 1), F.date_sub("_next", 1))
    gaps = F.when(F.col("_next") > F.date_add("_reach", 1), F.array(after)).otherwise(none)
    if not covering:
        # The last range of a start is followed by the next start, which `after` covers.
        within = F.transform(
            "_inverted",
            lambda r: F.array_repeat(
                gap(F.date_add(r.end_date, 1), F.date_sub("start_date", 1)),
                (r._copies - (r.end_date == F.col("_last_end")).cast("int")).cast("int"),
            ),
        )
        gaps = F.concat(gaps, F.flatten(within))
    return steps.select(F.inline(gaps))
