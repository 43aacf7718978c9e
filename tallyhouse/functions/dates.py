"""Date buckets that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week, as TIMESTAMP_NTZ."""
    day = F.to_date(ts)
    return F.date_sub(day, F.weekday(day)).cast("timestamp_ntz")
