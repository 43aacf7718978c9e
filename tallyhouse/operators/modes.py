"""Most frequent value per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import two_decimals


def mode_two_decimals(df: DataFrame, keys: list[str], value: Column, seq: Column) -> DataFrame:
    """Most frequent two-decimal ``value`` per key, with the number of samples.

    Of equally frequent values the one seen first, by ``seq``, wins. Both steps
    combine before the shuffle, so a key with much of the data is no hot spot.
    Returns ``keys, mode_value, sample_n``.
    """
    counted = df.groupBy(*keys, two_decimals(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first")
    )
    best = F.max(F.struct(F.col("_n"), (-F.col("_first")).alias("_early"), F.col("_v")))
    return (
        counted.groupBy(*keys)
        .agg(best.alias("_best"), F.sum("_n").alias("sample_n"))
        .select(*keys, F.col("_best._v").alias("mode_value"), "sample_n")
    )
