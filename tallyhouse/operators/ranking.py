"""Keep-latest and running sequence numbers that hold up under skewed keys."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage


def keep_latest(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first in ``newest_first`` order. NULL is a key of its own.

    The ``= 1`` filter becomes a group limit below the shuffle, so a key that
    holds much of the data sends one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def sequence_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    counted: DataFrame | None = None,
    hot_rows: int = 5_000_000,
    slice_rows: int = 1_000_000,
) -> DataFrame:
    """Add the 1-based position of each row within its key.

    Keys with at most ``hot_rows`` rows use a window. A larger key (masked or
    missing customers share one) would be sorted by a single task, so its rows
    are range-partitioned by ``order`` into slices, numbered per slice and
    shifted by the size of the slices before. ``order`` must be total.

    The size of keys is taken from ``counted``, by default ``df`` itself. It
    only chooses the way, so an upper bound that is cheap to scan will do.
    """
    hot = stage(
        (df if counted is None else counted)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows),
        "hot-keys",
    )
    hot_total = hot.agg(F.sum("_rows")).first()[0]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if not hot_total:
        return df.withColumn(name, position.cast("bigint"))

    df = stage(df, "sequence-input")
    cold = df.join(hot, _same_key(df, hot, keys), "left_anti").withColumn(name, position.cast("bigint"))
    # Written out, because another run of a range shuffle may cut elsewhere.
    sliced = stage(
        df.join(hot, _same_key(df, hot, keys), "left_semi")
        .repartitionByRange(math.ceil(hot_total / slice_rows), *keys, *order)
        .withColumn("_slice", F.spark_partition_id()),
        "hot-slices",
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    in_slice = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    warm = (
        sliced.withColumn("_in_slice", in_slice)
        .alias("s")
        .join(shifts.alias("o"), _same_key_alias("s", "o", [*keys, "_slice"]))
        .select(*[F.col(f"s.`{c}`") for c in df.columns], (F.col("_in_slice") + F.col("_shift")).alias(name))
    )
    return cold.unionByName(warm)


def _same_key_alias(left: str, right: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, (F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys)
    )
