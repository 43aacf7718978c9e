"""Mergeable states per month, from which the answer tables are finished.

A state holds counts, sums and extremes for one month and group: sums of money
in whole cents, as ``functions.numbers`` adds them. States of several months
merge by adding, so a refresh reads the orders of the months that changed and
leaves the states of all others alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.numbers import from_cents, is_cents, to_cents
from ..schemas import DELIVERED
from .sales import RESTAURANT, both_channels, delivered

#: The partition column of ``silver.orders`` and of all states.
MONTH = "order_month"


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, F.trunc("order_placed_at", "month"))


def _kept(value: Column, name: str) -> list[Column]:
    """The state of a sum and an average."""
    return [
        F.sum(to_cents(value)).alias(f"{name}_cents"),
        F.sum(F.when(~is_cents(value), value)).alias(f"{name}_rest"),
        F.count(value).alias(f"{name}_n"),
    ]


def _total(name: str) -> Column:
    return from_cents(F.sum(f"{name}_cents"), F.sum(f"{name}_rest"))


def _average(name: str) -> Column:
    return _total(name) / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def _count(name: str) -> Column:
    return F.sum(name)


def week_states(orders: DataFrame) -> DataFrame:
    """Per month, restaurant and week."""
    return orders.groupBy(MONTH, *RESTAURANT, week_start(F.col("order_placed_at")).alias("week_start")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count("order_id").alias("id_count"),
        F.count_if(F.col("order_status") == DELIVERED).alias("delivered_count"),
        F.count_if(F.col("order_status") != DELIVERED).alias("cancelled_count"),
        F.count("customer_complaint_tag").alias("complaint_count"),
        *_kept(delivered(F.col("total")), "revenue"),
        *_kept(F.col("rating"), "rating"),
        *_kept(F.col("kpt_duration_min"), "kpt"),
        *_kept(F.col("rider_wait_min"), "wait"),
    )


def customer_states(orders: DataFrame) -> DataFrame:
    """Per month, restaurant and customer."""
    return orders.groupBy(MONTH, *RESTAURANT, "customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        *_kept(delivered(F.col("total")), "spend"),
        F.min("order_placed_at").alias("first_order_at"),
        F.max("order_placed_at").alias("last_order_at"),
        *_kept(F.col("rating"), "rating"),
    )


def weekly_sales(states: DataFrame) -> DataFrame:
    """``gold.weekly_sales``, as ``sales.weekly_sales`` has it from the orders."""
    return (
        states.groupBy(*RESTAURANT, "week_start")
        .agg(
            _count("order_count").alias("order_count"),
            _count("delivered_count").alias("delivered_count"),
            _count("cancelled_count").alias("cancelled_count"),
            _total("revenue").alias("total_revenue"),
            _average("revenue").alias("avg_order_value"),
            _average("rating").alias("avg_rating"),
        )
        .orderBy(F.asc_nulls_last("week_start"), *RESTAURANT)
    )


def ops_quality(states: DataFrame) -> DataFrame:
    """``gold.ops_quality``."""
    return (
        states.groupBy(*RESTAURANT, "week_start")
        .agg(
            _average("kpt").alias("avg_kpt_duration_min"),
            _average("wait").alias("avg_rider_wait_min"),
            (_count("cancelled_count") / _count("order_count").cast("double")).alias("cancellation_rate"),
            _count("complaint_count").alias("complaint_count"),
        )
        .orderBy(F.asc_nulls_last("week_start"), *RESTAURANT)
    )


def customer_summary(states: DataFrame) -> DataFrame:
    """``gold.customer_summary``."""
    return (
        states.groupBy(*RESTAURANT, "customer_id")
        .agg(
            _count("order_count").alias("order_count"),
            _total("spend").alias("total_spend"),
            _average("spend").alias("avg_order_value"),
            F.min("first_order_at").alias("first_order_at"),
            F.max("last_order_at").alias("last_order_at"),
            _average("rating").alias("avg_rating_given"),
        )
        .orderBy(F.desc_nulls_last("total_spend"), *RESTAURANT, "customer_id")
    )


def combined_weekly_sales(states: DataFrame, direct_orders: DataFrame | None = None) -> DataFrame:
    """``gold.combined_weekly_sales``."""
    weeks = states.groupBy("week_start").agg(
        _count("order_count").alias("order_count"),
        _count("delivered_count").alias("confirmed_count"),
        _total("revenue").alias("revenue"),
    )
    return both_channels(weeks, direct_orders)
