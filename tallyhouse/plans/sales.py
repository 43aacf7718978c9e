"""Weekly sales, items, customers and operations: the answer tables.

Sorts end with the group's keys, so that equal values can be cut into ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.numbers import exact_avg, exact_sum
from ..schemas import DELIVERED, DIRECT, MARKETPLACE

RESTAURANT = ["restaurant_id", "restaurant_name"]


def delivered(value: Column) -> Column:
    return F.when(F.col("order_status") == DELIVERED, value)


def _week() -> Column:
    return week_start(F.col("order_placed_at")).alias("week_start")


def weekly_sales(orders: DataFrame) -> DataFrame:
    """Per restaurant and week. An order without a status is in neither count."""
    return (
        orders.groupBy(*RESTAURANT, _week())
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.count_if(F.col("order_status") == DELIVERED).alias("delivered_count"),
            F.count_if(F.col("order_status") != DELIVERED).alias("cancelled_count"),
            exact_sum(delivered(F.col("total"))).alias("total_revenue"),
            exact_avg(delivered(F.col("total"))).alias("avg_order_value"),
            exact_avg(F.col("rating")).alias("avg_rating"),
        )
        .orderBy(F.asc_nulls_last("week_start"), *RESTAURANT)
    )


def item_performance(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per restaurant and item: lines and units sold."""
    return (
        items.select("order_id", "item_name", "quantity")
        .join(orders.select("order_id", *RESTAURANT), "order_id")
        .groupBy(*RESTAURANT, "item_name")
        .agg(F.count(F.lit(1)).alias("times_ordered"), F.sum("quantity").alias("total_qty"))
        .orderBy(F.desc_nulls_last("total_qty"), *RESTAURANT, "item_name")
    )


def customer_summary(orders: DataFrame) -> DataFrame:
    """Per restaurant and customer: spend, order times, rating."""
    return (
        orders.groupBy(*RESTAURANT, "customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            exact_sum(delivered(F.col("total"))).alias("total_spend"),
            exact_avg(delivered(F.col("total"))).alias("avg_order_value"),
            F.min("order_placed_at").alias("first_order_at"),
            F.max("order_placed_at").alias("last_order_at"),
            exact_avg(F.col("rating")).alias("avg_rating_given"),
        )
        .orderBy(F.desc_nulls_last("total_spend"), *RESTAURANT, "customer_id")
    )


def ops_quality(orders: DataFrame) -> DataFrame:
    """Per restaurant and week: kitchen and rider times, cancellations, complaints."""
    cancelled = F.count_if(F.col("order_status") != DELIVERED)
    return (
        orders.groupBy(*RESTAURANT, _week())
        .agg(
            exact_avg(F.col("kpt_duration_min")).alias("avg_kpt_duration_min"),
            exact_avg(F.col("rider_wait_min")).alias("avg_rider_wait_min"),
            (cancelled / F.count(F.lit(1)).cast("double")).alias("cancellation_rate"),
            F.count("customer_complaint_tag").alias("complaint_count"),
        )
        .orderBy(F.asc_nulls_last("week_start"), *RESTAURANT)
    )


def combined_weekly_sales(orders: DataFrame, direct_orders: DataFrame | None = None) -> DataFrame:
    """Both channels by week, one below the other and never joined.

    Their customers are keyed differently. Without direct orders the table
    holds the marketplace alone. Every direct order is a confirmed one.
    """
    weeks = orders.groupBy(_week()).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(F.col("order_status") == DELIVERED).alias("confirmed_count"),
        exact_sum(delivered(F.col("total"))).alias("revenue"),
    )
    return both_channels(weeks, direct_orders)


def both_channels(weeks: DataFrame, direct_orders: DataFrame | None) -> DataFrame:
    """Marketplace weeks, and those of direct orders if there are any."""
    columns = ["week_start", "source", "order_count", "confirmed_count", "revenue"]
    combined = weeks.withColumn("source", F.lit(MARKETPLACE)).select(*columns)
    if direct_orders is not None:
        direct = direct_orders.groupBy(_week()).agg(
            F.count(F.lit(1)).alias("order_count"),
            F.count(F.lit(1)).alias("confirmed_count"),
            F.sum("total").alias("revenue"),
        )
        combined = combined.unionByName(direct.withColumn("source", F.lit(DIRECT)).select(*columns))
    return combined.orderBy(F.asc_nulls_last("week_start"), "source")


def stock_sold_vs_wasted(moves: DataFrame, batches: DataFrame, skip_undone: bool = True) -> DataFrame:
    """Units sold and wasted per SKU. Moves that were undone do not count.

    Moves are summed per batch before the join.
    """
    if skip_undone and "undone_at" in moves.columns:
        moves = moves.filter(F.col("undone_at").isNull())

    def units(reason: str) -> Column:
        return F.sum(F.when(F.col("reason") == reason, -F.col("delta")).otherwise(0))

    per_batch = moves.groupBy("batch_id").agg(units("sold").alias("_sold"), units("wasted").alias("_wasted"))
    return (
        per_batch.join(batches.select(F.col("id").alias("batch_id"), "sku"), "batch_id")
        .groupBy("sku")
        .agg(F.sum("_sold").alias("sold"), F.sum("_wasted").alias("wasted"))
        .orderBy(F.desc_nulls_last("sold"), "sku")
    )


def unmatched_menu_items(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Item names that are not on the menu, with the number of lines.

    Lines are counted per name before the join, so a best-seller is one row.
    """
    names = items.groupBy("item_name").agg(F.count(F.lit(1)).alias("lines"))
    return names.join(menu.select("item_name").distinct(), "item_name", "left_anti")


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with no line. The item side is reduced to distinct ids first."""
    return orders.join(items.select("order_id").distinct(), "order_id", "left_anti")
