"""Typed orders and their lines, from both channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casts
from ..functions.text import line_name, line_quantity, split_items, strip
from ..operators.ranking import keep_latest, sequence_within
from ..schemas import DIRECT, EXPORT_COLUMNS, ITEMS_COLUMN

_RULES = {
    "text": lambda c: c,
    "trim": F.trim,
    "blank": casts.blank_to_null,
    "number": casts.to_double,
    "distance": casts.distance_km,
    "time": casts.order_time,
}


def _newest_first() -> list[Column]:
    """Files are named by their week; when one was loaded says nothing about its rows."""
    return [F.desc("_source_file"), F.desc("_row_seq")]


def typed_orders(exports: DataFrame) -> DataFrame:
    """Raw export rows -> typed orders, one per order id.

    Of several rows with one order id the newest export wins. The parse of the
    order time is strict. De-duplication runs on the raw text, so only the
    rows that stay are parsed.
    """
    return typed_rows(keep_latest(exports.drop(ITEMS_COLUMN), ["Order ID"], _newest_first()))


def typed_rows(exports: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The same for every row; ``also`` names further columns to pass on."""
    return exports.select(
        *[_RULES[rule](F.col(f"`{header}`")).alias(name) for header, name, rule in EXPORT_COLUMNS],
        "_source_file",
        "_loaded_at",
        *also,
    )


def with_customer_sequence(orders: DataFrame, counted: DataFrame | None = None, **limits: int) -> DataFrame:
    """Add ``customer_order_seq`` and ``is_first_order``. Orders without a
    customer form one sequence."""
    order = [F.asc_nulls_last("order_placed_at"), F.asc_nulls_last("order_id")]
    sequenced = sequence_within(orders, ["customer_id"], order, "customer_order_seq", counted, **limits)
    return sequenced.withColumn("is_first_order", F.col("customer_order_seq") == 1)


def orders(exports: DataFrame, **limits: int) -> DataFrame:
    """``silver.orders``: typed, de-duplicated and sequenced.

    Large customers are found in the raw rows: one column, no de-duplication.
    """
    customers = exports.select(F.col("`Customer ID`").alias("customer_id"))
    return with_customer_sequence(typed_orders(exports), customers, **limits)


def order_items(exports: DataFrame, dedupe: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """``silver.order_items``: one row per line of the item text.

    Lines come from every export row, so an order that was exported twice has
    its lines twice; ``dedupe=True`` takes them from the newest row only.
    ``_row_seq`` is the sequence number of the export row; ``also`` names
    further columns of it to pass on.
    """
    if dedupe:
        exports = keep_latest(exports, ["Order ID"], _newest_first())
    lines = exports.select(
        F.col("`Order ID`").alias("order_id"),
        "_row_seq",
        *also,
        F.posexplode(split_items(F.col(f"`{ITEMS_COLUMN}`"))).alias("_at", "_text"),
    ).withColumn("_text", strip(F.col("_text")))
    return lines.select(
        "order_id",
        (F.col("_at") + 1).alias("item_seq"),
        line_quantity(F.col("_text")).alias("quantity"),
        line_name(F.col("_text")).alias("item_name"),
        "_row_seq",
        *also,
    )


def with_lines(exports: DataFrame) -> DataFrame:
    """The rows that ``order_items`` makes at least one line of."""
    return exports.filter(F.col(f"`{ITEMS_COLUMN}`") != "")


def direct_orders(raw: DataFrame) -> DataFrame:
    """``silver.direct_orders``, with the column names of ``silver.orders`` where they mean the same."""
    confirmed = casts.to_timestamp(F.col("confirmed_at"))
    return raw.select(
        "order_id",
        F.lit(DIRECT).alias("source"),
        F.col("status").alias("order_status"),
        "order_type",
        casts.to_timestamp(F.col("slot_at")).alias("slot_at"),
        "distance_band",
        "locality",
        "food_total",
        "delivery_fee",
        "total",
        casts.to_timestamp(F.col("created_at")).alias("created_at"),
        confirmed.alias("confirmed_at"),
        confirmed.alias("order_placed_at"),
        "customer_phone",
        "customer_name",
    )


def direct_order_items(raw: DataFrame) -> DataFrame:
    """``silver.direct_order_items``: one row per element of the item array."""
    items = raw.select("order_id", F.explode(F.from_json("items_json", "array<string>")).alias("_item"))
    fields = F.from_json("_item", "catalog_id string, name string, qty string, unit_price string")

    def field(name: str) -> Column:
        return F.col(f"_fields.{name}")

    return items.withColumn("_fields", fields).select(
        "order_id",
        F.lit(DIRECT).alias("source"),
        field("catalog_id").alias("catalog_id"),
        field("name").alias("item_name"),
        casts.to_int(field("qty")).alias("quantity"),
        casts.to_double(field("unit_price")).alias("unit_price"),
    )
