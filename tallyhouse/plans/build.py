"""The full build: files in, published tables out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..publish import Warehouse
from ..sources.exports import file_ranges, list_files, ranked, read_exports
from ..sources.mirror import read_mirror
from ..sources.reference_csv import read_menu, read_price_sheet
from ..sources.snapshots import LOYALTY_SECTIONS, ORDERS_SECTIONS, direct_orders_raw, raw_elements, read_sections
from ..staging import staged_until_end
from . import loyalty, orders, prices, quality, sales, states

#: Export files with their ranks, as the tables have them.
INDEX = "bronze.export_index"
#: Rows of the raw table, and lines without a quantity.
TOTALS = "bronze.export_totals"
RAW, ORDERS, ITEMS = "bronze.order_history_raw", "silver.orders", "silver.order_items"
WEEKS, CUSTOMERS = "silver.week_states", "silver.customer_states"
#: Is there while a refresh replaces partitions; a build mends what it may have left.
OPEN_REFRESH = "bronze.open_refresh"
#: The partition column of what is kept by export file.
FILE_ID = "_file_id"


@dataclass
class Inputs:
    """Where the files are. A snapshot left out leaves its tables as they were.

    Snapshots hold one document per file, or one per line if ``one_per_line``.
    """

    exports: str
    menu: str
    price_sheet: str | None = None
    direct_orders: str | None = None
    loyalty: str | None = None
    tables: str | None = None
    one_per_line: bool = False


def with_file_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE_ID, F.md5(F.col("_source_file").cast("binary")))


def refuse_unparsed(unparsed: int) -> None:
    """Before the strict parse, so that the message can say how many are bad."""
    if unparsed:
        raise ValueError(f"{unparsed} export rows have an order time that cannot be read")


def publish_totals(warehouse: Warehouse, rows: int, unparsed_quantities: int) -> None:
    one = warehouse.spark.createDataFrame([(rows, unparsed_quantities)], "rows long, unparsed_quantities long")
    warehouse.publish(TOTALS, one.coalesce(1), listed=False)


def build_exports(warehouse: Warehouse, inputs: Inputs) -> None:
    """Raw rows and lines by export file, orders and their states by month."""
    files = warehouse.publish(INDEX, ranked(list_files(warehouse.spark, inputs.exports)), listed=False)
    rows = with_file_id(read_exports(warehouse.spark, inputs.exports, ranks=files))
    note = f"files: {warehouse.measured[INDEX]['rows']}"
    raw = warehouse.publish(RAW, rows, note, FILE_ID, {"unparsed": quality.unparsed_times()}, gathered=True)
    refuse_unparsed(warehouse.measured[RAW]["unparsed"])
    found = warehouse.publish(ORDERS, states.with_month(orders.orders(raw)), partition_by=states.MONTH)
    lines = orders.order_items(raw, also=[FILE_ID])
    warehouse.publish(ITEMS, lines, partition_by=FILE_ID, measure={"unparsed": quality.unparsed_quantities()}, gathered=True)
    warehouse.publish(WEEKS, states.week_states(found), partition_by=states.MONTH, listed=False)
    warehouse.publish(CUSTOMERS, states.customer_states(found), partition_by=states.MONTH, listed=False)
    publish_totals(warehouse, warehouse.measured[RAW]["rows"], warehouse.measured[ITEMS]["unparsed"])


def build_menu(warehouse: Warehouse, inputs: Inputs) -> None:
    menu = read_menu(warehouse.spark, inputs.menu)
    unmatched = sales.unmatched_menu_items(warehouse.table("silver.order_items"), menu)
    lines = unmatched.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    warehouse.publish("silver.menu_items", menu, note=f"unmatched order_items rows: {lines}")


def build_direct(warehouse: Warehouse, path: str, one_per_line: bool = False) -> None:
    sections = read_sections(warehouse.spark, path, ORDERS_SECTIONS, one_per_line)
    raw = warehouse.publish("bronze.direct_orders_raw", direct_orders_raw(sections["orders"]))
    warehouse.publish("silver.direct_orders", orders.direct_orders(raw))
    warehouse.publish("silver.direct_order_items", orders.direct_order_items(raw))


def build_loyalty(warehouse: Warehouse, path: str, one_per_line: bool = False) -> None:
    sections = read_sections(warehouse.spark, path, LOYALTY_SECTIONS, one_per_line)
    raw = {name: warehouse.publish(f"bronze.dough_{name}", raw_elements(found)) for name, found in sections.items()}
    ledger = warehouse.publish("silver.dough_ledger", loyalty.ledger(raw["ledger"]))
    balances = warehouse.publish("silver.dough_balances", loyalty.balances(raw["balances"]))
    warehouse.publish("silver.referrals", loyalty.referrals(raw["referrals"]))
    derived = warehouse.publish("silver.dough_balances_derived", loyalty.balances_from_ledger(ledger))
    warehouse.view(
        "gold.dough_balance_check",
        loyalty.BALANCE_CHECK_SQL.format(balances="silver.dough_balances", derived="silver.dough_balances_derived"),
    )
    warehouse.view(
        "gold.dough_customers",
        loyalty.CUSTOMERS_SQL.format(balances="silver.dough_balances", ledger="silver.dough_ledger"),
    )
    differing = loyalty.balance_check(balances, derived).count()
    warehouse.note("gold.dough_balance_check", differing, "customers where cache and ledger disagree")


def build_mirror(warehouse: Warehouse, path: str, one_per_line: bool = False) -> None:
    mirror = read_mirror(warehouse.spark, path, one_per_line)
    for name, table in mirror.tables.items():
        warehouse.publish(f"d1.{name}", table)
    for name in mirror.empty:
        warehouse.drop(f"d1.{name}", "empty at the source, not created")
    for name, message in mirror.failed.items():
        warehouse.note(f"d1.{name}", 0, f"could not be exported: {message}")


def build_gold(warehouse: Warehouse, inputs: Inputs) -> None:
    """The answer tables, from the kept states where there are any."""
    spark, found = warehouse.spark, warehouse.table(ORDERS)
    items, menu = warehouse.table(ITEMS), warehouse.table("silver.menu_items")
    weeks = warehouse.table(WEEKS)
    warehouse.publish("gold.weekly_sales", states.weekly_sales(weeks))
    warehouse.publish("gold.item_performance", sales.item_performance(items, found))
    warehouse.publish("gold.customer_summary", states.customer_summary(warehouse.table(CUSTOMERS)))
    warehouse.publish("gold.ops_quality", states.ops_quality(weeks))
    sheet = read_price_sheet(spark, inputs.price_sheet)
    priced = prices.item_prices(items, found, menu, sheet)
    warehouse.publish("gold.item_prices", priced, measure={"unknown": quality.unknown_prices()})
    totals = warehouse.table(TOTALS).first()
    # An order without an id is one order, but no id: its rows are repeats.
    ids = weeks.agg(F.coalesce(F.sum("id_count"), F.lit(0))).first()[0]
    measured = {
        "duplicate_order_ids_bronze": totals.rows - ids,
        "unparsed_order_placed_at": 0,  # else the build has stopped before
        "unparsed_item_quantity": totals.unparsed_quantities,
        "items_with_unknown_price": warehouse.measured["gold.item_prices"]["unknown"],
    }
    ranges = file_ranges(warehouse.table(INDEX))
    warehouse.publish("gold.data_quality", quality.measured_data_quality(ranges, found, items, measured))
    # The direct channel is optional: without it the table has one channel.
    direct = warehouse.table("silver.direct_orders") if warehouse.exists("silver.direct_orders") else None
    warehouse.publish("gold.combined_weekly_sales", states.combined_weekly_sales(weeks, direct))


def build_rest(warehouse: Warehouse, inputs: Inputs) -> None:
    """All but the export tables."""
    build_menu(warehouse, inputs)
    if inputs.direct_orders:
        build_direct(warehouse, inputs.direct_orders, inputs.one_per_line)
    if inputs.loyalty:
        build_loyalty(warehouse, inputs.loyalty, inputs.one_per_line)
    if inputs.tables:
        build_mirror(warehouse, inputs.tables, inputs.one_per_line)
    build_gold(warehouse, inputs)


def build(spark: SparkSession, root: str, inputs: Inputs) -> Warehouse:
    """Refresh every table whose input is given, all of them together: an input
    that fails leaves every table as it was. Intermediate tables are removed at
    the end of a build, also of one that fails."""
    warehouse = Warehouse(spark, root)
    warehouse.create_layers()
    with staged_until_end(spark), warehouse.together():
        build_exports(warehouse, inputs)
        build_rest(warehouse, inputs)
    spark.sql(f"DROP TABLE IF EXISTS {OPEN_REFRESH}")
    return warehouse
