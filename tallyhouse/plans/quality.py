"""The six standing data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import blank_to_null, try_order_time
from ..operators.gaps import range_gaps
from ..schemas import CHECKS
from .sales import orders_without_items


def unparsed_times() -> Column:
    """Raw rows whose order time cannot be read."""
    placed = F.col("`Order Placed At`")
    return F.count_if(blank_to_null(placed).isNotNull() & try_order_time(placed).isNull())


def unparsed_quantities() -> Column:
    return F.count_if(F.col("quantity").isNull())


def unknown_prices() -> Column:
    return F.count_if(F.col("confidence") == "unknown")


def export_checks(exports: DataFrame) -> DataFrame:
    """Repeated order ids and unreadable order times, in one pass over the raw
    rows. Run it before the strict parse, which stops at the first bad time."""
    repeated = F.count(F.lit(1)) - F.countDistinct("`Order ID`")
    return exports.agg(repeated.alias("duplicates"), unparsed_times().alias("unparsed"))


def data_quality(
    ranges: DataFrame,
    exports: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    prices: DataFrame,
) -> DataFrame:
    """``check_name, status, detail, value``, in fixed order."""
    scanned = [
        (export_checks(exports), {"duplicate_order_ids_bronze": "duplicates", "unparsed_order_placed_at": "unparsed"}),
        (items.agg(unparsed_quantities().alias("n")), {"unparsed_item_quantity": "n"}),
        (prices.agg(unknown_prices().alias("n")), {"items_with_unknown_price": "n"}),
    ]
    return _checks(ranges, orders, items, scanned)


def measured_data_quality(ranges: DataFrame, orders: DataFrame, items: DataFrame, measured: dict[str, int]) -> DataFrame:
    """The same, where the counts by check name were taken while the tables were written."""
    counts = [F.lit(n).cast("long").alias(name) for name, n in measured.items()]
    return _checks(ranges, orders, items, [(ranges.sparkSession.range(1).select(*counts), {name: name for name in measured})])


def _checks(ranges: DataFrame, orders: DataFrame, items: DataFrame, counted: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """``counted``: tables of one row, with the column that holds the number of each check."""
    # At most one gap per start date: the list stays as short as the calendar.
    gaps = range_gaps(ranges).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("gap_start", "gap_end"))).alias("gaps"),
    )
    spans = F.transform("gaps", lambda g: F.concat(g.gap_start.cast("string"), F.lit(" to "), g.gap_end.cast("string")))
    listed = F.when(F.col("n") > 0, F.array_join(spans, ", ")).otherwise("none")
    empty_orders = orders_without_items(orders.select("order_id"), items).agg(F.count(F.lit(1)).alias("n"))
    counted = [(gaps, {"missing_week_gaps": "n"}), *counted, (empty_orders, {"orders_with_no_items": "n"})]
    known = {name: (place, bad, text) for place, (name, bad, text) in enumerate(CHECKS)}

    def row(name: str, value: Column) -> Column:
        place, bad, text = known[name]
        detail = F.concat(F.lit(text), listed) if name == "missing_week_gaps" else F.concat(value.cast("string"), F.lit(text))
        return F.struct(
            F.lit(place).alias("_place"),
            F.lit(name).alias("check_name"),
            F.when(value > 0, bad).otherwise("ok").alias("status"),
            detail.alias("detail"),
            value.cast("int").alias("value"),
        )

    rows = [source.select(F.inline(F.array(*[row(name, F.col(of)) for name, of in names.items()]))) for source, names in counted]
    return reduce(DataFrame.unionByName, rows).orderBy("_place").drop("_place")
