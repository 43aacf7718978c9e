import datetime as dt

from tallyhouse.plans import quality


def check(spark, ranges, bronze, order_ids, quantities, confidences):
    return [
        tuple(r)
        for r in quality.data_quality(
            spark.createDataFrame([(dt.date(2026, 1, a), dt.date(2026, 1, b)) for a, b in ranges], "start_date date, end_date date"),
            spark.createDataFrame(bronze, "`Order ID` string, `Order Placed At` string"),
            spark.createDataFrame([(o,) for o in order_ids], "order_id string"),
            spark.createDataFrame(quantities, "order_id string, quantity int"),
            spark.createDataFrame([(c,) for c in confidences], "confidence string"),
        ).collect()
    ]


GOOD = "08:05 PM, August 03 2026"


def test_all_well(spark):
    assert check(spark, [(1, 7), (8, 14)], [("1", GOOD), ("2", "")], ["1"], [("1", 2)], ["sheet"]) == [
        ("missing_week_gaps", "ok", "Weeks with no source CSV: none", 0),
        ("duplicate_order_ids_bronze", "ok", "0 duplicate Order ID rows in bronze.order_history_raw", 0),
        ("unparsed_order_placed_at", "ok", "0 bronze rows where Order Placed At failed to parse", 0),
        ("unparsed_item_quantity", "ok", "0 silver.order_items rows where quantity failed to parse", 0),
        ("orders_with_no_items", "ok", "0 orders in silver.orders with no matching line items", 0),
        ("items_with_unknown_price", "ok", "0 items in gold.item_prices with no resolvable price", 0),
    ]


def test_everything_wrong(spark):
    bronze = [("1", GOOD), ("1", "20:05, August 03 2026"), (None, "bad"), (None, None)]
    found = check(spark, [(22, 24), (1, 7), (12, 14)], bronze, ["1", "2", None], [("1", None), (None, 3)], ["unknown", "listed"])
    assert [(status, value) for _, status, _, value in found] == [
        ("warn", 2),
        ("fail", 3),  # rows without an id count as duplicates, like a plain distinct count has it
        ("fail", 2),
        ("fail", 1),
        ("fail", 2),
        ("warn", 1),
    ]
    assert found[0][2] == "Weeks with no source CSV: 2026-01-08 to 2026-01-11, 2026-01-15 to 2026-01-21"


def test_empty_warehouse(spark):
    assert {(status, value) for _, status, _, value in check(spark, [], [], [], [], [])} == {("ok", 0)}
