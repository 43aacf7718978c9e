import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.plans import loyalty, orders, sales


def test_missing_status_is_in_neither_count(spark):
    data = [("Delivered", 10.0), (None, 5.0), ("Cancelled", 7.0)]
    df = spark.createDataFrame(data, "order_status string, total double").selectExpr(
        "'r' restaurant_id", "'R' restaurant_name", "timestamp_ntz '2026-08-26 10:00:00' order_placed_at",
        "order_status", "total", "cast(null as double) rating",
    )
    row = sales.weekly_sales(df).first()
    assert (row.order_count, row.delivered_count, row.cancelled_count) == (3, 1, 1)
    assert (row.total_revenue, row.avg_order_value, row.avg_rating) == (10.0, 10.0, None)
    assert row.week_start == dt.datetime(2026, 8, 24)


def test_output_order_puts_nulls_last(spark):
    df = spark.createDataFrame([(2.0,), (None,), (1.0,)], "total double").selectExpr(
        "'r' restaurant_id", "'R' restaurant_name", "string(total) customer_id", "'Delivered' order_status", "total",
        "timestamp_ntz '2026-08-26 10:00:00' order_placed_at", "1.0D rating",
    )
    assert [r.total_spend for r in sales.customer_summary(df).collect()] == [2.0, 1.0, None]


def test_item_without_any_quantity(spark):
    items = spark.createDataFrame([("1", "a", None), ("1", "b", 2), ("9", "b", 5)], "order_id string, item_name string, quantity int")
    found = spark.createDataFrame([("1", "r", "R"), (None, "r", "R")], "order_id string, restaurant_id string, restaurant_name string")
    got = [tuple(r)[2:] for r in sales.item_performance(items, found).collect()]
    assert got == [("b", 1, 2), ("a", 1, None)]


def test_stock_skips_undone_moves_where_known(spark):
    batches = spark.createDataFrame([(1, "bread"), (2, "bread"), (3, "milk")], "id int, sku string")
    moves = spark.createDataFrame(
        [(1, "sold", -2, None), (2, "sold", -3, None), (2, "wasted", -1, "x"), (3, "received", 9, None)],
        "batch_id int, reason string, delta int, undone_at string",
    )
    assert [tuple(r) for r in sales.stock_sold_vs_wasted(moves, batches).collect()] == [("bread", 5, 0), ("milk", 0, 0)]
    older = moves.drop("undone_at")
    assert [tuple(r) for r in sales.stock_sold_vs_wasted(older, batches).collect()] == [("bread", 5, 1), ("milk", 0, 0)]


def test_two_phones_are_checked_twice(spark, rows):
    ledger = spark.createDataFrame([(1, "a", 10), (1, "b", 5), (2, "c", 7), (None, "d", 1)], "customer_id int, customer_phone string, delta int")
    balances = spark.createDataFrame(
        [(1, "a", "A", 15), (2, "c", "C", 7), (3, "e", "E", 4), (4, "f", "F", 0), (5, "g", "G", None), (None, "h", "H", 1)],
        "customer_id int, phone string, name string, balance_cached int",
    )
    got = loyalty.balance_check(balances, loyalty.balances_from_ledger(ledger))
    assert rows(got) == [
        (1, "a", "A", 15, 10, 5),
        (1, "a", "A", 15, 5, 10),
        (3, "e", "E", 4, None, None),
        (None, "h", "H", 1, None, None),
    ]


def test_equal_cards_merge(spark, rows):
    balances = spark.createDataFrame(
        [(1, "p", "N", 3), (2, "p", "N", 3), (3, "q", "M", None)], "customer_id int, phone string, name string, balance_cached int"
    ).selectExpr("*", "cast(null as timestamp_ntz) expires_at", "cast(null as string) referral_code")
    ledger = spark.createDataFrame(
        [(1, 5, "earn"), (1, -2, "spend"), (2, 4, "referral"), (2, -1, "expire")], "customer_id int, delta int, kind string"
    )
    got = loyalty.customers(balances, ledger)
    assert rows(got, "phone", "balance", "earned_all_time", "spent_all_time", "referral_entries") == [
        ("p", 3, 9, 2, 1),
        ("q", None, 0, 0, 0),
    ]
    assert rows(loyalty.find_customers(got, "p"), "phone") == [("p",)]


def test_orders_from_text(spark):
    from tallyhouse.schemas import EXPORT_COLUMNS

    def row(seq, file, **cells):
        blank = {header: "" for header, _, _ in EXPORT_COLUMNS}
        return {**blank, "Order Placed At": "08:05 PM, August 03 2026", **cells, "_row_seq": seq, "_source_file": file}

    data = [
        row(1, "a", **{"Order ID": "1", "Total": "10", "Customer ID": "c", "Order Status": " Delivered "}),
        row(2, "b", **{"Order ID": "1", "Total": "12", "Customer ID": "c", "Distance": "<1km", "Review": "ok"}),
        row(3, "b", **{"Order ID": "2", "Total": "x", "Customer ID": None, "Order Placed At": "07:05 PM, August 03 2026"}),
        row(4, "b", **{"Order ID": "3", "Total": "1", "Customer ID": None, "Order Placed At": None}),
    ]
    columns = ", ".join(f"`{h}` string" for h, _, _ in EXPORT_COLUMNS)
    raw = spark.createDataFrame(data, f"{columns}, _row_seq long, _source_file string").withColumn(
        "_loaded_at", F.current_timestamp()
    )
    got = {r.order_id: r for r in orders.orders(raw).collect()}
    assert len(got) == 3
    assert (got["1"].total, got["1"].distance_km, got["1"].review, got["1"].instructions) == (12.0, 1.0, "ok", None)
    assert got["1"].order_placed_at == dt.datetime(2026, 8, 3, 20, 5) and got["1"].is_first_order
    assert [(got[o].customer_order_seq, got[o].is_first_order) for o in ("2", "3")] == [(1, True), (2, False)]
    assert got["2"].total is None and got["1"].customer_phone is None
    # The same with every customer taken for a large one.
    assert sorted(map(repr, orders.orders(raw, hot_rows=0, slice_rows=1).drop("_loaded_at").collect())) == sorted(
        map(repr, orders.orders(raw).drop("_loaded_at").collect())
    )


def test_hot_order_is_split_in_the_join(spark):
    """Two thirds of the lines belong to one order; its partition is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(0, 30000, 1, 12).selectExpr(
            "if(id % 3 = 0, id, 1) order_id", "uuid() item_name", "1 quantity"
        )
        found = spark.range(30000).selectExpr("id order_id", "'r' restaurant_id", "'R' restaurant_name")
        got = sales.item_performance(items, found)
        assert sum(r.times_ordered for r in got.collect()) == 30000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
