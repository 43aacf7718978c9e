"""The whole way from files to published tables, and refreshes of it."""

import json
import os

import pytest

import fixtures
from tallyhouse.__main__ import main
from tallyhouse.plans.build import Inputs, build
from tallyhouse.publish import Warehouse
from tallyhouse.schemas import EXPORT_COLUMNS, ITEMS_COLUMN
from tallyhouse.streaming import incremental

HEADER = [header for header, _, _ in EXPORT_COLUMNS] + [ITEMS_COLUMN]


def export(folder, name, orders, extra=()):
    lines = [",".join(f'"{h}"' for h in [*HEADER, *extra])]
    for o in orders:
        cells = {"Restaurant ID": "r", "Restaurant name": "R", "Order Placed At": "08:05 PM, August 03 2026", **o}
        lines.append(",".join('"' + str(cells.get(h, "")).replace('"', '""') + '"' for h in [*HEADER, *extra]))
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def order(number, items, bill, status="Delivered", customer="c1", **more):
    return {
        "Order ID": number, "Order Status": status, "Bill subtotal": bill, "Total": bill, "Customer ID": customer,
        ITEMS_COLUMN: items, **more,
    }


@pytest.fixture
def inputs(tmp_path):
    exports = tmp_path / "exports"
    exports.mkdir()
    export(exports, "order_history_20260803_20260809.csv", [order("1", "1 x Tea", 10), order("2", "1 x Tea, 2 x Bun", 30)])
    export(
        exports,
        "order_history_20260817_20260823.csv",
        [order("2", "1 x Tea, 2 x Bun", 34, note="x"), order("3", "", 5, status="Cancelled", customer="")],
        extra=["note"],
    )
    (tmp_path / "menu.csv").write_text(
        "item_name,category,subcategory,is_veg,size,list_price,unit_cost,active\nTea,Drinks,,true,,12,3,true\n"
    )
    (tmp_path / "direct.json").write_text(
        json.dumps(
            {
                "ok": True,
                "generated_at": "2026-08-29T10:00:00Z",
                "orders": [
                    {
                        "order_id": 1, "status": "confirmed", "order_type": "pickup", "food_total": 90, "delivery_fee": 0,
                        "total": 90, "created_at": "2026-08-05T10:00:00Z", "confirmed_at": "2026-08-05T10:01:00Z",
                        "customer_phone": "p", "customer_name": "n", "items": [{"catalog_id": "t", "name": "Tea", "qty": 2, "unit_price": 45}],
                    }
                ],
            }
        )
    )
    (tmp_path / "loyalty.json").write_text(
        json.dumps(
            {
                "ok": True,
                "ledger": [{"id": 1, "customer_id": 1, "customer_phone": "p", "delta": 9, "kind": "earn"}],
                "balances": [{"customer_id": 1, "phone": "p", "name": "n", "dough_balance": 10}],
            }
        )
    )
    (tmp_path / "tables.json").write_text(
        json.dumps(
            {
                "ok": True,
                "generated_at": "2026-08-29T10:00:00Z",
                "tables": {"settings": {"columns": ["key", "n"], "rows": [["open", 1]]}, "waiting": {"columns": [], "rows": []}},
                "failed": {"lost": "timeout"},
            }
        )
    )
    return Inputs(
        str(exports),
        str(tmp_path / "menu.csv"),
        None,
        str(tmp_path / "direct.json"),
        str(tmp_path / "loyalty.json"),
        str(tmp_path / "tables.json"),
    )


@pytest.fixture(autouse=True)
def clean_catalog(spark):
    yield
    for layer in ("bronze", "silver", "gold", "d1"):
        spark.sql(f"DROP NAMESPACE IF EXISTS {layer} CASCADE")


def table(spark, name, *columns):
    return sorted(map(tuple, spark.table(name).select(*columns).collect()), key=repr)


def test_full_build(spark, tmp_path, inputs):
    warehouse = build(spark, str(tmp_path / "root"), inputs)
    assert table(spark, "silver.orders", "order_id", "total", "customer_order_seq", "is_first_order") == [
        ("1", 10.0, 1, True),
        ("2", 34.0, 2, False),
        ("3", 5.0, 1, True),
    ]
    # Order 2 was exported twice, and its lines count twice.
    assert table(spark, "gold.item_performance", "item_name", "times_ordered", "total_qty") == [("Bun", 2, 4), ("Tea", 3, 3)]
    # With the lines of order 2 doubled, its bill has two open entries and solves nothing.
    assert table(spark, "gold.item_prices", "item_name", "unit_price", "confidence") == [("Bun", None, "unknown"), ("Tea", 10.0, "observed")]
    assert [tuple(r) for r in spark.table("gold.data_quality").select("check_name", "status", "value").collect()] == [
        ("missing_week_gaps", "warn", 1),
        ("duplicate_order_ids_bronze", "fail", 1),
        ("unparsed_order_placed_at", "ok", 0),
        ("unparsed_item_quantity", "ok", 0),
        ("orders_with_no_items", "fail", 1),
        ("items_with_unknown_price", "warn", 1),
    ]
    assert table(spark, "gold.combined_weekly_sales", "source", "order_count", "confirmed_count", "revenue") == [
        ("direct", 1, 1, 90.0),
        ("zomato", 3, 2, 44.0),
    ]
    assert table(spark, "gold.dough_balance_check", "customer_id", "difference") == [(1, 1)]
    assert table(spark, "gold.dough_customers", "phone", "earned_all_time") == [("p", 9)]
    assert spark.table("bronze.order_history_raw").columns.count("note") == 1
    assert table(spark, "d1.settings", "key", "n") == [("open", 1)]
    assert not spark.catalog.tableExists("d1.waiting")
    report = {r.table: (r.rows, r.note) for r in warehouse.report().collect()}
    assert report["silver.orders"] == (3, "") and report["bronze.order_history_raw"] == (4, "files: 2")
    assert report["silver.menu_items"] == (1, "unmatched order_items rows: 2")
    assert report["gold.dough_balance_check"][0] == 1 and "timeout" in report["d1.lost"][1]

    # The same again changes nothing; a view follows its tables.
    before = {name: table(spark, name, "*") for name in ("silver.order_items", "gold.item_prices", "gold.customer_summary")}
    (tmp_path / "loyalty.json").write_text(json.dumps({"ok": True, "balances": []}))
    build(spark, str(tmp_path / "root"), inputs)
    assert before == {name: table(spark, name, "*") for name in before}
    assert table(spark, "gold.dough_customers", "phone") == []


def test_partitions_and_versions(spark, tmp_path):
    root = tmp_path / "root"
    warehouse = Warehouse(spark, str(root))
    warehouse.create_layers()
    for n in (1, 2, 3):
        rows = spark.sql(f"SELECT DATE'2026-08-01' AS month, id FROM range({n}) UNION ALL SELECT CAST(NULL AS DATE), 7L")
        found = warehouse.publish("silver.t", rows, partition_by="month")
        assert found.columns == ["id", "month"] and found.count() == n + 1
        assert [r.id for r in found.filter("month IS NULL").collect()] == [7]
        assert len(list((root / "silver" / "t").iterdir())) == min(n, 2)
    pruned = found.filter("month = DATE'2026-08-01'")
    assert pruned.count() == 3
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert warehouse.publish("silver.t", spark.range(4)).count() == 4
    assert warehouse.publish("silver.t", spark.range(0), partition_by=None).count() == 0


def test_staged_tables_go_with_the_build(spark, tmp_path, inputs):
    from tallyhouse import staging

    made = []
    with staging.staged_until_end(spark):
        kept = staging.stage(spark.range(3), "inside")
        made.append(kept.inputFiles()[0].removeprefix("file://"))
        assert os.path.exists(made[0])
    assert not os.path.exists(made[0])
    outside = staging.stage(spark.range(3), "outside")
    folder = staging.stage_root(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    build(spark, str(tmp_path / "root"), Inputs(inputs.exports, inputs.menu))
    assert set(os.listdir(folder)) == before and outside.count() == 3


def test_failed_inputs_leave_the_tables(spark, tmp_path, inputs):
    build(spark, str(tmp_path / "root"), inputs)
    sales = table(spark, "gold.weekly_sales", "*")
    export(tmp_path / "exports", "order_history_20260824_20260830.csv", [order("4", "1 x Tea", 10, **{"Order Placed At": "soon"})])
    with pytest.raises(ValueError, match="1 export rows"):
        build(spark, str(tmp_path / "root"), inputs)
    assert len(table(spark, "silver.orders", "order_id")) == 3 and table(spark, "gold.weekly_sales", "*") == sales
    (tmp_path / "exports" / "order_history_20260824_20260830.csv").write_text("Order ID\n")
    (tmp_path / "direct.json").write_text('{"ok": false}')
    with pytest.raises(Exception, match="refused"):
        build(spark, str(tmp_path / "root"), inputs)
    assert len(table(spark, "silver.direct_orders", "order_id")) == 1 and table(spark, "gold.weekly_sales", "*") == sales


def test_without_snapshots(spark, tmp_path, inputs):
    build(spark, str(tmp_path / "root"), Inputs(inputs.exports, inputs.menu))
    assert table(spark, "gold.combined_weekly_sales", "source") == [("zomato",)]


def test_command_line(spark, tmp_path, inputs, capfd):
    (tmp_path / "sheet.csv").write_text("item_name,zomato_list_price\nTea,99\n")
    args = [
        "--root", str(tmp_path / "root"), "--exports", inputs.exports, "--menu", inputs.menu,
        "--price-sheet", str(tmp_path / "sheet.csv"), "--if-changed",
    ]
    assert main(args, spark)
    assert table(spark, "gold.item_prices", "item_name", "unit_price", "confidence") == [("Bun", None, "unknown"), ("Tea", 99.0, "sheet")]
    assert not main(args, spark)
    (tmp_path / "sheet.csv").write_text("")
    assert main(args, spark)
    assert ("Tea", 10.0) in table(spark, "gold.item_prices", "item_name", "unit_price")


def test_rebuild_if_changed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.create_layers()
    built = []

    def run():
        return incremental.rebuild_if_changed(warehouse, str(folder), lambda: built.append(1))

    (folder / "a.csv").write_text("A\n1\n")
    assert [run(), run()] == [True, False]
    (folder / "b.csv").write_text("A\n1\n")
    (folder / "a.csv").write_text("A\n1\n2\n")
    now = incremental.list_files(spark, str(folder))
    changes = incremental.manifest_changes(warehouse.table(incremental.MANIFEST), now)
    assert sorted((r.file_path.rsplit("/", 1)[1], r.change) for r in changes.collect()) == [("a.csv", "changed"), ("b.csv", "added")]
    with pytest.raises(ZeroDivisionError):
        incremental.rebuild_if_changed(warehouse, str(folder), lambda: 1 / 0)
    assert [run(), run()] == [True, False]
    (folder / "b.csv").unlink()
    assert run() and len(built) == 3


def test_incremental_ingest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    bronze, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

    def ingest():
        incremental.ingest_new_files(spark, str(folder), bronze, progress, files_per_batch=1)
        return sorted((r.A, r.B) for r in incremental.current_rows(spark, bronze, ["A"]).collect())

    (folder / "a.csv").write_text("A,B\n1,old\n2,old\n2,newer row\n")
    assert ingest() == [("1", "old"), ("2", "newer row")]
    assert ingest() == [("1", "old"), ("2", "newer row")]
    (folder / "b.csv").write_text("C,B,A\nx,new,1\n,new,3\n")
    (folder / "c.csv").write_text("A,B\n")
    assert ingest() == [("1", "new"), ("2", "newer row"), ("3", "new")]
    every = incremental.read_bronze(spark, bronze)
    assert every.count() == 5 and set(every.columns) >= {"A", "B", "C", "_row_seq", "_batch"}
    assert every.select("_row_seq").distinct().count() == 5


def test_both_channels_are_made_of_lines_stored_once(spark, tmp_path):
    rows = {
        "orders": "SELECT id AS o_orderkey, id % 3 AS o_custkey, if(id = 2, 'P', 'F') AS o_orderstatus, 10.5D * id AS o_totalprice, "
        "TIMESTAMP '2026-08-03 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 4)",
        "customer": "SELECT id AS c_custkey FROM range(3)",
        "part": "SELECT id AS p_partkey, concat('part ', id) AS p_name FROM range(5)",
        "lineitem": "SELECT 1 + id % 2 AS l_orderkey, id % 5 AS l_partkey, id AS l_suppkey, id AS l_linenumber, 2D AS l_quantity, 1D AS l_extendedprice, "
        "0D AS l_discount, 0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP '2026-08-03 00:00:00' AS l_shipdate FROM range(8)",
    }
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    views, where = ("fx_bronze", "fx_direct_json"), str(tmp_path)
    taken = lambda: [sorted(map(tuple, fixtures.view(spark, where, v).collect()), key=repr) for v in views]
    alone = taken()
    with fixtures.stored_once(spark, where, "fx_order_lines"):
        assert taken() == alone
        for v in views:
            assert "lineitem" not in fixtures.view(spark, where, v)._jdf.queryExecution().executedPlan().toString()
    assert taken() == alone and [len(a) for a in alone] == [4, 3]
    assert [json.loads(raw)["items"][0]["name"] for _, raw in alone[1] if json.loads(raw)["items"]] == ["part 0", "part 1"]
