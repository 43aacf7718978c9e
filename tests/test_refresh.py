"""Refresh by change against plain calculation from all files; versions; kept states."""

import datetime as dt
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import orders, prices, quality, refresh, sales, states
from tallyhouse.plans.build import INDEX, OPEN_REFRESH, Inputs, build, build_exports
from tallyhouse.publish import Warehouse
from tallyhouse.sources import exports, reference_csv

from test_build import clean_catalog, export, order  # noqa: F401

MONTHS = ["May", "June", "July", "August"]


def drawn(rng, first, last, **more):
    """Orders with ids in a range, of few customers, over several months."""
    rows = []
    for number in range(first, last):
        items = ", ".join(f"{rng.randrange(1, 4)} x {rng.choice(['Tea', 'Bun', 'Pie', 'Rice, large'])}" for _ in range(rng.randrange(1, 4)))
        placed = f"{rng.randrange(1, 13):02d}:{rng.randrange(60):02d} {rng.choice(['AM', 'PM'])}, {rng.choice(MONTHS)} {rng.randrange(1, 29):02d} 2026"
        rows.append(
            order(
                str(number), items, rng.choice([10, 20.5, 33.335, ""]), rng.choice(["Delivered", "Delivered", "Cancelled", ""]), rng.choice(["c1", "c2", "c3", ""]),
                **{"Order Placed At": placed, "Rating": rng.choice(["", "4", "5"]), "KPT duration (minutes)": rng.choice(["", "12.5", "9"]), **more},
            )
        )
    return rows


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    rng = random.Random(1)
    export(folder, "order_history_20260601_20260607.csv", drawn(rng, 0, 25))
    export(folder, "order_history_20260608_20260614.csv", drawn(rng, 15, 40))
    (tmp_path / "menu.csv").write_text(
        "item_name,category,subcategory,is_veg,size,list_price,unit_cost,active\nTea,Drinks,,true,,12,3,true\nPie,Cakes,,true,,30,3,true\n"
    )
    return Inputs(str(folder), str(tmp_path / "menu.csv"))


def cells(df):
    # Load times differ, and row numbers only follow the files' order.
    return sorted(repr(tuple(sorted(r.asDict().items()))) for r in df.drop("_loaded_at", "_row_seq", "_file_id").collect())


def expected(spark, inputs):
    """Every table from all files, by the plans that read orders and not states."""
    raw = exports.read_exports(spark, inputs.exports).cache()
    found = states.with_month(orders.orders(raw)).cache()
    items, menu = orders.order_items(raw).cache(), reference_csv.read_menu(spark, inputs.menu)
    priced = prices.item_prices(items, found, menu, reference_csv.read_price_sheet(spark, None))
    ranges = exports.file_ranges(exports.list_files(spark, inputs.exports))
    return {
        "silver.orders": found,
        "silver.order_items": items,
        "gold.weekly_sales": sales.weekly_sales(found),
        "gold.item_performance": sales.item_performance(items, found),
        "gold.customer_summary": sales.customer_summary(found),
        "gold.ops_quality": sales.ops_quality(found),
        "gold.item_prices": priced,
        "gold.combined_weekly_sales": sales.combined_weekly_sales(found),
        "gold.data_quality": quality.data_quality(ranges, raw, found, items, priced),
        "silver.week_states": states.week_states(found),
        "silver.customer_states": states.customer_states(found),
    }


def same_as_expected(spark, inputs):
    for name, wanted in expected(spark, inputs).items():
        assert cells(spark.table(name)) == cells(wanted), name


def month_files(root):
    found = {}
    for folder, _, names in os.walk(f"{root}/silver/orders"):
        if "order_month=" in folder:
            found.setdefault(folder.rsplit("=", 1)[1], set()).update(n for n in names if n.endswith(".parquet"))
    return found


def test_refresh_equals_a_full_build(spark, tmp_path, inputs):
    rng, root, folder = random.Random(2), str(tmp_path / "root"), tmp_path / "exports"
    refresh.refresh(spark, root, inputs)  # nothing there yet: a full build

    # two drops: a late file with new orders and re-exports; then one between two others with a new
    # column, an edited file, and a file of no bytes, which covers its week
    export(folder, "order_history_20260615_20260621.csv", drawn(rng, 35, 50))
    report = refresh.refresh(spark, root, inputs).report()
    assert report.filter("table = 'silver.orders' and note = 'months written'").count() == 1
    export(folder, "order_history_20260609_20260610.csv", drawn(rng, 5, 12, note="x"), extra=["note"])
    export(folder, "order_history_20260608_20260614.csv", drawn(rng, 20, 30))
    (folder / "order_history_20260701_20260707.csv").write_text("")
    catch_up(spark, root, inputs)
    assert spark.table("bronze.order_history_raw").filter("note = 'x'").count() == 7

    # a withdrawn file: its orders fall back to the newest one left, or go
    (folder / "order_history_20260615_20260621.csv").unlink()
    refresh.refresh(spark, root, inputs)
    same_as_expected(spark, inputs)


def catch_up(spark, root, inputs):
    """The export tables alone."""
    warehouse = Warehouse(spark, root)
    with warehouse.together():
        return refresh.refresh_exports(warehouse, inputs, refresh.changes(warehouse, inputs))


def test_untouched_months_keep_their_files(spark, tmp_path, inputs):
    root, folder = str(tmp_path / "root"), tmp_path / "exports"
    warehouse = Warehouse(spark, root)
    warehouse.create_layers()
    with warehouse.together():
        build_exports(warehouse, inputs)
    before = month_files(root)
    late = [order("900", "1 x Tea", 10, customer="c1", **{"Order Placed At": "08:05 PM, September 03 2026"})]
    late += [order("901", "1 x Bun", 10, customer="c9", **{"Order Placed At": "08:05 PM, March 03 2026"})]
    export(folder, "order_history_20260622_20260628.csv", late)
    assert len(catch_up(spark, root, inputs)) == 2
    after = month_files(root)
    assert set(after) == {*before, "2026-09-01", "2026-03-01"} and all(after[m] == before[m] for m in before)

    # an early order of a known customer: the months behind it shift; its month goes with the file
    early = [order("901", "1 x Bun", 10, customer="c1", **{"Order Placed At": "08:05 PM, March 03 2026"})]
    export(folder, "order_history_20260629_20260705.csv", early)
    catch_up(spark, root, inputs)
    assert cells(spark.table("silver.orders")) == cells(states.with_month(orders.orders(exports.read_exports(spark, inputs.exports))))
    for name in ("order_history_20260622_20260628.csv", "order_history_20260629_20260705.csv"):
        (folder / name).unlink()
    catch_up(spark, root, inputs)
    assert set(month_files(root)) == set(before)
    assert cells(spark.table("silver.orders")) == cells(states.with_month(orders.orders(exports.read_exports(spark, inputs.exports))))


def test_refresh_reads_the_months_by_their_folders(spark, tmp_path, inputs):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.create_layers()
    build_exports(warehouse, inputs)
    found = spark.table("silver.orders").filter(refresh._in([dt.date(2026, 6, 1)]))
    plan = states.week_states(found)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert found.count() == spark.table("silver.orders").filter("order_month = DATE'2026-06-01'").count() > 0


def test_a_refresh_that_failed_is_mended_by_a_build(spark, tmp_path, inputs, monkeypatch):
    root = str(tmp_path / "root")
    build(spark, root, inputs)
    export(tmp_path / "exports", "order_history_20260615_20260621.csv", drawn(random.Random(3), 30, 50))
    replace, done = Warehouse.replace_partitions, []

    def fails(self, name, *rest):
        if name == "silver.orders":
            raise RuntimeError("lost")
        done.append(name)
        return replace(self, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "replace_partitions", fails)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.refresh(spark, root, inputs)
    assert done and spark.catalog.tableExists(OPEN_REFRESH)
    assert refresh.changes(Warehouse(spark, root), inputs) is None
    refresh.refresh(spark, root, inputs)
    assert not spark.catalog.tableExists(OPEN_REFRESH)
    assert cells(spark.table("silver.orders")) == cells(states.with_month(orders.orders(exports.read_exports(spark, inputs.exports))))

    # rows that cannot be read change nothing
    export(tmp_path / "exports", "order_history_20260622_20260628.csv", [order("77", "1 x Tea", 10, **{"Order Placed At": "soon"})])
    before = spark.table("bronze.order_history_raw").count()
    with pytest.raises(ValueError, match="1 export rows"):
        refresh.refresh(spark, root, inputs)
    assert spark.table("bronze.order_history_raw").count() == before and spark.table(INDEX).count() == 3


def test_ranks_leave_room(spark):
    names = ["b", "d", "f"]
    known = exports.ranked(spark.createDataFrame([(n,) for n in names], "file_path string")).cache()
    now = spark.createDataFrame([(n,) for n in ["a", "b", "c1", "c2", "d", "g", "h"]], "file_path string")
    found = exports.ranked(now, known)
    by = {r.file_path: r["rank"] for r in found.collect()}
    assert [by[n] for n in sorted(by)] == sorted(set(by.values()))
    assert all(by[r.file_path] == r["rank"] for r in known.collect() if r.file_path != "f")
    tight = spark.createDataFrame([("a", 1), ("c", 2)], "file_path string, rank long")
    crowded = exports.ranked(spark.createDataFrame([(n,) for n in "abc"], "file_path string"), tight)
    assert [r["rank"] for r in crowded.orderBy("file_path").collect()] == [1, None, 2]


def test_a_snapshot_is_of_one_build(spark, tmp_path):
    """A reader in a loop over two tables never sees one of a later build."""
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.create_layers()

    def write(n):
        with warehouse.together():
            warehouse.publish("silver.a", spark.range(1).select(F.lit(n).alias("n")))
            # another schema each time, so that names are dropped and made anew
            warehouse.publish("gold.b", spark.range(1).select(F.lit(n).alias("n"), F.lit(n).alias(f"c{n}")))

    write(0)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            found = warehouse.snapshot()
            seen.append((found.table("silver.a").first().n, found.table("gold.b").first().n))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        write(n)
    stop.set()
    reader.join()
    assert seen and all(a == b for a, b in seen)
    last = warehouse.snapshot()
    assert last.table("gold.b").first().n == spark.table("gold.b").first().n == 5

    with pytest.raises(RuntimeError), warehouse.together():
        warehouse.publish("silver.a", spark.range(3))
        assert warehouse.table("silver.a").count() == 3
        raise RuntimeError
    assert spark.table("silver.a").first().n == 5 and warehouse.snapshot().table("silver.a").first().n == 5
    with warehouse.together():
        warehouse.drop("silver.a", "gone")
        assert spark.catalog.tableExists("silver.a")
    assert not spark.catalog.tableExists("silver.a") and "silver.a" not in warehouse.snapshot().tables


def test_tables_of_another_root_are_not_taken(spark, tmp_path, inputs):
    """A direct channel that another warehouse left in the catalog is none of this one's."""
    other = Warehouse(spark, str(tmp_path / "other"))
    other.create_layers()
    spark.sql("DROP TABLE IF EXISTS silver.direct_orders")
    other.publish("silver.direct_orders", spark.range(3).selectExpr("id AS order_id"))
    mine = Warehouse(spark, str(tmp_path / "mine"))
    assert other.exists("silver.direct_orders") and not mine.exists("silver.direct_orders")
    refresh.refresh(spark, mine.root, inputs)
    assert spark.table("gold.combined_weekly_sales").filter("source = 'direct'").isEmpty()
    spark.sql("DROP TABLE silver.direct_orders")


def test_raw_rows_and_lines_are_written_without_a_shuffle(spark, tmp_path, inputs, monkeypatch):
    dealt, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *more: dealt.append(str(more[0])) or hint(self, name, *more))
    refresh.refresh(spark, str(tmp_path / "root"), inputs)
    assert dealt and not any("_file_id" in column for column in dealt)


def test_a_refresh_deals_whole_orders_twice(spark, tmp_path, inputs, monkeypatch):
    """Table and files meet in one shuffle and are numbered in one more; what was there before is looked up by keys alone."""
    root, kept, plain = str(tmp_path / "root"), {}, refresh.stage
    build(spark, root, inputs)
    monkeypatch.setattr(refresh, "stage", lambda df, label: kept.setdefault(label, plain(df, label)))
    export(tmp_path / "exports", "order_history_20260615_20260621.csv", drawn(random.Random(4), 30, 50))
    catch_up(spark, root, inputs)
    assert kept["orders-before"].columns == ["order_id", "customer_id", "order_month", "_source_file"]
    assert not {"orders-after", "orders-written", "new-lines"} & set(kept)
    assert cells(spark.table("silver.orders")) == cells(states.with_month(orders.orders(exports.read_exports(spark, inputs.exports))))


def test_a_row_that_a_newer_file_replaced_writes_no_month(spark, tmp_path, inputs):
    """A late file of an older week names a known order in another month, where it does not count."""
    root, folder = str(tmp_path / "root"), tmp_path / "exports"
    export(folder, "order_history_20260615_20260621.csv", [order("900", "1 x Tea", 10, **{"Order Placed At": "08:05 PM, September 03 2026"})])
    build(spark, root, inputs)
    before = month_files(root)
    export(folder, "order_history_20260101_20260107.csv", [order("900", "1 x Bun", 20, **{"Order Placed At": "08:05 PM, January 03 2026"})])
    assert catch_up(spark, root, inputs) == [dt.date(2026, 9, 1)]
    assert set(month_files(root)) == set(before)
    assert cells(spark.table("silver.orders")) == cells(states.with_month(orders.orders(exports.read_exports(spark, inputs.exports))))
    assert spark.table("silver.order_items").filter("order_id = '900'").count() == 2


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    """They do not pile up until the driver collects garbage, and the session keeps its own setting."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffles():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before, was = shuffles(), spark.conf.get(name, None)
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.create_layers()
    with warehouse.together():
        warehouse.publish("silver.a", spark.range(1000).repartition(5, "id"))
        warehouse.publish("silver.b", warehouse.table("silver.a").groupBy(F.col("id") % 7).count().withColumnRenamed("(id % 7)", "k"))
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(name, None) == was and spark.table("silver.b").count() == 7
