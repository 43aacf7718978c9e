"""The price solver on orders whose prices are known from their making."""

import random

import pytest

from tallyhouse.plans import prices

SHEET = "item_name string, zomato_list_price double, sheet_seq long"


def run(spark, lines, bills, menu=(), sheet=()):
    items = spark.createDataFrame(
        [(o, i, q, n) for n, (o, i, q) in enumerate(lines)],
        "order_id string, item_name string, quantity int, _row_seq long",
    ).repartition(3)
    orders = spark.createDataFrame(list(bills.items()), "order_id string, bill_subtotal double")
    menu = [(n, p, k) for k, (n, p) in enumerate(menu)]
    menu = spark.createDataFrame(menu, "item_name string, list_price double, _row_seq long").repartition(3)
    sheet = spark.createDataFrame([(n, p, k) for k, (n, p) in enumerate(sheet)], SHEET)
    got = prices.item_prices(items, orders, menu, sheet).collect()
    assert len({r.item_name for r in got}) == len(got)
    return {r.item_name: (r.unit_price, r.confidence, r.sample_n) for r in got}


@pytest.mark.parametrize("seed", range(3))
def test_prices_known_from_construction(spark, seed):
    """Bills are made from prices, one new dish at a time, so all prices must come back."""
    rng = random.Random(seed)
    price = {f"dish {i}": rng.randint(100, 90000) / 100 for i in range(20)}
    names, lines, bills = list(price), [], {}
    for i, name in enumerate(names):
        for copy in range(rng.randint(1, 3)):
            entries = [(name, rng.randint(1, 3) if i else 1)]
            entries += [(rng.choice(names[:i]), rng.randint(1, 4)) for _ in range(min(i, 2))]
            rng.shuffle(entries)
            order = f"o{i}-{copy}"
            lines += [(order, item, quantity) for item, quantity in entries]
            bills[order] = round(sum(price[item] * quantity for item, quantity in entries), 2)
    lines += [("none", names[0], 1), ("none", "never billed", 1), ("text", names[1], None)]
    got = run(spark, lines, bills)
    assert {i: p[0] for i, p in got.items() if i != "never billed"} == pytest.approx(price, abs=0.005)
    assert got["never billed"] == (None, "unknown", None)
    assert {p[1] for i, p in got.items() if i != "never billed"} <= {"observed", "derived"}
    rng.shuffle(lines)
    assert {i: p[:2] for i, p in run(spark, lines, bills).items()} == {i: p[:2] for i, p in got.items()}


def test_lines_without_a_bill_leave_the_state(spark, monkeypatch):
    """Lines of billed orders are stored once; a round takes those of the items just found."""
    kept = []
    plain = prices.stage
    monkeypatch.setattr(prices, "stage", lambda df, label: kept.append((label, plain(df, label))) or kept[-1][1])
    lines = [("a", "d1", 1), ("b", "d1", 1), ("b", "d2", 1), ("c", "d3", 1), ("c", "d4", 1)]
    lines += [(f"no bill {i}", f"e{i % 7}", 1) for i in range(100)]
    run(spark, lines, {"a": 3.0, "b": 7.0, "c": 9.0})
    assert [df.count() for label, df in kept if label == "price-lines"][0] == 5
    assert [df.count() for label, df in kept if label == "price-lines"][1:] == []
    # d1 is seen on a bill and taken from two orders, then d2 from one; nothing is taken from c
    taken = [sorted(r.order_id for r in df.collect()) for label, df in kept if label == "price-round-lines"]
    assert taken == [["a", "b"], ["b"]]


def test_first_seen_value_wins_ties(spark):
    bills = {f"o{i}": v for i, v in enumerate([2.0, 1.0, 2.0, 1.0, 3.0])}
    lines = [(o, "tea", 1) for o in bills]
    assert run(spark, lines, bills)["tea"] == (2.0, "observed", 5)


def test_orders_that_cannot_be_solved(spark):
    lines = [
        ("twice", "bun", 1), ("twice", "bun", 1),
        ("zero", "pie", 0), ("zero", "tea", 1),
        ("tea", "tea", 1), ("tea", "note", None),
        ("no bill", "jam", 1),
        ("null bill", "egg", 1),
    ]
    got = run(spark, lines, {"twice": 20.0, "zero": 5.0, "tea": 5.0, "null bill": None})
    assert got["tea"] == (5.0, "observed", 1)  # the line without a quantity does not count
    assert {i for i, p in got.items() if p == (None, "unknown", None)} == {"bun", "pie", "note", "jam", "egg"}


def test_chain_takes_as_many_rounds_as_needed(spark):
    """Each order adds one unknown dish: the longest possible chain."""
    depth = 9
    lines, bills = [("o0", "d0", 1)], {"o0": 1.0}
    for i in range(1, depth):
        lines += [(f"o{i}", f"d{i - 1}", 2), (f"o{i}", f"d{i}", 1)]
        bills[f"o{i}"] = 2.0 * i + (i + 1.0)
    got = run(spark, lines, bills)
    assert {i: p[0] for i, p in got.items()} == {f"d{i}": i + 1.0 for i in range(depth)}


def test_sheet_then_bills_then_menu(spark):
    sheet = [
        ("Fries [Small]", 50.0), ("Fries [Large]", 80.0), ("Pizza [Regular]", 200.0), ("Soup", None), ("Tea", 9.0),
        ("tea", 11.0), ("Wrap [Big]", None),
    ]
    lines = [
        ("o1", "Fries", 1), ("o2", "🔥Pizza", 1), ("o3", "Pizza [Large]", 1), ("o4", "Soup", 1), ("o5", "TEA", 1),
        ("o6", "⭐️ Fries [small]", 1), ("o7", "Wrap", 2), ("o8", "Cake", 2),
    ]
    bills = {"o1": 55.0, "o2": 1.0, "o4": 60.0, "o5": 1.0}
    menu = [("Wrap", 30.0), ("Cake", None), ("Fries", 1.0), ("Wrap", 31.0), ("Wrap", None)]
    assert run(spark, lines, bills, menu, sheet) == {
        "Fries": (55.0, "observed", 1),  # two sizes on the sheet: no guess
        "🔥Pizza": (200.0, "sheet", None),
        "Pizza [Large]": (200.0, "sheet", None),  # the only size there is
        "Soup": (60.0, "observed", 1),  # on the sheet without a price
        "TEA": (9.0, "sheet", None),  # the first of two rows with the same key
        "⭐️ Fries [small]": (50.0, "sheet", None),
        "Wrap": (31.0, "listed", None),
        "Cake": (None, "unknown", None),
    }


def test_sheet_audit_text(spark):
    items = spark.createDataFrame([("o", "🔥Tea", 1, 0)], "order_id string, item_name string, quantity int, _row_seq long")
    orders = spark.createDataFrame([], "order_id string, bill_subtotal double")
    menu = spark.createDataFrame([], "item_name string, list_price double")
    sheet = spark.createDataFrame([("Tea", 3.5, 0)], SHEET)
    got = prices.item_prices(items, orders, menu, sheet).first()
    assert got.method == "data/price_sheet.csv zomato_list_price, matched to 'Tea'"


def test_half_of_all_lines_in_one_order(spark):
    """One order id, also a missing one, may hold much of the data."""
    lines = [(None, f"d{i % 5}", 1) for i in range(400)] + [(f"o{i}", f"d{i}", 1) for i in range(4)]
    bills = {f"o{i}": 10.0 + i for i in range(4)} | {None: 3280.0}
    # d4 appears eighty times in the large order, so it stays unknown.
    assert run(spark, lines, bills)["d4"] == (None, "unknown", None)
    lines = [line for line in lines if line[1] != "d4"] + [(None, "d4", 2)]
    assert run(spark, lines, bills)["d4"][1:] == ("derived", 1)
