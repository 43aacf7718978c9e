import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.dates import week_start
from tallyhouse.functions.numbers import exact_avg, exact_sum, two_decimals
from tallyhouse.functions.text import dish_base, dish_size
from tallyhouse.plans.orders import order_items

TEXTS = {
    "plain": ("1 x Soup", [(1, 1, "Soup")]),
    "commas": ("1 x Pizza, Large, 2 x Fries", [(1, 1, "Pizza, Large"), (2, 2, "Fries")]),
    "blanks": ("  3  x   Tea ,  1 x Bun ", [(1, 3, "Tea"), (2, 1, "Bun")]),
    "no count": ("Soup of the day", [(1, None, "Soup of the day")]),
    "half": ("1 x Soup, extra x bread, 2xTea", [(1, 1, "Soup, extra x bread, 2xTea")]),
    "tight": ("2x Tea", [(1, 2, "Tea")]),
    "broken line": ("1 x Soup\nhot", [(1, None, "1 x Soup\nhot")]),
    "break after x": ("1 x \nSoup", [(1, 1, "Soup")]),
    "other breaks": ("1 x Soup\u0085hot\u2028", [(1, 1, "Soup\u0085hot")]),
    "empty name": ("1 x ", [(1, 1, "")]),
    "blank": ("  ", [(1, None, "")]),
    "dollar": ("2 x $1 Tea \\ Bun", [(1, 2, "$1 Tea \\ Bun")]),
    "empty": ("", []),
    "null": (None, []),
    "too many": ("99999999999 x Tea", [(1, None, "Tea")]),
}


def test_item_text(spark):
    data = [(key, text, i) for i, (key, (text, _)) in enumerate(TEXTS.items())]
    exports = spark.createDataFrame(data, "`Order ID` string, `Items in order` string, _row_seq long")
    got = {key: [] for key in TEXTS}
    for r in order_items(exports).orderBy("item_seq").collect():
        got[r.order_id].append((r.item_seq, r.quantity, r.item_name))
    assert got == {key: want for key, (_, want) in TEXTS.items()}


def test_item_text_round_trip(spark):
    rng = random.Random(3)
    names = ["Pizza [Small]", "Tea, hot", "Fries (7” x 2)", "Éclair", "x 2 y", "Bun, 3 kinds"]
    orders = {
        str(i): [(q, rng.choice(names)) for q in (rng.randint(1, 30) for _ in range(rng.randint(1, 6)))]
        for i in range(300)
    }
    data = [(k, ", ".join(f"{q} x {n}" for q, n in lines), int(k)) for k, lines in orders.items()]
    exports = spark.createDataFrame(data, "`Order ID` string, `Items in order` string, _row_seq long")
    got = {}
    for r in order_items(exports).orderBy("order_id", "item_seq").collect():
        got.setdefault(r.order_id, []).append((r.quantity, r.item_name))
    assert got == orders


@pytest.mark.parametrize(
    "name, base, size",
    [
        ("⭐️ Pizza [Small]", "pizza", "small"),
        ("Éclair", "éclair", ""),
        ("🔥Most Ordered  Fries (7” x)", "fries", ""),
        ("BESTSELLER Soup [ Large ] hot (new)", "soup hot", "large"),
        ("(Half) Soup", "(half) soup", ""),
        ("_Soup_", "_soup_", ""),
        ("Soup [A] [B]", "soup", "a"),
        ("Mostordered soup", "mostordered soup", ""),
        ("most ordered bestseller soup", "bestseller soup", ""),
        (None, "", ""),
    ],
)
def test_dish_key(spark, name, base, size):
    df = spark.createDataFrame([(name,)], "n string")
    assert tuple(df.select(dish_base(F.col("n")), dish_size(F.col("n"))).first()) == (base, size)


def test_two_decimals_is_python_round(spark):
    rng = random.Random(1)
    values = [2.675, 0.125, 1.005, 0.0, -0.125, -2.675, 1e12 + 0.005, 123456.785]
    values += [rng.randint(0, 10**7) / 1000 for _ in range(5000)] + [rng.uniform(-1e4, 1e4) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = [(r.v, r.w) for r in df.select("v", two_decimals(F.col("v")).alias("w")).collect() if round(r.v, 2) != r.w]
    assert wrong == []


def test_exact_sum(spark):
    rng = random.Random(2)
    cents = [rng.randint(-(10**9), 10**9) for _ in range(2000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    for parts in (1, 7):
        assert df.repartition(parts).agg(exact_sum(F.col("v"))).first()[0] == sum(cents) / 100
    mixed = spark.createDataFrame([(0.1,), (1 / 3,), (None,)], "v double")
    total, mean = mixed.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    assert total == pytest.approx(0.1 + 1 / 3) and mean == pytest.approx((0.1 + 1 / 3) / 2)
    none = mixed.filter("v is null").agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    assert tuple(none) == (None, None)
    odd = spark.createDataFrame([(float("inf"),), (1.5,)], "v double")
    assert odd.agg(exact_sum(F.col("v"))).first()[0] == float("inf")


def test_week_start(spark):
    df = spark.sql(
        "select week_day, timestamp_ntz '2026-08-24 00:00:00' + make_dt_interval(week_day, 23, 59) ts "
        "from (select explode(sequence(0, 6)) week_day)"
    )
    weeks = {str(r[0]) for r in df.select(week_start(F.col("ts"))).collect()}
    assert weeks == {"2026-08-24 00:00:00"}


def test_item_text_built_from_known_lines(spark):
    """Lines written in many odd ways: the answer is known from the writing."""
    rng = random.Random(7)
    blanks = ["", " ", "  ", "\t", " \t "]
    names = ["Soup", "Pizza, Large", "Éclair (x)", "Tea,hot", "2 for 1", "x", "Bun 3, kinds"]
    data, want = [], {}
    for i in range(400):
        lines = [(rng.randint(0, 99), rng.choice(names)) for _ in range(rng.randint(1, 5))]
        written = [f"{n}{rng.choice(blanks)}x{rng.choice(blanks[1:])}{name}{rng.choice(blanks)}" for n, name in lines]
        text = rng.choice(blanks) + written[0] + "".join("," + rng.choice(blanks) + line for line in written[1:])
        data.append((str(i), text, i))
        want[str(i)] = lines
    exports = spark.createDataFrame(data, "`Order ID` string, `Items in order` string, _row_seq long")
    got = {}
    for r in order_items(exports).orderBy("order_id", "item_seq").collect():
        got.setdefault(r.order_id, []).append((r.quantity, r.item_name))
    assert got == want
