"""One unit price per item, inferred from the owner's files and from bills.

In falling trust: ``sheet`` (the owner's price sheet), ``observed`` (bills of
orders with one unit of one item), ``derived`` (bills with one item still
unpriced, solved round by round), ``listed`` (the menu), ``unknown``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import from_cents, is_cents, to_cents
from ..functions.text import dish_base, dish_size
from ..operators.modes import mode_two_decimals
from ..schemas import PRICE_METHODS
from ..staging import stage


def match_sheet(names: DataFrame, sheet: DataFrame) -> DataFrame:
    """Add ``sheet_name, zomato_list_price`` of the price-sheet row for each ``item_name``.

    Names match on dish and size; of several sheet rows with that key the first
    counts. A name without such a row takes the only sheet row of its dish, and
    none if the dish comes in several sizes. A row found this way that has no
    list price prices nothing. Both columns are NULL for names without a price.
    """
    keyed = sheet.select(
        dish_base(F.col("item_name")).alias("_base"),
        dish_size(F.col("item_name")).alias("_size"),
        F.struct("sheet_seq", F.col("item_name").alias("sheet_name"), "zomato_list_price").alias("_row"),
    )
    by_key = keyed.groupBy("_base", "_size").agg(F.min("_row").alias("_exact"))
    by_base = (
        keyed.groupBy("_base")
        .agg(F.count(F.lit(1)).alias("_sizes"), F.min("_row").alias("_only"))
        .filter("_sizes = 1")
        .drop("_sizes")
    )
    hit = F.coalesce("_exact", "_only")
    return (
        names.withColumns({"_base": dish_base(F.col("item_name")), "_size": dish_size(F.col("item_name"))})
        .join(by_key, ["_base", "_size"], "left")
        .join(by_base, "_base", "left")
        .withColumn("_hit", F.when(hit["zomato_list_price"].isNotNull(), hit))
        .select(*names.columns, "_hit.sheet_name", "_hit.zomato_list_price")
    )


#: Rounds whose sums are read one by one, before they are added up and stored as one.
_ROUNDS_KEPT = 8


def _numbered(names: DataFrame) -> DataFrame:
    """Store the items with a number each, so that the solver moves and compares BIGINTs."""
    return stage(names.withColumn("item_no", F.monotonically_increasing_id()), "item-numbers")


@dataclass
class _Bills:
    """Solver input by item number: lines with a quantity, and known bills."""

    lines: DataFrame  # order_id, item_no, quantity
    #: order_id, n_lines, item_no, quantity, bill, order_seq: item numbers are combined
    #: by XOR and quantities added, so that lines can be taken out again.
    totals: DataFrame


def _bills(items: DataFrame, numbers: DataFrame, orders: DataFrame, seq: str) -> _Bills:
    counted = items.filter(F.col("quantity").isNotNull()).join(numbers, "item_name")
    lines = counted.select("order_id", "item_no", "quantity", F.col(seq).alias("order_seq"))
    # Lines and bills meet in one aggregation instead of a join: partial sums
    # shrink an order with very many lines before the shuffle, and orders
    # without an id still meet their bill.
    bills = orders.filter(F.col("bill_subtotal").isNotNull()).select(
        "order_id", F.col("bill_subtotal").alias("bill")
    )
    totals = (
        lines.unionByName(bills, allowMissingColumns=True)
        .groupBy("order_id")
        .agg(
            F.count("item_no").alias("n_lines"),
            F.bit_xor("item_no").alias("item_no"),
            F.sum("quantity").alias("quantity"),
            F.max("bill").alias("bill"),
            F.min("order_seq").alias("order_seq"),
        )
        .filter("n_lines > 0 and bill is not null")
    )
    return _Bills(lines.drop("order_seq"), stage(totals, "order-totals"))


def _observed(bills: _Bills) -> DataFrame:
    single = bills.totals.filter("n_lines = 1 and quantity = 1")
    return mode_two_decimals(single, ["item_no"], F.col("bill"), F.col("order_seq"))


def _priced(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Per order what the lines of items just found take from its open part and add to the known one."""
    hits = lines.join(found.select("item_no", F.col("mode_value").alias("price")), "item_no")
    price, quantity = F.col("price"), F.col("quantity")
    return hits.groupBy("order_id").agg(
        (-F.count(F.lit(1))).alias("n_open"),
        F.bit_xor("item_no").alias("item_no"),
        (-F.sum(quantity)).alias("quantity"),
        F.sum(F.when(is_cents(price), to_cents(price) * quantity)).alias("known_cents"),
        F.sum(F.when(~is_cents(price), price * quantity)).alias("known_rest"),
    )


def _balance(rows: DataFrame) -> DataFrame:
    """Orders from their bills and all that was taken from them. With one line open, ``item_no`` is its item."""
    return rows.groupBy("order_id").agg(F.max("bill").alias("bill"), F.min("order_seq").alias("order_seq"), *_added())


def _added() -> list[Column]:
    sums = [F.sum(name).alias(name) for name in ("n_open", "quantity", "known_cents", "known_rest")]
    return [*sums, F.bit_xor("item_no").alias("item_no")]


def _of_orders(lines: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Lines of open orders; a missing order id is an order too."""
    ids = open_orders.select(F.col("order_id").alias("_open"))
    return lines.join(ids, F.col("order_id").eqNullSafe(F.col("_open")), "left_semi")


def _derived(bills: _Bills, known: DataFrame) -> DataFrame | None:
    """Solve bills with one unpriced line, round by round, until none is left.

    All items solved in a round become known together. Lines and bills are
    stored once. A round joins the lines of the items found in the last one
    only, and sums what these take from their orders; these orders' balances are
    added up from the bills and all rounds so far. An order has one line open for
    the first time in the round that took the last but one, so orders that a
    round does not touch need no second look.
    """
    solved: list[DataFrame] = []
    bill_rows = bills.totals.withColumnRenamed("n_lines", "n_open")
    lines = stage(_of_orders(bills.lines, bill_rows), "price-lines")
    taken: list[DataFrame] = []
    found, first = known, True
    while True:
        now = stage(_priced(lines, found), "price-round-lines")
        if not first and now.isEmpty():
            break
        if len(taken) == _ROUNDS_KEPT:
            taken = [stage(reduce(DataFrame.unionByName, taken).groupBy("order_id").agg(*_added()), "price-rounds")]
        taken.append(now)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), taken, bill_rows)
        # In the first round orders of one line may be solved that no price has touched.
        state = _balance(rows if first else _of_orders(rows, now))
        first = False
        known_part = F.coalesce(from_cents(F.col("known_cents"), F.col("known_rest")), F.lit(0.0))
        value = (F.col("bill") - known_part) / F.col("quantity")
        candidates = state.filter("n_open = 1 and quantity <> 0")
        found = stage(mode_two_decimals(candidates, ["item_no"], value, F.col("order_seq")), "price-round")
        if found.isEmpty():
            break
        solved.append(found)
    return reduce(DataFrame.unionByName, solved) if solved else None


def _tier(prices: DataFrame, confidence: str) -> DataFrame:
    return prices.select(
        "item_no",
        F.col("mode_value").alias("unit_price"),
        F.lit(confidence).alias("confidence"),
        F.col("sample_n").cast("int").alias("sample_n"),
        F.lit(PRICE_METHODS[confidence]).alias("method"),
    )


def item_prices(
    items: DataFrame,
    orders: DataFrame,
    menu: DataFrame,
    sheet: DataFrame,
    seq: str = "_row_seq",
) -> DataFrame:
    """``gold.item_prices``: one row per item name, also where nothing is known.

    ``items``: order_id, item_name, quantity and ``seq``, which orders them.
    ``orders``: order_id, bill_subtotal. Lines without a quantity play no part
    in solving. ``items`` is read several times: pass a stored table.
    """
    numbers = _numbered(match_sheet(items.select("item_name").distinct(), sheet))
    on_sheet = numbers.filter("zomato_list_price is not null")
    sheet_prices = on_sheet.select("item_no", F.col("zomato_list_price").alias("mode_value"))
    bills = _bills(items, numbers.select("item_name", "item_no"), orders, seq)
    observed = stage(_observed(bills).join(sheet_prices, "item_no", "left_anti"), "observed-prices")
    derived = _derived(bills, sheet_prices.unionByName(observed.select("item_no", "mode_value")))

    sheet_tier = on_sheet.select(
        "item_no",
        F.col("zomato_list_price").alias("unit_price"),
        F.lit("sheet").alias("confidence"),
        F.lit(None).cast("int").alias("sample_n"),
        F.concat(F.lit(PRICE_METHODS["sheet"]), "sheet_name", F.lit("'")).alias("method"),
    )
    tiers = sheet_tier.unionByName(_tier(observed, "observed"))
    if derived is not None:
        tiers = tiers.unionByName(_tier(derived, "derived"))

    listed = last_menu_price(menu)
    on_menu = F.col("list_price").isNotNull()
    inferred = F.col("confidence").isNotNull()

    def else_menu(tier: Column, of_menu: Column, of_unknown: Column) -> Column:
        return F.when(inferred, tier).when(on_menu, of_menu).otherwise(of_unknown)

    return (
        numbers.join(tiers, "item_no", "left")
        .join(listed, "item_name", "left")
        .select(
            "item_name",
            else_menu(F.col("unit_price"), F.col("list_price"), F.lit(None).cast("double")).alias("unit_price"),
            else_menu(F.col("confidence"), F.lit("listed"), F.lit("unknown")).alias("confidence"),
            "sample_n",
            else_menu(F.col("method"), F.lit(PRICE_METHODS["listed"]), F.lit(PRICE_METHODS["unknown"])).alias("method"),
        )
    )


def last_menu_price(menu: DataFrame) -> DataFrame:
    """List price per name; of several rows the last in file order that has one.

    ``_row_seq`` holds the file order. A menu without it is taken in the order it is read.
    """
    at = F.col("_row_seq") if "_row_seq" in menu.columns else F.monotonically_increasing_id()
    return (
        menu.withColumn("_at", at)
        .filter(F.col("list_price").isNotNull())
        .groupBy("item_name")
        .agg(F.max_by("list_price", "_at").alias("list_price"))
    )


def observed_prices(items: DataFrame, orders: DataFrame, seq: str = "_row_seq") -> DataFrame:
    """Prices seen directly on bills: ``item_name, unit_price, sample_n``."""
    numbers = _numbered(items.select("item_name").distinct())
    observed = _observed(_bills(items, numbers, orders, seq))
    return observed.join(numbers, "item_no").select(
        "item_name", F.col("mode_value").alias("unit_price"), F.col("sample_n").cast("int").alias("sample_n")
    )
