"""

Inputs are the views of ``fixtures.py``. The SQL answers from the clean views,
also where the query starts from their raw text or JSON form.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import FIRST_FILE, SECOND_FILE, stored_once, view, with_views  # noqa: E402
from tallyhouse.functions.dates import week_start  # noqa: E402
from tallyhouse.functions.text import dish_base, dish_size  # noqa: E402
from tallyhouse.operators.gaps import range_gaps  # noqa: E402
from tallyhouse.operators.modes import mode_two_decimals  # noqa: E402
from tallyhouse.plans import loyalty, orders, prices, quality, refresh, sales, states  # noqa: E402
from tallyhouse.plans.build import Inputs, build, build_exports  # noqa: E402
from tallyhouse.publish import Warehouse  # noqa: E402
from tallyhouse.sources import exports, mirror, reference_csv, snapshots  # noqa: E402
from tallyhouse.staging import remove_folder, stage, stage_path  # noqa: E402
from tallyhouse.streaming import incremental  # noqa: E402

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _query(name: str, views: list[str] | None = None, sql: str | None = None):
    """Register a query with its SQL, which reads the given portable views."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = with_views(views or [], sql)
        return build

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Weekly sales on the smallest tables."""
    return weekly_sales(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage and the pipeline, where they are there."""
    try:
        import corpus_pipeline
        from tallyhouse.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if not (missing.name == "corpus_pipeline" or (missing.name or "").startswith("tallyhouse.llm")):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLES, **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_training_data()[1]}


# --- weekly, item and customer answers -------------------------------------

# Money is added as DECIMAL on this side: exact, like the cents of the query.
_REVENUE = "CAST(sum(CAST(total AS DECIMAL(18,2))) FILTER (WHERE order_status = 'Delivered') AS DOUBLE)"
_DELIVERED = "count(*) FILTER (WHERE order_status = 'Delivered')"
_NOT_DELIVERED = "count(*) FILTER (WHERE order_status <> 'Delivered')"


@_query(
    "weekly_sales",
    ["fx_orders"],
    f"""SELECT restaurant_id, restaurant_name, date_trunc('week', order_placed_at) AS week_start,
      count(*) AS order_count, {_DELIVERED} AS delivered_count, {_NOT_DELIVERED} AS cancelled_count,
      {_REVENUE} AS total_revenue, {_REVENUE} / nullif({_DELIVERED}, 0) AS avg_order_value, avg(rating) AS avg_rating
    FROM fx_orders GROUP BY 1, 2, 3""",
)
def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_sales(view(spark, sf_dir, "fx_orders"))


@_query(
    "item_performance",
    ["fx_items", "fx_orders"],
    """SELECT o.restaurant_id, o.restaurant_name, i.item_name, count(*) AS times_ordered,
      CAST(sum(i.quantity) AS BIGINT) AS total_qty
    FROM fx_items i JOIN fx_orders o USING (order_id) GROUP BY 1, 2, 3""",
)
def item_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.item_performance(view(spark, sf_dir, "fx_items"), view(spark, sf_dir, "fx_orders"))


@_query(
    "customer_summary",
    ["fx_orders"],
    f"""SELECT restaurant_id, restaurant_name, customer_id, count(*) AS order_count,
      {_REVENUE} AS total_spend, {_REVENUE} / nullif({_DELIVERED}, 0) AS avg_order_value,
      min(order_placed_at) AS first_order_at, max(order_placed_at) AS last_order_at, avg(rating) AS avg_rating_given
    FROM fx_orders GROUP BY 1, 2, 3""",
)
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.customer_summary(view(spark, sf_dir, "fx_orders"))


@_query(
    "ops_quality",
    ["fx_orders"],
    f"""SELECT restaurant_id, restaurant_name, date_trunc('week', order_placed_at) AS week_start,
      avg(kpt_duration_min) AS avg_kpt_duration_min, avg(rider_wait_min) AS avg_rider_wait_min,
      {_NOT_DELIVERED} / count(*)::DOUBLE AS cancellation_rate, count(customer_complaint_tag) AS complaint_count
    FROM fx_orders GROUP BY 1, 2, 3""",
)
def ops_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.ops_quality(view(spark, sf_dir, "fx_orders"))


_MARKETPLACE_WEEKS = f"""SELECT date_trunc('week', order_placed_at) AS week_start, 'zomato' AS source,
      count(*) AS order_count, {_DELIVERED} AS confirmed_count, {_REVENUE} AS revenue
    FROM fx_orders GROUP BY 1, 2"""


@_query(
    "combined_weekly_sales",
    ["fx_orders", "fx_direct"],
    f"""{_MARKETPLACE_WEEKS} UNION ALL
    SELECT date_trunc('week', order_placed_at), 'direct', count(*), count(*), CAST(sum(total) AS DOUBLE)
    FROM fx_direct GROUP BY 1, 2""",
)
def combined_weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.combined_weekly_sales(view(spark, sf_dir, "fx_orders"), view(spark, sf_dir, "fx_direct"))


@_query("combined_weekly_sales_one_channel", ["fx_orders"], _MARKETPLACE_WEEKS)
def combined_weekly_sales_one_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.combined_weekly_sales(view(spark, sf_dir, "fx_orders"))


@_query(
    "stock_sold_vs_wasted",
    ["fx_moves", "fx_batches"],
    """SELECT b.sku, CAST(sum(CASE WHEN m.reason = 'sold' THEN -m.delta ELSE 0 END) AS BIGINT) AS sold,
      CAST(sum(CASE WHEN m.reason = 'wasted' THEN -m.delta ELSE 0 END) AS BIGINT) AS wasted
    FROM fx_moves m JOIN fx_batches b ON b.id = m.batch_id WHERE m.undone_at IS NULL GROUP BY 1""",
)
def stock_sold_vs_wasted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.stock_sold_vs_wasted(view(spark, sf_dir, "fx_moves"), view(spark, sf_dir, "fx_batches"))


@_query(
    "unmatched_menu_items",
    ["fx_items", "fx_menu"],
    """SELECT item_name, count(*) AS lines FROM fx_items i
    WHERE NOT EXISTS (SELECT 1 FROM fx_menu m WHERE m.item_name = i.item_name) GROUP BY 1""",
)
def unmatched_menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.unmatched_menu_items(view(spark, sf_dir, "fx_items"), view(spark, sf_dir, "fx_menu"))


@_query(
    "orders_without_items",
    ["fx_orders", "fx_items"],
    """SELECT order_id, order_status FROM fx_orders o
    WHERE NOT EXISTS (SELECT 1 FROM fx_items i WHERE i.order_id = o.order_id)""",
)
def orders_without_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = view(spark, sf_dir, "fx_orders").select("order_id", "order_status")
    return sales.orders_without_items(found, view(spark, sf_dir, "fx_items"))


# --- typing of raw exports and snapshots ------------------------------------

_TYPED = f"""SELECT restaurant_id, restaurant_name, concat('Zone ', customer_id % 10) AS subzone,
      concat('City ', customer_id % 3) AS city, CAST(order_id AS VARCHAR) AS order_id,
      order_placed_at + to_minutes(CAST(order_id % 1440 AS INT)) AS order_placed_at, order_status,
      'Zone delivery' AS delivery_type, order_id % 9 + 0.5::DOUBLE AS distance_km,
      CASE WHEN order_id % 6 <> 0 THEN concat('ring "', order_id, '"', chr(10), 'twice') END AS instructions,
      CAST(NULL AS VARCHAR) AS discount_construct,
      CAST(CAST(total AS DECIMAL(18,2)) + 1 AS DOUBLE) AS bill_subtotal,
      CAST(order_id % 20 AS DOUBLE) AS packaging_charges,
      CASE WHEN order_id % 5 <> 0 THEN 1000::DOUBLE END AS restaurant_discount_promo,
      CAST(NULL AS DOUBLE) AS restaurant_discount_other, 2.5::DOUBLE AS gold_discount,
      CAST(NULL AS DOUBLE) AS brand_pack_discount, total, rating,
      CASE WHEN rating = 5 THEN 'good, thanks' END AS review,
      CASE WHEN order_status = 'Cancelled' THEN 'customer' END AS cancellation_reason,
      0::DOUBLE AS restaurant_compensation, CAST(NULL AS DOUBLE) AS restaurant_penalty,
      kpt_duration_min, rider_wait_min, 'Correctly' AS order_ready_marked, customer_complaint_tag,
      CAST(customer_id AS VARCHAR) AS customer_id,
      CASE WHEN customer_id % 2 <> 0 THEN concat('ph', customer_id) END AS customer_phone,
      CASE WHEN order_status = 'Rejected' THEN '{SECOND_FILE}' ELSE '{FIRST_FILE}' END AS _source_file
    FROM fx_orders"""


@_query(
    "typed_orders",
    ["fx_orders"],
    f"""WITH typed AS ({_TYPED})
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_placed_at, order_id) AS customer_order_seq,
      row_number() OVER (PARTITION BY customer_id ORDER BY order_placed_at, order_id) = 1 AS is_first_order
    FROM typed""",
)
def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.orders(view(spark, sf_dir, "fx_bronze")).drop("_loaded_at")


_SPLIT = """SELECT CAST(i.order_id AS VARCHAR) AS order_id, i.item_seq - 100 * i.part AS item_seq, i.quantity,
      concat(i.item_name, CASE WHEN i.item_seq % 3 = 0 THEN ', large' ELSE '' END) AS item_name
    FROM fx_lines i"""


@_query(
    "order_items_split",
    ["fx_lines", "fx_orders"],
    f"""{_SPLIT} UNION ALL
    {_SPLIT} JOIN fx_orders o ON o.order_id = i.order_id WHERE o.order_status = 'Rejected'""",
)
def order_items_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_items(view(spark, sf_dir, "fx_bronze")).drop("_row_seq")


@_query(
    "order_items_split_once",
    ["fx_lines"],
    f"{_SPLIT} JOIN (SELECT order_id, max(part) AS part FROM fx_lines GROUP BY 1) p USING (order_id, part)",
)
def order_items_split_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_items(view(spark, sf_dir, "fx_bronze"), dedupe=True).drop("_row_seq")


@_query(
    "direct_orders_typed",
    ["fx_direct", "fx_order_parts"],
    """SELECT CAST(order_id AS INT) AS order_id, 'direct' AS source, 'confirmed' AS order_status,
      'pickup' AS order_type, CAST(NULL AS TIMESTAMP) AS slot_at, CAST(NULL AS VARCHAR) AS distance_band,
      CAST(NULL AS VARCHAR) AS locality, total AS food_total, 0 AS delivery_fee, total,
      order_placed_at AS created_at, order_placed_at AS confirmed_at, order_placed_at,
      concat('ph', order_id) AS customer_phone, concat('C', order_id) AS customer_name
    FROM fx_direct JOIN fx_order_parts USING (order_id)""",
)
def direct_orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.direct_orders(view(spark, sf_dir, "fx_direct_raw"))


_DIRECT_ITEMS = """SELECT CAST(order_id AS INT) AS order_id, 'direct' AS source, concat('c', item_seq) AS catalog_id,
      item_name, quantity, 1.5::DOUBLE * item_seq AS unit_price FROM fx_lines"""


@_query("direct_order_items", ["fx_lines"], _DIRECT_ITEMS)
def direct_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.direct_order_items(view(spark, sf_dir, "fx_direct_raw"))


def _pages(head: str, size: int = 500):
    """Documents of at most ``size`` elements, put together where the elements are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).drop_null().to_pylist()
            pages = [f"{head}{','.join(raw[at : at + size])}]}}" for at in range(0, len(raw), size)]
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.string())], ["value"])

    return run


def _write_snapshot(path: str, **sections: DataFrame) -> None:
    """Documents of at most 500 elements of one section, one per line."""
    for section, rows in sections.items():
        head = f'{{"ok": true, "generated_at": "2026-08-29", "{section}": ['
        pages = rows.select("raw").mapInArrow(_pages(head), "value string")
        # A compressed file is one task to its reader.
        pages.write.mode("append").option("maxRecordsPerFile", 200).text(path, compression="gzip")


@_query("direct_snapshot_items", ["fx_lines"], _DIRECT_ITEMS)
def direct_snapshot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, from envelopes of 500 orders read as files."""
    path = stage_path(spark, "direct-snapshot")
    _write_snapshot(path, orders=view(spark, sf_dir, "fx_direct_json"))
    sections = snapshots.read_sections(spark, path, snapshots.ORDERS_SECTIONS, one_per_line=True)
    return orders.direct_order_items(snapshots.direct_orders_raw(sections["orders"]))


@_query(
    "ledger_typed",
    ["fx_ledger"],
    """SELECT CAST(entry_id AS INT) AS entry_id, CAST(customer_id AS INT) AS customer_id, customer_phone, delta, kind,
      CASE WHEN entry_id % 2 = 0 THEN CAST(entry_id AS INT) END AS order_id, CAST(NULL AS VARCHAR) AS note, created_at
    FROM fx_ledger""",
)
def ledger_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.ledger(view(spark, sf_dir, "fx_ledger_json"))


@_query(
    "balances_typed",
    ["fx_balances"],
    """SELECT CAST(customer_id AS INT) AS customer_id, phone, name, balance_cached, expires_at, referral_code
    FROM fx_balances""",
)
def balances_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.balances(view(spark, sf_dir, "fx_balances_json"))


@_query(
    "referrals_typed",
    [],
    """SELECT CAST(event_id AS INT) AS referral_id, CAST(user_id AS INT) AS referrer_customer_id,
      concat('ph', user_id) AS referrer_phone, props AS invitee_phone, CAST(value AS DECIMAL(18,2))::INT AS order_id,
      event_type AS status, CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN true END AS same_device,
      ts AS created_at, CAST(NULL AS TIMESTAMP) AS rewarded_at FROM events""",
)
def referrals_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.referrals(view(spark, sf_dir, "fx_referral_json"))


# --- loyalty -----------------------------------------------------------------


@_query(
    "ledger_balances",
    ["fx_ledger"],
    """SELECT customer_id, customer_phone, CAST(sum(delta) AS BIGINT) AS balance_from_ledger
    FROM fx_ledger GROUP BY 1, 2""",
)
def ledger_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.balances_from_ledger(view(spark, sf_dir, "fx_ledger"))


@_query(
    "balance_check",
    ["fx_balances", "fx_ledger"],
    """WITH d AS (SELECT customer_id, customer_phone, CAST(sum(delta) AS BIGINT) AS balance_from_ledger
      FROM fx_ledger GROUP BY 1, 2)
    SELECT b.customer_id, b.phone, b.name, b.balance_cached, d.balance_from_ledger,
      b.balance_cached - d.balance_from_ledger AS difference
    FROM fx_balances b LEFT JOIN d USING (customer_id)
    WHERE coalesce(b.balance_cached, 0) <> coalesce(d.balance_from_ledger, 0)""",
)
def balance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = loyalty.balances_from_ledger(view(spark, sf_dir, "fx_ledger"))
    return loyalty.balance_check(view(spark, sf_dir, "fx_balances"), derived)


_CARDS = """SELECT b.phone, b.name, b.balance_cached AS balance, b.expires_at, b.referral_code,
      CAST(coalesce(sum(CASE WHEN l.delta > 0 THEN l.delta END), 0) AS BIGINT) AS earned_all_time,
      CAST(coalesce(-sum(CASE WHEN l.kind = 'spend' THEN l.delta END), 0) AS BIGINT) AS spent_all_time,
      count(CASE WHEN l.kind = 'referral' THEN 1 END) AS referral_entries
    FROM fx_balances b LEFT JOIN fx_ledger l USING (customer_id)"""


@_query("loyalty_customers", ["fx_balances", "fx_ledger"], f"{_CARDS} GROUP BY 1, 2, 3, 4, 5")
def loyalty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.customers(view(spark, sf_dir, "fx_balances"), view(spark, sf_dir, "fx_ledger"))


@_query("loyalty_lookup", ["fx_balances", "fx_ledger"], f"{_CARDS} WHERE b.phone LIKE '%7' GROUP BY 1, 2, 3, 4, 5")
def loyalty_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.find_customers(loyalty_customers(spark, sf_dir), "7")


# --- names and prices ---------------------------------------------------------

_SIZE_OF = "CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'small' ELSE 'large' END"


@_query("dish_key", [], f"SELECT p_partkey, p_name AS base, {_SIZE_OF} AS size FROM part")
def dish_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("item_name")
    return view(spark, sf_dir, "fx_decorated_names").select(
        "p_partkey", dish_base(name).alias("base"), dish_size(name).alias("size")
    )


@_query(
    "sheet_match",
    ["fx_sheet"],
    """SELECT p_partkey, s.item_name AS sheet_name, s.zomato_list_price
    FROM part JOIN fx_sheet s ON s.item_name = p_name WHERE s.zomato_list_price IS NOT NULL""",
)
def sheet_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decorated names against plain sheet names: by dish, whatever the size."""
    names = view(spark, sf_dir, "fx_decorated_names")
    matched = prices.match_sheet(names.select("item_name").distinct(), view(spark, sf_dir, "fx_sheet"))
    return names.join(matched.filter("sheet_name is not null"), "item_name").drop("item_name")


@_query(
    "mode_two_decimals",
    ["fx_items"],
    """WITH counted AS (
      SELECT p_name AS item_name, format('{:.2f}', l_extendedprice / l_quantity / 100)::DOUBLE AS mode_value,
        count(*) AS n, min(l_orderkey) AS first
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
    SELECT item_name, mode_value, CAST(sample_n AS BIGINT) AS sample_n FROM (
      SELECT item_name, mode_value, sum(n) OVER (PARTITION BY item_name) AS sample_n,
        row_number() OVER (PARTITION BY item_name ORDER BY n DESC, first, mode_value DESC) AS rank FROM counted) r
    WHERE rank = 1""",
)
def mode_of_two_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = view(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item_name"))
    lines = view(spark, sf_dir, "lineitem").join(part, "l_partkey")
    ratio = F.col("l_extendedprice") / F.col("l_quantity") / 100
    return mode_two_decimals(lines, ["item_name"], ratio, F.col("l_orderkey"))


_MODE = """SELECT item_name, v AS unit_price, sample_n FROM (
      SELECT item_name, v, CAST(sum(n) OVER (PARTITION BY item_name) AS INT) AS sample_n,
        row_number() OVER (PARTITION BY item_name ORDER BY n DESC, first) AS rank
      FROM (SELECT item_name, format('{:.2f}', value)::DOUBLE AS v, count(*) AS n, min(order_id) AS first
        FROM (%s) c GROUP BY 1, 2) g) r WHERE rank = 1"""
_SINGLE = """SELECT i.item_name, i.order_id, b.bill_subtotal AS value
      FROM fx_items i JOIN fx_bills b USING (order_id)
      JOIN (SELECT order_id FROM fx_items GROUP BY 1 HAVING count(*) = 1) s USING (order_id)
      WHERE i.quantity = 1 AND b.bill_subtotal IS NOT NULL"""


@_query("item_prices_observed", ["fx_items", "fx_bills"], _MODE % _SINGLE)
def item_prices_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stage(view(spark, sf_dir, "fx_items"), "fx-items")
    return prices.observed_prices(items, view(spark, sf_dir, "fx_bills"), seq="order_id")


def _item_prices_oracle(rounds: int = 5) -> str:
    """The rounds of the solver, unrolled; more of them than any test scale needs."""
    steps = [
        """known0 AS MATERIALIZED (
      SELECT item_name, zomato_list_price AS unit_price, 'sheet' AS confidence, CAST(NULL AS INT) AS sample_n,
        concat('data/price_sheet.csv zomato_list_price, matched to ''', item_name, '''') AS method
      FROM fx_sheet WHERE zomato_list_price IS NOT NULL AND item_name IN (SELECT item_name FROM fx_items))""",
        f"""known1 AS MATERIALIZED (SELECT * FROM known0 UNION ALL
      SELECT item_name, unit_price, 'observed', sample_n, 'mode of bill_subtotal, single-item qty=1 orders'
      FROM ({_MODE % _SINGLE}) o WHERE item_name NOT IN (SELECT item_name FROM known0))""",
    ]
    for r in range(1, rounds + 1):
        solved = _MODE % (
            f"""SELECT max(CASE WHEN k.item_name IS NULL THEN i.item_name END) AS item_name, i.order_id,
          (max(b.bill_subtotal) - CAST(coalesce(sum(CAST(k.unit_price AS DECIMAL(18,2)) * i.quantity), 0) AS DOUBLE))
            / max(CASE WHEN k.item_name IS NULL THEN i.quantity END) AS value
        FROM fx_items i JOIN fx_bills b USING (order_id) LEFT JOIN known{r} k ON k.item_name = i.item_name
        WHERE b.bill_subtotal IS NOT NULL GROUP BY i.order_id
        HAVING sum(CASE WHEN k.item_name IS NULL THEN 1 ELSE 0 END) = 1"""
        )
        steps.append(
            f"""known{r + 1} AS MATERIALIZED (SELECT * FROM known{r} UNION ALL
      SELECT item_name, unit_price, 'derived', sample_n,
        'residual solve: (bill_subtotal - known items) / qty, mode across orders' FROM ({solved}) d)"""
        )
    last = f"known{rounds + 1}"
    return f"""WITH {",".join(steps)}
    SELECT n.item_name, coalesce(k.unit_price, m.list_price) AS unit_price,
      coalesce(k.confidence, CASE WHEN m.list_price IS NOT NULL THEN 'listed' ELSE 'unknown' END) AS confidence,
      k.sample_n, coalesce(k.method, CASE WHEN m.list_price IS NOT NULL THEN 'menu.csv list_price'
        ELSE 'no observation or menu price available' END) AS method
    FROM (SELECT DISTINCT item_name FROM fx_items) n
    LEFT JOIN {last} k USING (item_name) LEFT JOIN fx_menu m USING (item_name)"""


_PRICE_VIEWS = ["fx_items", "fx_bills", "fx_sheet", "fx_menu"]


@_query("item_prices", _PRICE_VIEWS, _item_prices_oracle())
def item_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stage(view(spark, sf_dir, "fx_items"), "fx-items")
    bills, menu, sheet = (view(spark, sf_dir, v) for v in ("fx_bills", "fx_menu", "fx_sheet"))
    spread = sheet.select("*", *[F.lit(None).cast("double").alias(n) for n in ("zomato_set_price", "making_cost")])
    return prices.item_prices(items, bills, menu, spread, seq="order_id")


# --- checks -------------------------------------------------------------------

_GAPS = """SELECT end_date + 1 AS gap_start, next_start - 1 AS gap_end
    FROM (SELECT end_date, lead(start_date) OVER (ORDER BY start_date, end_date) AS next_start FROM fx_ranges) r
    WHERE next_start > end_date + 1"""
_GAP_DATES = f"SELECT CAST(gap_start AS DATE) AS gap_start, CAST(gap_end AS DATE) AS gap_end FROM ({_GAPS}) g"


@_query("week_gaps", ["fx_ranges"], _GAP_DATES)
def week_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_gaps(exports.file_ranges(view(spark, sf_dir, "fx_files")))


@_query(
    "week_gaps_covering",
    ["fx_ranges"],
    """SELECT CAST(reach + 1 AS DATE) AS gap_start, CAST(next_start - 1 AS DATE) AS gap_end
    FROM (SELECT max(end_date) OVER (ORDER BY start_date, end_date) AS reach,
      lead(start_date) OVER (ORDER BY start_date, end_date) AS next_start FROM fx_ranges) r
    WHERE next_start > reach + 1""",
)
def week_gaps_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_gaps(exports.file_ranges(view(spark, sf_dir, "fx_files")), covering=True)


_REEXPORTED = """SELECT CAST(sum(CASE WHEN order_status = 'Rejected' THEN 2 ELSE 1 END) - count(DISTINCT order_id) AS BIGINT)
      FROM fx_orders JOIN fx_order_parts USING (order_id)"""


@_query(
    "duplicate_order_ids",
    ["fx_orders", "fx_order_parts"],
    f"SELECT ({_REEXPORTED}) AS duplicates, CAST(0 AS BIGINT) AS unparsed",
)
def duplicate_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.export_checks(view(spark, sf_dir, "fx_bronze"))


@_query(
    "unreadable_rows",
    ["fx_orders", "fx_order_parts", "fx_lines"],
    """SELECT 'times' AS what, count(*) AS unparsed FROM (
      SELECT order_id FROM fx_orders JOIN fx_order_parts USING (order_id) UNION ALL
      SELECT order_id FROM fx_orders JOIN fx_order_parts USING (order_id) WHERE order_status = 'Rejected') r
    WHERE order_id % 7 = 0
    UNION ALL SELECT 'quantities', count(*) FROM (
      SELECT * FROM fx_lines UNION ALL
      SELECT l.* FROM fx_lines l JOIN fx_orders o USING (order_id) WHERE o.order_status = 'Rejected') i
    WHERE item_seq % 100 = 1""",
)
def unreadable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of two checks over exports with times and quantities that cannot be read."""
    raw = view(spark, sf_dir, "fx_bronze")
    placed, listed = F.col("`Order Placed At`"), F.col("`Items in order`")
    spoilt = raw.withColumns(
        {
            "Order Placed At": F.when(F.col("`Order ID`").cast("long") % 7 == 0, F.concat(F.lit("about "), placed)).otherwise(placed),
            # the first line of each export row
            "Items in order": F.concat(F.lit("some "), listed),
        }
    )
    times = quality.export_checks(spoilt).select(F.lit("times").alias("what"), "unparsed")
    lines = orders.order_items(spoilt).agg(quality.unparsed_quantities().alias("unparsed"))
    return times.unionByName(lines.select(F.lit("quantities").alias("what"), "unparsed"))


def _data_quality_oracle() -> str:
    unknown = f"SELECT count(*) FROM ({_item_prices_oracle()}) p WHERE confidence = 'unknown'"
    empty = "SELECT count(*) FROM fx_orders WHERE order_id NOT IN (SELECT order_id FROM fx_items)"
    spans = f"SELECT string_agg(concat(gap_start, ' to ', gap_end), ', ' ORDER BY gap_start) FROM ({_GAP_DATES}) s"
    rows = [
        ("missing_week_gaps", "warn", f"SELECT count(*) FROM ({_GAP_DATES}) s", None),
        ("duplicate_order_ids_bronze", "fail", _REEXPORTED, " duplicate Order ID rows in bronze.order_history_raw"),
        ("unparsed_order_placed_at", "fail", "SELECT 0", " bronze rows where Order Placed At failed to parse"),
        ("unparsed_item_quantity", "fail", "SELECT 0", " silver.order_items rows where quantity failed to parse"),
        ("orders_with_no_items", "fail", empty, " orders in silver.orders with no matching line items"),
        ("items_with_unknown_price", "warn", unknown, " items in gold.item_prices with no resolvable price"),
    ]
    parts = []
    for name, bad, value, text in rows:
        detail = f"concat(n, '{text}')" if text else f"concat('Weeks with no source CSV: ', coalesce(({spans}), 'none'))"
        parts.append(
            f"""SELECT '{name}' AS check_name, CASE WHEN n > 0 THEN '{bad}' ELSE 'ok' END AS status,
      {detail} AS detail, CAST(n AS INT) AS value FROM (SELECT ({value}) AS n) c"""
        )
    return " UNION ALL ".join(parts)


@_query("data_quality", [*_PRICE_VIEWS, "fx_orders", "fx_ranges", "fx_order_parts"], _data_quality_oracle())
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.data_quality(
        exports.file_ranges(view(spark, sf_dir, "fx_files")),
        view(spark, sf_dir, "fx_bronze"),
        view(spark, sf_dir, "fx_orders"),
        view(spark, sf_dir, "fx_items"),
        item_prices(spark, sf_dir),
    )


# --- files, tables and refresh ---------------------------------------------------


def _write_exports(spark: SparkSession, sf_dir: str, label: str, parts: int = 1) -> str:
    """The customer table as exports whose headers differ in order and columns."""
    folder = stage_path(spark, label)
    customers = view(spark, sf_dir, "customer")
    layouts = {
        "AUTOMOBILE": ["c_custkey", "c_name", "c_acctbal"],
        "BUILDING": ["c_acctbal", "c_custkey", "c_nationkey", "c_name"],
    }
    other = ["c_name", "c_nationkey", "c_custkey"]
    segment = F.col("c_mktsegment")
    groups = [(segment == s, columns) for s, columns in layouts.items()]
    groups.append((segment.isNull() | ~segment.isin(*layouts), other))
    for condition, columns in groups:
        rows = customers.filter(condition).withColumn("c_name", F.concat(F.lit('the "'), "c_name", F.lit('",\nfirst')))
        rows.select(*columns).repartition(parts).write.mode("append").csv(folder, header=True, quote='"', escape='"')
    return folder


_EXPORTED = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, concat('the "', c_name, '",', chr(10), 'first') AS c_name,
      CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN CAST(c_acctbal AS DOUBLE) END AS c_acctbal,
      CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey
    FROM customer"""


@_query("csv_union_by_name", [], _EXPORTED)
def csv_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exports.read_exports(spark, _write_exports(spark, sf_dir, "csv-union"))
    return rows.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_nationkey")


@_query("csv_union_by_name_split", [], _EXPORTED)
def csv_union_by_name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over files that are written in several parts."""
    rows = exports.read_exports(spark, _write_exports(spark, sf_dir, "csv-split", parts=3))
    return rows.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_nationkey")


@_query(
    "menu_load",
    [],
    """SELECT p_name AS item_name, p_type AS category, p_brand AS subcategory, p_size > 25 AS is_veg,
      CAST(p_size AS VARCHAR) AS size, p_retailprice AS list_price, CAST(NULL AS DOUBLE) AS unit_cost,
      p_size < 40 AS active FROM part""",
)
def menu_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "menu")
    view(spark, sf_dir, "part").select(
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        (F.col("p_size") > 25).alias("is_veg"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("list_price"),
        F.lit(None).cast("double").alias("unit_cost"),
        (F.col("p_size") < 40).alias("active"),
    ).write.csv(path, header=True, quote='"', escape='"')
    return reference_csv.read_menu(spark, path).drop("_row_seq")


@_query(
    "price_sheet_load",
    [],
    """SELECT p_name AS item_name, CAST(max(p_retailprice) FILTER (WHERE last AND p_size > 25) AS DOUBLE)
        AS zomato_list_price, CAST(NULL AS DOUBLE) AS zomato_set_price, CAST(NULL AS DOUBLE) AS local_price,
      CAST(NULL AS DOUBLE) AS local_offer_price, CAST(max(p_size) FILTER (WHERE last) AS DOUBLE) AS making_cost,
      CAST(NULL AS DOUBLE) AS zomato_receipt, min(p_partkey) AS sheet_seq
    FROM (SELECT *, p_partkey = max(p_partkey) OVER (PARTITION BY p_name) AS last FROM part) p GROUP BY 1""",
)
def price_sheet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows with blanks, words and repeated names, in part-key order."""
    text = view(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_name").alias("item_name"),
        F.when(F.col("p_size") > 25, F.concat(F.col("p_retailprice").cast("string"), F.lit(" "))).otherwise("ask").alias(
            "zomato_list_price"
        ),
        F.lit("  ").alias("local_price"),
        F.col("p_size").cast("string").alias("making_cost"),
        "p_partkey",
    )
    return reference_csv.sheet_from_text(text, "p_partkey")


@_query(
    "mirror_tables",
    [],
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
      TIMESTAMP '2026-08-29 10:00:00' AS synced_at FROM orders""",
)
def mirror_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = view(spark, sf_dir, "fx_envelopes").select(F.from_json("doc", mirror.TABLES_ENVELOPE).alias("d"))
    orders_copy = mirror.mirror_tables(documents.select("d.*")).tables["orders"]
    return orders_copy.withColumn("synced_at", F.col("synced_at").cast("timestamp_ntz"))


@_query("snapshot_gate", ["fx_ledger"], "SELECT count(*) AS entries FROM fx_ledger")
def snapshot_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of an accepted snapshot; a refused one stops the job (see tests)."""
    pages = view(spark, sf_dir, "fx_ledger_json").select(
        F.concat(F.lit('{"ok": true, "ledger": ['), "raw", F.lit("]}")).alias("doc")
    )
    envelopes = pages.select(F.from_json("doc", snapshots.LOYALTY_ENVELOPE).alias("d")).select("d.*")
    raw = snapshots.raw_section(snapshots.require_ok(envelopes), "ledger")
    return raw.agg(F.count("raw").alias("entries"))


@_query("incremental_ingest", [], _EXPORTED)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exports arrive, then some rows again in a further file: the newest per key stays."""
    bronze, progress = stage_path(spark, "bronze"), stage_path(spark, "progress")
    folder = _write_exports(spark, sf_dir, "arrivals")
    incremental.ingest_new_files(spark, folder, bronze, progress)
    first = incremental.current_rows(spark, bronze, ["c_custkey"]).filter("c_nationkey is null")
    again = first.select("c_acctbal", "c_name", "c_custkey")
    again.write.mode("append").csv(folder, header=True, quote='"', escape='"')
    incremental.ingest_new_files(spark, folder, bronze, progress)
    rows = incremental.current_rows(spark, bronze, ["c_custkey"])
    return rows.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_nationkey")


@_query(
    "build_report",
    ["fx_orders", "fx_items"],
    """SELECT 'silver.orders' AS "table", count(*) AS rows, '' AS note FROM fx_orders
    UNION ALL SELECT 'gold.item_performance', count(*), 'one row per restaurant and item' FROM (
      SELECT DISTINCT o.restaurant_id, i.item_name FROM fx_items i JOIN fx_orders o USING (order_id)) p""",
)
def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, stage_path(spark, "warehouse"))
    warehouse.create_layers()
    found = warehouse.publish("silver.orders", view(spark, sf_dir, "fx_orders"))
    performance = sales.item_performance(view(spark, sf_dir, "fx_items"), found)
    warehouse.publish("gold.item_performance", performance, note="one row per restaurant and item")
    return warehouse.report()


def _full_build_oracle() -> str:
    lines = "fx_lines JOIN fx_orders USING (order_id)"
    name = "concat(item_name, CASE WHEN item_seq % 3 = 0 THEN ', large' ELSE '' END)"
    weeks = "SELECT DISTINCT date_trunc('week', order_placed_at)"
    per_week = "FROM (SELECT DISTINCT restaurant_id, date_trunc('week', order_placed_at) FROM fx_orders) w"
    raw = "FROM fx_orders JOIN fx_order_parts USING (order_id)"
    twice = "sum(CASE WHEN order_status = 'Rejected' THEN 2 ELSE 1 END)"
    rows = {
        "bronze.order_history_raw": f"{twice} {raw}",
        "silver.orders": "count(*) FROM fx_orders",
        "silver.order_items": f"{twice} FROM {lines}",
        "silver.menu_items": "count(*) FROM fx_menu",
        "bronze.direct_orders_raw": f"count(*) {raw}",
        "silver.direct_orders": f"count(*) {raw}",
        "silver.direct_order_items": "count(*) FROM fx_lines",
        "gold.weekly_sales": f"count(*) {per_week}",
        "gold.item_performance": f"count(*) FROM (SELECT DISTINCT restaurant_id, {name} FROM {lines}) p",
        "gold.customer_summary": "count(*) FROM (SELECT DISTINCT restaurant_id, customer_id FROM fx_orders) c",
        "gold.ops_quality": f"count(*) {per_week}",
        "gold.item_prices": f"count(*) FROM (SELECT DISTINCT {name} FROM fx_lines) n",
        "gold.data_quality": "6",
        "gold.combined_weekly_sales": f"2 * count(*) FROM ({weeks} FROM fx_orders) w",
    }
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", (SELECT CAST(n AS BIGINT) FROM (SELECT {count.replace(" FROM", " AS n FROM", 1) if " FROM" in count else count + " AS n"}) c) AS rows"""
        for table, count in rows.items()
    )


@_query(
    "full_build",
    ["fx_orders", "fx_lines", "fx_order_parts", "fx_menu"],
    _full_build_oracle(),
)
def full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports, menu, sheet and direct orders as files, built from end to end; rows per table."""
    return _built(spark, sf_dir).report().select("table", "rows")


@_query(
    "full_build_orders",
    ["fx_orders"],
    f"""WITH typed AS ({_TYPED})
    SELECT order_id, customer_id, order_status, total, order_placed_at, CAST(date_trunc('month', order_placed_at) AS DATE) AS order_month,
      row_number() OVER (PARTITION BY customer_id ORDER BY order_placed_at, order_id) AS customer_order_seq
    FROM typed""",
)
def full_build_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of a built table, after the exports went through files."""
    built = _built(spark, sf_dir).table("silver.orders")
    return built.select(
        "order_id", "customer_id", "order_status", "total", "order_placed_at", "order_month",
        F.col("customer_order_seq").cast("long").alias("customer_order_seq"),
    )


_AS_CSV = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _refreshed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Export tables after two refreshes; the files end as those of ``fx_bronze``.

    At first the older export lacks a third of its orders and has wrong totals,
    and a later one has a sixth of them once more, rated and of another customer.
    Then the newer export comes; then the older one is replaced and the later
    one withdrawn.
    """
    folder = stage_path(spark, "exports")
    raw = stage(view(spark, sf_dir, "fx_bronze"), "fx-bronze")
    number = F.col("`Order ID`").cast("long")

    def write(name: str, rows: DataFrame) -> None:
        plain = rows.drop("_source_file", "_row_seq", "_loaded_at")
        plain.write.mode("overwrite").csv(f"{folder}/{name}", **_AS_CSV)

    older, newer = (raw.filter(F.col("_source_file") == name) for name in (FIRST_FILE, SECOND_FILE))
    write("20260101", older.filter(number % 3 != 0).withColumn("Total", F.lit("1")))
    write("20260115", older.filter(number % 6 == 1).withColumns({"Rating": F.lit("5"), "Customer ID": F.lit("moved")}))
    inputs = Inputs(f"{folder}/*", "")
    warehouse = Warehouse(spark, stage_path(spark, "warehouse"))
    warehouse.create_layers()
    with warehouse.together():
        build_exports(warehouse, inputs)

    def catch_up() -> None:
        found = refresh.changes(warehouse, inputs)
        with warehouse.together():
            refresh.refresh_exports(warehouse, inputs, found)

    write("20260108", newer)
    catch_up()
    write("20260101", older)
    remove_folder(spark, f"{folder}/20260115")
    catch_up()
    return warehouse


@_query(
    "refresh_by_change",
    ["fx_orders"],
    f"""WITH typed AS ({_TYPED}),
    numbered AS (SELECT *, date_trunc('week', order_placed_at) AS week_start,
      row_number() OVER (PARTITION BY customer_id ORDER BY order_placed_at, order_id) AS seq FROM typed)
    SELECT restaurant_id, restaurant_name, week_start, count(*) AS order_count, {_DELIVERED} AS delivered_count,
      {_NOT_DELIVERED} AS cancelled_count, {_REVENUE} AS total_revenue, {_REVENUE} / nullif({_DELIVERED}, 0) AS avg_order_value,
      avg(rating) AS avg_rating, CAST(sum(seq) AS BIGINT) AS seq_sum, count(*) FILTER (WHERE seq = 1) AS first_orders,
      CAST(sum(CAST(order_id AS BIGINT) * seq) AS BIGINT) AS weighted_ids
    FROM numbered GROUP BY 1, 2, 3""",
)
def refresh_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales from the kept states of months, and the orders' numbers, after files came and went."""
    warehouse = _refreshed(spark, sf_dir)
    group = [*sales.RESTAURANT, "week_start"]
    found = warehouse.table("silver.orders").withColumn("week_start", week_start(F.col("order_placed_at")))
    seq = F.col("customer_order_seq")
    numbers = found.groupBy(*group).agg(
        F.sum(seq).alias("seq_sum"),
        F.count_if("is_first_order").alias("first_orders"),
        F.sum(F.col("order_id").cast("long") * seq).alias("weighted_ids"),
    )
    return states.weekly_sales(warehouse.table("silver.week_states")).join(numbers, group)


def _built(spark: SparkSession, sf_dir: str) -> Warehouse:
    folder = stage_path(spark, "full-build")
    with stored_once(spark, sf_dir, "fx_order_lines"):
        raw = view(spark, sf_dir, "fx_bronze").drop("_source_file", "_row_seq", "_loaded_at")
        raw.write.csv(f"{folder}/exports", **_AS_CSV)
        _write_snapshot(f"{folder}/direct", orders=view(spark, sf_dir, "fx_direct_json"))
    menu = view(spark, sf_dir, "fx_menu")
    blank = [F.lit(None).cast("string").alias(c) for c in ("subcategory", "is_veg", "size")]
    end = [F.lit(None).cast("string").alias(c) for c in ("unit_cost", "active")]
    menu.select("item_name", "category", *blank, "list_price", *end).write.csv(f"{folder}/menu", **_AS_CSV)
    view(spark, sf_dir, "fx_sheet").drop("sheet_seq").write.csv(f"{folder}/sheet", **_AS_CSV)
    names = ("exports", "menu", "sheet", "direct")
    inputs = Inputs(*(f"{folder}/{name}" for name in names), one_per_line=True)
    return build(spark, stage_path(spark, "warehouse"), inputs)
