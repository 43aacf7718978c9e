"""Test inputs: the given tables reshaped to the relations of the warehouse.

``PORTABLE`` views read the same in Spark SQL and DuckDB. ``RAW`` views exist
in Spark only: they encode clean tables as the text and JSON that the readers
take, so a query over them is compared with the clean table it began from.
Every view covers its whole input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import sequence_within
from tallyhouse.staging import stage, staged_until_end

TABLES = ["nation", "customer", "part", "orders", "lineitem", "events"]

PORTABLE = {
    "fx_orders": """
SELECT o_orderkey AS order_id, o_orderpriority AS restaurant_id,
  concat('R ', o_orderpriority) AS restaurant_name, o_custkey AS customer_id, o_orderdate AS order_placed_at,
  CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Cancelled' ELSE 'Rejected' END AS order_status,
  o_totalprice AS total,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 5 + 1 AS DOUBLE) END AS rating,
  CAST(10 + o_orderkey % 30 AS DOUBLE) AS kpt_duration_min,
  CAST(o_orderkey % 13 AS DOUBLE) AS rider_wait_min,
  CASE WHEN o_orderkey % 11 = 0 THEN 'late' END AS customer_complaint_tag
FROM orders""",
    "fx_items": """
SELECT l_orderkey AS order_id, CAST(l_quantity AS INT) AS quantity, p_name AS item_name
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    # Lines in order, in parts of a hundred: an order of any size is exported
    # in rows of bounded size. Spark numbers them with `_numbered_lines`.
    "fx_lines": """
SELECT *, CAST(floor((item_seq - 1) / 100.0) AS INT) AS part FROM (
  SELECT l_orderkey AS order_id, CAST(l_quantity AS INT) AS quantity, p_name AS item_name,
    CAST(row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS INT) AS item_seq
  FROM lineitem JOIN part ON l_partkey = p_partkey) n""",
    "fx_order_parts": """
SELECT o_orderkey AS order_id, coalesce(l.part, 0) AS part
FROM orders LEFT JOIN (SELECT DISTINCT order_id, part FROM fx_lines) l ON l.order_id = o_orderkey""",
    # Bills with red or large dishes are not known, so that some dishes can
    # only be priced from the menu, and some not at all.
    "fx_bills": """
SELECT i.order_id,
  CASE WHEN max(CASE WHEN i.item_name LIKE 'red %' OR i.item_name LIKE 'large %' THEN 1 ELSE 0 END) = 0
    THEN CAST(SUM(i.quantity * p.price) AS DOUBLE) END AS bill_subtotal
FROM fx_items i
JOIN (SELECT p_name, CAST(MIN(p_retailprice) AS DECIMAL(18,2)) AS price FROM part GROUP BY p_name) p
  ON p.p_name = i.item_name
GROUP BY i.order_id""",
    "fx_direct": """
SELECT o_orderkey AS order_id, o_orderdate AS order_placed_at, CAST(floor(o_totalprice) AS INT) AS total
FROM orders""",
    "fx_ledger": """
SELECT event_id AS entry_id, user_id AS customer_id, concat('ph', CAST(user_id AS VARCHAR(20))) AS customer_phone,
  CASE event_type WHEN 'purchase' THEN -CAST(floor(value) AS INT) WHEN 'error' THEN 0
    ELSE CAST(floor(value) AS INT) END AS delta,
  CASE event_type WHEN 'purchase' THEN 'spend' WHEN 'signup' THEN 'referral' WHEN 'error' THEN 'reminder'
    ELSE 'earn' END AS kind,
  ts AS created_at
FROM events""",
    # Every tenth customer is off by 5; customers from the nation table have no ledger.
    "fx_balances": """
SELECT customer_id, concat('ph', CAST(customer_id AS VARCHAR(20))) AS phone,
  concat('C', CAST(customer_id AS VARCHAR(20))) AS name,
  CAST(SUM(delta) + CASE WHEN customer_id % 10 = 0 THEN 5 ELSE 0 END AS INT) AS balance_cached,
  max(created_at) AS expires_at, concat('REF', CAST(customer_id AS VARCHAR(20))) AS referral_code
FROM fx_ledger GROUP BY customer_id
UNION ALL
SELECT 100000000 + n_nationkey, concat('ph', CAST(100000000 + n_nationkey AS VARCHAR(20))), n_name,
  CASE WHEN n_nationkey % 3 = 0 THEN 0 WHEN n_nationkey % 3 = 1 THEN 7 ELSE NULL END,
  NULL, NULL
FROM nation""",
    "fx_batches": "SELECT p_partkey AS id, p_name AS sku FROM part",
    "fx_moves": """
SELECT l_partkey AS batch_id,
  CASE l_returnflag WHEN 'A' THEN 'sold' WHEN 'R' THEN 'wasted' ELSE 'received' END AS reason,
  CASE WHEN l_returnflag IN ('A','R') THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END AS delta,
  CASE WHEN l_linenumber = 7 THEN l_shipdate END AS undone_at
FROM lineitem""",
    # Red dishes are on the menu under another name only.
    "fx_menu": """
SELECT CASE WHEN p_name LIKE 'red %' THEN concat(p_name, ' (retired)') ELSE p_name END AS item_name,
  MIN(p_type) AS category, CAST(MIN(p_retailprice) AS DOUBLE) AS list_price
FROM part GROUP BY CASE WHEN p_name LIKE 'red %' THEN concat(p_name, ' (retired)') ELSE p_name END""",
    # Every dish is on the sheet; only the small ones have a price there.
    "fx_sheet": """
SELECT p_name AS item_name,
  CASE WHEN p_name LIKE 'small %' THEN CAST(MIN(p_retailprice) AS DOUBLE) END AS zomato_list_price,
  MIN(p_partkey) AS sheet_seq
FROM part GROUP BY p_name""",
    # One file per week with orders; in May a file ends on Thursday.
    "fx_ranges": """
SELECT CAST(week AS DATE) AS start_date,
  CAST(week + CASE WHEN extract(month FROM week) = 5 THEN INTERVAL '3' DAY ELSE INTERVAL '6' DAY END AS DATE)
    AS end_date
FROM (SELECT DISTINCT date_trunc('week', o_orderdate) AS week FROM orders) w""",
}

FIRST_FILE = "order_history_20260101_20260107.csv"
SECOND_FILE = "order_history_20260108_20260114.csv"

RAW = {
    # A row per part of an order, with its lines; both channels are made of these.
    "fx_order_lines": """
SELECT o.*, t.part, t.lines
FROM fx_orders o LEFT JOIN (
  SELECT order_id, part, array_sort(collect_list(struct(item_seq, quantity, item_name))) AS lines
  FROM fx_lines GROUP BY order_id, part) t ON t.order_id = o.order_id""",
    # Orders that were still open in the first export are exported again in the second.
    "fx_bronze": f"""
SELECT o.restaurant_id AS `Restaurant ID`, o.restaurant_name AS `Restaurant name`,
  concat('Zone ', o.customer_id % 10) AS `Subzone`, concat('City ', o.customer_id % 3) AS `City`,
  CAST(o.order_id AS STRING) AS `Order ID`,
  date_format(o.order_placed_at + make_dt_interval(0, 0, CAST(o.order_id % 1440 AS INT)),
    'hh:mm a, MMMM dd yyyy') AS `Order Placed At`,
  concat(' ', o.order_status, ' ') AS `Order Status`, 'Zone delivery' AS `Delivery`,
  concat('<', o.order_id % 9, '.5 km') AS `Distance`,
  CASE WHEN o.order_id % 6 = 0 THEN '' ELSE concat('ring "', o.order_id, '"\\ntwice') END AS `Instructions`,
  '' AS `Discount construct`, CAST(o.total + 1 AS STRING) AS `Bill subtotal`,
  CAST(o.order_id % 20 AS STRING) AS `Packaging charges`,
  CASE WHEN o.order_id % 5 = 0 THEN 'n/a' ELSE '1_000' END AS `Restaurant discount (Promo)`,
  '1.5d' AS `Restaurant discount (Flat offs, Freebies & others)`, ' 2.5 ' AS `Gold discount`,
  '' AS `Brand pack discount`, CAST(o.total AS STRING) AS `Total`,
  coalesce(CAST(o.rating AS STRING), '') AS `Rating`,
  CASE WHEN o.rating = 5 THEN 'good, thanks' ELSE '' END AS `Review`,
  CASE WHEN o.order_status = 'Cancelled' THEN 'customer' ELSE '' END AS `Cancellation / Rejection reason`,
  '0' AS `Restaurant compensation (Cancellation)`, '' AS `Restaurant penalty (Rejection)`,
  CAST(o.kpt_duration_min AS STRING) AS `KPT duration (minutes)`,
  CAST(o.rider_wait_min AS STRING) AS `Rider wait time (minutes)`, 'Correctly' AS `Order Ready Marked`,
  coalesce(o.customer_complaint_tag, '') AS `Customer complaint tag`,
  CAST(o.customer_id AS STRING) AS `Customer ID`,
  CASE WHEN o.customer_id % 2 = 0 THEN '' ELSE concat('ph', o.customer_id) END AS `Customer Phone`,
  array_join(transform(o.lines, x -> concat(x.quantity, ' x ', x.item_name,
    CASE WHEN x.item_seq % 3 = 0 THEN ', large' ELSE '' END)), ', ') AS `Items in order`, if(o.number = 1, '{FIRST_FILE}', '{SECOND_FILE}') AS `_source_file`,
  o.number * 1000000000000 + coalesce(o.part, 0) AS `_row_seq`, TIMESTAMP '2026-01-15 00:00:00' AS `_loaded_at`
FROM (SELECT *, explode(if(order_status = 'Rejected', array(1, 2), array(1))) AS number FROM fx_order_lines) o""",
    "fx_files": """
SELECT concat('file:/exports/order_history_', date_format(start_date, 'yyyyMMdd'), '_',
  date_format(end_date, 'yyyyMMdd'), '.csv') AS file_path
FROM fx_ranges""",
    "fx_ledger_json": """
SELECT to_json(named_struct('id', entry_id, 'customer_id', customer_id, 'customer_phone', customer_phone,
  'delta', delta, 'kind', kind, 'order_id', CASE WHEN entry_id % 2 = 0 THEN CAST(entry_id AS STRING) ELSE 'x' END,
  'created_at', CAST(created_at AS STRING))) AS raw FROM fx_ledger""",
    "fx_balances_json": """
SELECT to_json(named_struct('customer_id', customer_id, 'phone', phone, 'name', name,
  'dough_balance', balance_cached, 'dough_expires_at', CAST(expires_at AS STRING),
  'referral_code', referral_code), map('ignoreNullFields', 'false')) AS raw FROM fx_balances""",
    "fx_referral_json": """
SELECT to_json(named_struct('id', event_id, 'referrer_customer_id', user_id,
  'referrer_phone', concat('ph', user_id), 'invitee_phone', props, 'order_id', CAST(value AS STRING),
  'same_device', CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END, 'status', event_type,
  'created_at', CAST(ts AS STRING), 'rewarded_at', CAST(year(ts) AS STRING))) AS raw FROM events""",
    "fx_direct_json": """
SELECT d.order_id, to_json(named_struct('order_id', d.order_id, 'status', 'confirmed', 'order_type', 'pickup',
  'food_total', d.total, 'delivery_fee', 0, 'total', d.total,
  'created_at', concat(replace(CAST(d.order_placed_at AS STRING), ' ', 'T'), '+05:30'),
  'confirmed_at', concat(replace(CAST(d.order_placed_at AS STRING), ' ', 'T'), 'Z'),
  'customer_phone', concat('ph', d.order_id), 'customer_name', concat('C', d.order_id),
  'items', coalesce(transform(d.lines, x -> named_struct('catalog_id', concat('c', x.item_seq),
    'name', x.item_name, 'qty', x.quantity, 'unit_price', 1.5D * x.item_seq)), array()))) AS raw
FROM (SELECT order_id, order_placed_at, CAST(floor(total) AS INT) AS total, lines FROM fx_order_lines) d""",
    # A bronze row as the snapshot reader leaves it.
    "fx_direct_raw": """
SELECT r.order_id, r.status, r.order_type, r.food_total, r.delivery_fee, r.total, r.slot_at, r.distance_band,
  r.locality, r.created_at, r.confirmed_at, r.customer_phone, r.customer_name, r.items AS items_json
FROM (SELECT from_json(raw, 'order_id INT, status STRING, order_type STRING, food_total INT, delivery_fee INT,
  total INT, slot_at STRING, distance_band STRING, locality STRING, created_at STRING, confirmed_at STRING,
  customer_phone STRING, customer_name STRING, items STRING') AS r FROM fx_direct_json) x""",
    "fx_decorated_names": """
SELECT p_partkey, concat(CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '⭐️ ' WHEN 2 THEN '🔥Most Ordered '
    ELSE 'BESTSELLER  ' END, initcap(p_name),
  CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' [Small]' ELSE ' [Large] (7” x)' END) AS item_name
FROM part""",
    # Pages of the orders table, 500 rows to a document.
    "fx_envelopes": """
SELECT to_json(named_struct('ok', true, 'generated_at', '2026-08-29T10:00:00Z', 'tables',
  map('orders', named_struct('columns',
      array('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'),
      'rows', collect_list(array(CAST(o_orderkey AS VARIANT), CAST(o_custkey AS VARIANT),
        CAST(o_orderstatus AS VARIANT), CAST(o_totalprice AS VARIANT),
        CAST(CAST(o_orderdate AS STRING) AS VARIANT), CAST(o_orderpriority AS VARIANT))))))) AS doc
FROM (SELECT *, monotonically_increasing_id() DIV 500 AS page FROM orders) o GROUP BY page""",
}

_VIEWS = {**PORTABLE, **RAW}


def _used(name: str, among: list[str]) -> list[str]:
    """Views that ``name`` reads, nearest last, in the order they must exist."""
    return [v for v in among if v != name and re.search(rf"\b{v}\b", _VIEWS[name])]


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_lines`` without a window over an order that may hold much of the table."""
    part = view(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item_name"))
    lines = view(spark, sf_dir, "lineitem").drop("l_discount", "l_tax", "l_returnflag", "l_linestatus")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]
    numbered = sequence_within(
        lines.join(part, "l_partkey"), ["l_orderkey"], [F.asc(c) for c in order], "item_seq", counted=lines
    )
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "item_name",
        F.col("item_seq").cast("int").alias("item_seq"),
        F.floor((F.col("item_seq") - 1) / 100).cast("int").alias("part"),
    )


_stored: dict[tuple[str, str], DataFrame] = {}


@contextmanager
def stored_once(spark: SparkSession, sf_dir: str, name: str) -> Iterator[None]:
    """Views that are taken inside, and read ``name``, read one stored copy of it, which is removed at the end."""
    with staged_until_end(spark):
        _stored[sf_dir, name] = stage(view(spark, sf_dir, name), name)
        try:
            yield
        finally:
            del _stored[sf_dir, name]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the tables in ``sf_dir``."""
    if (sf_dir, name) in _stored:
        return _stored[sf_dir, name]
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "fx_lines":
        return _numbered_lines(spark, sf_dir)
    for table in TABLES:
        if re.search(rf"\b{table}\b", _VIEWS[name]):
            view(spark, sf_dir, table).createOrReplaceTempView(table)
    for needed in _used(name, list(_VIEWS)):
        view(spark, sf_dir, needed).createOrReplaceTempView(needed)
    return spark.sql(_VIEWS[name])


def with_views(names: list[str], sql: str) -> str:
    """DuckDB text of ``sql`` with the portable views it reads in front."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for inner in _used(name, list(PORTABLE)):
            need(inner)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    body = ",\n".join(f"{n} AS ({PORTABLE[n]})" for n in wanted)
    glue = "," if sql.lstrip().upper().startswith("WITH ") else ""
    rest = sql.lstrip()[5:] if glue else sql
    return f"WITH {body}{glue}\n{rest}" if body else sql
