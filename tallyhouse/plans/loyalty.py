"""The loyalty-points ledger, its cached balances and referrals.

The ledger is the truth. The cached balance is only compared with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_int, to_timestamp

# JSON field -> column, with the type of the column.
_LEDGER = [
    ("id", "entry_id", "int"),
    ("customer_id", "customer_id", "int"),
    ("customer_phone", "customer_phone", "text"),
    ("delta", "delta", "int"),
    ("kind", "kind", "text"),
    ("order_id", "order_id", "int"),
    ("note", "note", "text"),
    ("created_at", "created_at", "time"),
]
_BALANCES = [
    ("customer_id", "customer_id", "int"),
    ("phone", "phone", "text"),
    ("name", "name", "text"),
    ("dough_balance", "balance_cached", "int"),
    ("dough_expires_at", "expires_at", "time"),
    ("referral_code", "referral_code", "text"),
]
_REFERRALS = [
    ("id", "referral_id", "int"),
    ("referrer_customer_id", "referrer_customer_id", "int"),
    ("referrer_phone", "referrer_phone", "text"),
    ("invitee_phone", "invitee_phone", "text"),
    ("order_id", "order_id", "int"),
    ("status", "status", "text"),
    ("same_device", "same_device", "flag"),
    ("created_at", "created_at", "time"),
    ("rewarded_at", "rewarded_at", "time"),
]
_RULES = {
    "text": lambda c: c,
    "int": to_int,
    "time": to_timestamp,
    "flag": lambda c: to_int(c) == 1,
}


def _typed(raw: DataFrame, fields: list[tuple[str, str, str]]) -> DataFrame:
    """Fields of the JSON text as columns; each text is parsed once."""
    schema = ", ".join(f"{field} string" for field, _, _ in fields)
    return raw.select(F.from_json("raw", schema).alias("_r")).select(
        *[_RULES[rule](F.col(f"_r.{field}")).alias(name) for field, name, rule in fields]
    )


def ledger(raw: DataFrame) -> DataFrame:
    return _typed(raw, _LEDGER)


def balances(raw: DataFrame) -> DataFrame:
    return _typed(raw, _BALANCES)


def referrals(raw: DataFrame) -> DataFrame:
    return _typed(raw, _REFERRALS)


def balances_from_ledger(ledger: DataFrame) -> DataFrame:
    """Balance per customer and phone, rebuilt from the ledger."""
    return ledger.groupBy("customer_id", "customer_phone").agg(F.sum("delta").alias("balance_from_ledger"))


# The two audit relations are views, so they are SQL with the inputs left open:
# DataFrames below, table names in a catalog view.

# The rebuilt balance is per phone but matched on the customer alone: a customer
# with two phones is compared twice. The outer join is written as inner plus
# anti join, because AQE can split a skewed key on either side of an inner join
# but only on the left side of an outer one.
BALANCE_CHECK_SQL = """
SELECT b.customer_id, b.phone, b.name, b.balance_cached, d.balance_from_ledger,
  b.balance_cached - d.balance_from_ledger AS difference
FROM {balances} b JOIN {derived} d ON b.customer_id = d.customer_id
WHERE coalesce(b.balance_cached, 0) <> coalesce(d.balance_from_ledger, 0)
UNION ALL
SELECT b.customer_id, b.phone, b.name, b.balance_cached, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM {balances} b LEFT ANTI JOIN (SELECT DISTINCT customer_id FROM {derived}) d ON b.customer_id = d.customer_id
WHERE b.balance_cached <> 0
"""

# The ledger is summed per customer before the join. Cards that agree in all
# shown columns are one card, even of two customer ids.
CUSTOMERS_SQL = """
SELECT b.phone, b.name, b.balance_cached AS balance, b.expires_at, b.referral_code,
  coalesce(sum(l.earned), 0) AS earned_all_time,
  coalesce(-sum(l.spent), 0) AS spent_all_time,
  coalesce(sum(l.referred), 0) AS referral_entries
FROM {balances} b
LEFT JOIN (
  SELECT customer_id,
    sum(delta) FILTER (WHERE delta > 0) AS earned,
    sum(delta) FILTER (WHERE kind = 'spend') AS spent,
    count(*) FILTER (WHERE kind = 'referral') AS referred
  FROM {ledger} GROUP BY customer_id
) l ON b.customer_id = l.customer_id
GROUP BY b.phone, b.name, b.balance_cached, b.expires_at, b.referral_code
"""


def balance_check(balances: DataFrame, derived: DataFrame) -> DataFrame:
    """Customers whose cached balance disagrees with the ledger; should be empty."""
    return balances.sparkSession.sql(BALANCE_CHECK_SQL, balances=balances, derived=derived)


def customers(balances: DataFrame, ledger: DataFrame) -> DataFrame:
    """One card per customer: balance, earned, spent, referrals."""
    return balances.sparkSession.sql(CUSTOMERS_SQL, balances=balances, ledger=ledger)


def find_customers(customers: DataFrame, phone_suffix: str) -> DataFrame:
    """Customer cards by the last digits of the phone number."""
    return customers.filter(F.col("phone").endswith(phone_suffix))
