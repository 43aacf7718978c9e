"""Text casts against the engine whose rules they follow."""

import datetime as dt

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.functions import casts

NUMBERS = [
    "1,234", "1.5d", "1_000", " 12 ", "inf", "nan", "", "1e3", "12f", ".", "1.5", "2.5", "-2.5", "3000000000",
    "true", "+5", "5.", ".5", "0x10", "-0", "1__0", "abc", "1.5D", "7F", "-inf", "Infinity", "1e400", "12 3",
    "1e", "1e+5", "1E-2", "1_0.5", "1_0.2_5", "._5", ".5_0", "1_", "_1", "+", "-", "1.e5", "+.5", "--1", "NaN", "INF",
    "1e1_0", "\t7\n", "0b11", "1.2.3", "१२",
]
TIMES = [
    "2026-08-16T10:00:00Z", "2026-08-16T10:00:00+05:30", "2026-08-16", "2026", "10:00",
    "2026-08-16 10:00:00.123456", "bad", "", "2026-13-01",
]
ORDER_TIMES = [
    "08:05 PM, August 03 2026", "8:05 pm, august 3 2026", "  08:05 PM,  August 03 2026 ",
    "08:05 PM, Aug 03 2026", "13:05 PM, August 03 2026", "bad", "12:00 AM, February 29 2024",
    "12:00 AM, February 30 2024",
]


def by_duckdb(values, expression):
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {expression} FROM t ORDER BY i").fetchall()]


def by_spark(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.v for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def test_double(spark):
    got, want = by_spark(spark, NUMBERS, casts.to_double), by_duckdb(NUMBERS, "try_cast(x AS DOUBLE)")
    assert [repr(x) for x in got] == [repr(x) for x in want]


def test_integer(spark):
    got, want = by_spark(spark, NUMBERS, casts.to_int), by_duckdb(NUMBERS, "try_cast(x AS INTEGER)")
    assert dict(zip(NUMBERS, got)) == dict(zip(NUMBERS, want))


def test_timestamp(spark):
    assert by_spark(spark, TIMES, casts.to_timestamp) == by_duckdb(TIMES, "try_cast(x AS TIMESTAMP)")


def test_order_time_probe(spark):
    want = by_duckdb(ORDER_TIMES, "try_strptime(x, '%I:%M %p, %B %d %Y')")
    assert by_spark(spark, ORDER_TIMES, casts.try_order_time) == want


def test_order_time_strict(spark):
    assert by_spark(spark, ORDER_TIMES[:3], casts.order_time) == [dt.datetime(2026, 8, 3, 20, 5)] * 3
    with pytest.raises(PySparkException):
        by_spark(spark, ["bad"], casts.order_time)


def test_distance_and_blank(spark):
    assert by_spark(spark, ["<1 km", "-2km", "3.5", "", None, "far"], casts.distance_km) == [1.0, 2.0, 3.5, None, None, None]
    assert by_spark(spark, ["", " ", "a", None], casts.blank_to_null) == [None, " ", "a", None]
