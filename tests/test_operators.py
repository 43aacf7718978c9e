import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.gaps import range_gaps
from tallyhouse.operators.modes import mode_two_decimals
from tallyhouse.operators.ranking import keep_latest, sequence_within


def test_keep_latest(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 1, "p"), (None, 3, "q"), ("b", 1, "z")], "k string, at int, v string"
    )
    assert rows(keep_latest(df, ["k"], [F.desc("at")])) == [("a", 2, "y"), ("b", 1, "z"), (None, 3, "q")]


def test_keep_latest_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 k", "id")
    plan = keep_latest(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("hot_rows", [10**6, 50, 1])
def test_sequence_within_hot_keys(spark, hot_rows):
    """A third of the rows has no key, and many rows share a time; NULL times come last."""
    rng = random.Random(hot_rows)
    data = []
    for i in range(900):
        key = None if i % 3 == 0 else f"c{rng.randint(0, 40)}"
        at = None if i % 17 == 0 else dt.datetime(2026, 1, 1) + dt.timedelta(hours=rng.randint(0, 20))
        data.append((f"o{i:04}", key, at))
    df = spark.createDataFrame(data, "id string, k string, at timestamp_ntz").repartition(5)
    order = [F.asc_nulls_last("at"), F.asc("id")]
    got = {r.id: r.seq for r in sequence_within(df, ["k"], order, "seq", hot_rows=hot_rows, slice_rows=40).collect()}
    want, seen = {}, Counter()
    for i, key, at in sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
        seen[key] += 1
        want[i] = seen[key]
    assert got == want


def test_mode_first_seen_wins(spark, rows):
    data = [("a", v, i) for i, v in enumerate([2.0, 1.0, 2.001, 1.0, 3.0])] + [("b", 7.0, 9)]
    df = spark.createDataFrame(data, "k string, v double, seq long")
    assert rows(mode_two_decimals(df, ["k"], F.col("v"), F.col("seq"))) == [("a", 2.0, 5), ("b", 7.0, 1)]


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n - 1)


def gaps_of(spark, ranges, **options):
    df = spark.createDataFrame([(day(a), day(b)) for a, b in ranges], "start_date date, end_date date")
    return sorted(((r[0] - day(1)).days + 1, (r[1] - day(1)).days + 1) for r in range_gaps(df, **options).collect())


def test_gaps(spark):
    assert gaps_of(spark, [(1, 7), (8, 14), (22, 28), (22, 28)]) == [(15, 21)]
    nested = [(1, 30), (5, 7), (20, 25)]
    assert gaps_of(spark, nested) == [(8, 19)]
    assert gaps_of(spark, nested, covering=True) == []
    assert gaps_of(spark, [(1, 7)]) == []


def test_gaps_leave_no_day_out(spark):
    """Ranges cut out of a run of days with known holes, in any order and some twice."""
    rng = random.Random(5)
    for _ in range(5):
        at, ranges, holes = 1, [], []
        for _ in range(20):
            length, hole = rng.randint(1, 6), rng.choice([0, 0, 1, 4])
            ranges.append((at, at + length - 1))
            at += length
            if hole:
                holes.append((at, at + hole - 1))
                at += hole
        ranges.append((at, at))
        shuffled = ranges + rng.sample(ranges, 5)
        rng.shuffle(shuffled)
        assert gaps_of(spark, shuffled) == holes
