"""Connected components of a large graph, by large-star and small-star rounds.

In a large-star round every node links its larger neighbours to the least node
it sees; in a small-star round its smaller ones. The rounds end with stars
around each component's least node. Links are never collected: the driver
compares two sums per round. Each round is a written table, so a lost executor
costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.staging import stage


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(mixed, 20)), F.bit_xor(mixed)).first())


def _star(directed: DataFrame) -> DataFrame:
    """Each neighbour ``b`` of ``a``, with the least of both and of a's other neighbours."""
    least = directed.groupBy("a").agg(F.min("b").alias("least_b")).select(F.col("a"), F.least("a", "least_b").alias("least"))
    return directed.join(least, "a")


def roots(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the least node of its component, for the nodes of the links ``a``, ``b``."""
    links = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.filter(F.col("a") != F.col("b")).distinct()
        starred = _star(down)
        small = starred.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            starred.select("a", F.col("least").alias("b"))
        )
        now = stage(small.filter(F.col("a") != F.col("b")).distinct(), label)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
