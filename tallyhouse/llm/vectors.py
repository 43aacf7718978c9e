"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine ``c`` are ``2 - 2c`` apart in squared distance. A fixed
rotation spreads that over all dimensions; the rotated vector is split into
blocks, and each block has the share of the budget that its dimensions have of
all. A pair within the budget is within the share of one block at least, so the
union of the blocks' range joins has every pair. A candidate is verified on the
vectors as given, in double precision.

The range join of a block cuts its space into cells: a tree of splits, each at
the median of the coordinate that is most spread out there. A vector meets the
cells that its ball of the block's radius reaches, so each further split
coordinate leaves fewer of them. Only the places of the splits come from a
sample of at most ``SAMPLE`` vectors; every vector is counted and dealt out. A
cell that holds more than ``SLAB`` vectors is cut into slabs by number. A task
compares two slabs, so its memory is bounded however many vectors a region
holds. It returns, per vector, the number of its links, and enough links to keep
the found components together, so its output does not grow with the square of a
group. A pair is counted in the first block in which it is close.

Equal vectors are collapsed first and carry their number.

Cases: a null vector, one with null or non-finite components, or a zero vector
links with nothing and is its own component; vectors of different lengths do
not link; repeated rows count as vectors of their own; a null id stays null, and
its component is the least id it reaches, if any; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.components import roots
from tallyhouse.staging import stage

COSINE = 0.95
BLOCKS = 4
SLAB = 8192
#: Vectors whose places decide on the splits, and the least number of them in a cell.
SAMPLE = 1 << 15
LEAF = 32
ROTATION_SEED = 20


def rotation(size: int) -> np.ndarray:
    drawn = np.random.default_rng(ROTATION_SEED).standard_normal((size, size))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def block_edges(size: int, blocks: int = BLOCKS) -> list[int]:
    return [size * b // min(blocks, size) for b in range(min(blocks, size) + 1)]


def radii(size: int, cosine: float, blocks: int = BLOCKS) -> list[float]:
    """Per block the distance that its share of the squared budget allows, with room for rounding."""
    edges = block_edges(size, blocks)
    return [float(np.sqrt((2 - 2 * cosine) * (b - a) / size)) + 1e-9 for a, b in zip(edges, edges[1:], strict=False)]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """One row per usable vector: ``node``, ``embedding``, its number and least id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)
    per = rows.filter(F.coalesce(usable, F.lit(False))).groupBy("embedding")
    return per.agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id")).withColumn("node", F.monotonically_increasing_id())


def _turned(rows: pd.DataFrame, size: int) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(rows["vec"]), rows["kind"].iloc[0]).reshape(-1, size).astype(float)) @ rotation(size)


def _packed(kind: str):
    """Per vector its components as bytes, in the width of the table."""

    def pack(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in pieces:
            for size, rows in part.groupby(part["embedding"].map(len)):
                x = np.array(rows["embedding"].tolist(), kind)
                yield pd.DataFrame({"size": size, "kind": kind, "node": rows["node"], "n": rows["n"], "vec": [v.tobytes() for v in x]})

    return pack


@dataclass
class Cells:
    """A tree of splits of one block; ``low`` and ``high`` are the next places, or a cell as -1 - number."""

    axis: list[int] = field(default_factory=list)
    at: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    number: int = 0
    #: Per cell the number of its first slab; one entry more for their sum.
    slabs: np.ndarray = field(default_factory=lambda: np.array([0, 1]))

    def split(self, points: np.ndarray, leaf: int) -> int:
        axis = int(points.var(axis=0).argmax()) if len(points) else 0
        at = float(np.median(points[:, axis])) if len(points) else 0.0
        above = points[:, axis] >= at
        if len(points) < 2 * leaf or above.all():
            self.number += 1
            return -self.number
        place = len(self.axis)
        for values, value in ((self.axis, axis), (self.at, at), (self.low, 0), (self.high, 0)):
            values.append(value)
        self.low[place] = self.split(points[~above], leaf)
        self.high[place] = self.split(points[above], leaf)
        return place

    def reached(self, points: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``points``, cells within the squared distance, and whether it is the row's own cell."""
        row, place, off = np.arange(len(points)), np.zeros(len(points), int), np.zeros(points.shape)
        own = np.ones(len(points), bool)
        if not self.axis:
            return row, place, own
        axes, at, low, high = (np.array(v) for v in (self.axis, self.at, self.low, self.high))
        out = []
        while len(row):
            axis = axes[place]
            gap = points[row, axis] - at[place]
            near, far = np.where(gap >= 0, high[place], low[place]), np.where(gap >= 0, low[place], high[place])
            there = off.copy()
            steps = np.arange(len(row))
            there[steps, axis] = np.maximum(there[steps, axis], np.abs(gap))
            # a place on the far side of an earlier split is still entered by its nearer half without further cost
            goes = (there * there).sum(1) <= budget
            row, place = np.concatenate([row, row[goes]]), np.concatenate([near, far[goes]])
            off, own = np.concatenate([off, there[goes]]), np.concatenate([own, np.zeros(int(goes.sum()), bool)])
            ended = place < 0
            out.append((row[ended], -1 - place[ended], own[ended]))
            row, place, off, own = row[~ended], place[~ended], off[~ended], own[~ended]
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def _counted(trees: dict[tuple[int, int], Cells]):
    """The number of vectors per cell, part by part."""

    def count(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in pieces:
            for size, rows in part.groupby("size"):
                turned, edges = _turned(rows, size), block_edges(size)
                for block, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    _, cells, own = trees[size, block].reached(turned[:, a:b], -1.0)
                    cell, n = np.unique(cells[own], return_counts=True)
                    yield pd.DataFrame({"size": size, "block": block, "cell": cell, "n": n})

    return count


def cells(packed: DataFrame, slab: int = SLAB, sample: int = SAMPLE, leaf: int = LEAF) -> dict[tuple[int, int], Cells]:
    """The cells per vector length and block, and their slabs. Their number is bounded by ``sample / leaf``."""
    trees: dict[tuple[int, int], Cells] = {}
    for length in packed.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect():
        size, n = length["size"], length["n"]
        edges = block_edges(size)
        chosen = np.zeros((0, size))
        if n > slab:
            share = min(1.0, sample / n)
            chosen = _turned(found, size) if len(found := packed.filter(F.col("size") == size).sample(share, 1).toPandas()) else chosen
        for block, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            trees[size, block] = Cells()
            trees[size, block].split(chosen[:, a:b], max(leaf, len(chosen) * slab // (2 * n)))
    counts = packed.mapInPandas(_counted(trees), "size int, block int, cell int, n long").groupBy("size", "block", "cell")
    found = {(r["size"], r["block"], r["cell"]): r["n"] for r in counts.agg(F.sum("n").alias("n")).collect()}
    for (size, block), tree in trees.items():
        tree.slabs = np.concatenate([[0], np.cumsum([max(1, -(-found.get((size, block, c), 0) // slab)) for c in range(tree.number)])])
    return trees


def _dealt(trees: dict[tuple[int, int], Cells], cosine: float, rows_at_once: int = 1024):
    """Sends a vector to the tasks of its slab: with itself, and with every slab of the cells within the radius."""

    def deal(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in pieces:
            for size, several in part.groupby("size"):
                for at in range(0, len(several), rows_at_once):
                    rows = several.iloc[at : at + rows_at_once]
                    turned, edges, node = _turned(rows, size), block_edges(size), rows["node"].to_numpy()
                    for block, reach in enumerate(radii(size, cosine)):
                        slabs = trees[size, block].slabs
                        row, cell, own = trees[size, block].reached(turned[:, edges[block] : edges[block + 1]], reach**2 + 2e-9)
                        parts = np.diff(slabs)
                        home = np.zeros(len(rows), int)
                        home[row[own]] = slabs[cell[own]] + node[row[own]] % parts[cell[own]]
                        each = np.repeat(np.arange(len(row)), parts[cell])
                        row, slab = row[each], slabs[cell[each]] + np.arange(len(each)) - np.repeat(np.cumsum(parts[cell]) - parts[cell], parts[cell])
                        low, high = np.minimum(home[row], slab), np.maximum(home[row], slab)
                        yield rows.iloc[row].assign(block=block, low=low, high=high, is_high=(home[row] > slab).astype(int))[TASK_COLUMNS]

    return deal


TASK = "size int, kind string, block int, low int, high int, is_high int, node long, n long, vec binary"
TASK_COLUMNS = [c.split()[0] for c in TASK.split(", ")]


class _Sets:
    """Joins numbers into sets and keeps the links that joined any."""

    def __init__(self, n: int):
        self.label, self.kept = np.arange(n), []

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        new = np.flatnonzero(a != b)
        if not len(new):
            return
        pairs, first = np.unique(a[new] * len(self.label) + b[new], return_index=True)
        parent = np.arange(len(self.label))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for pair, at in zip(pairs.tolist(), new[first].tolist(), strict=True):
            x, y = (find(v) for v in divmod(pair, len(self.label)))
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.kept.append((int(i[at]), int(j[at])))
        while (parent != parent[parent]).any():
            parent = parent[parent]
        self.label = parent[self.label]


def _compared(cosine: float, rows_at_once: int = 512):
    """Links between the two slabs of a task, or inside one."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        size, block = int(rows["size"].iloc[0]), int(rows["block"].iloc[0])
        same = rows["low"].iloc[0] == rows["high"].iloc[0]
        rows = rows.sort_values("node", ignore_index=True)
        x = np.frombuffer(b"".join(rows["vec"]), rows["kind"].iloc[0]).reshape(-1, size).astype(float)
        unit, edges, reach = _unit(x), block_edges(size), radii(size, cosine)
        turned = unit @ rotation(size)
        node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
        left = np.arange(len(rows)) if same else np.flatnonzero(rows["is_high"].to_numpy() == 0)
        right = np.arange(len(rows)) if same else np.flatnonzero(rows["is_high"].to_numpy() == 1)
        part = turned[:, edges[block] : edges[block + 1]]
        squares = (part * part).sum(1)
        links, sets = np.zeros(len(rows), np.int64), _Sets(len(rows))
        for at in range(0, len(left), rows_at_once):
            i = left[at : at + rows_at_once]
            apart = squares[i][:, None] + squares[right][None, :] - 2 * (part[i] @ part[right].T)
            a, b = np.nonzero(apart <= reach[block] ** 2 + 1e-9)
            a, b = i[a], right[b]
            if same:
                a, b = a[a < b], b[a < b]
            for lo in range(0, len(a), 1 << 16):  # verified on the whole vectors
                p, q = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
                good = (unit[p] * unit[q]).sum(1) >= cosine
                p, q = p[good], q[good]
                for of in range(block + 1):  # close in this block and in none before
                    gap = turned[p, edges[of] : edges[of + 1]] - turned[q, edges[of] : edges[of + 1]]
                    close = (gap * gap).sum(1) <= reach[of] ** 2
                    p, q = p[close == (of == block)], q[close == (of == block)]
                np.add.at(links, p, n[q])
                np.add.at(links, q, n[p])
                sets.join(p, q)
        counted = np.flatnonzero(links)
        kept = np.array(sets.kept, int).reshape(-1, 2)
        return pd.DataFrame(
            {
                "a": np.concatenate([node[counted], node[kept[:, 0]]]),
                "b": np.concatenate([node[counted], node[kept[:, 1]]]),
                "links": np.concatenate([links[counted], np.zeros(len(kept), np.int64)]),
            }
        )

    return compare


def links(vectors: DataFrame, cosine: float = COSINE, slab: int = SLAB) -> DataFrame:
    """Per task and node its ``links`` (``a`` = ``b``), and links ``a``, ``b`` that hold the components together."""
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"
    packed = stage(vectors.select("node", "n", "embedding").mapInPandas(_packed(kind), "size int, kind string, node long, n long, vec binary"), "vectors-packed")
    tasks = packed.mapInPandas(_dealt(cells(packed, slab), cosine), TASK)
    return tasks.groupBy("size", "block", "low", "high").applyInPandas(_compared(cosine), "a long, b long, links long")


def near_duplicates(rows: DataFrame, cosine: float = COSINE, slab: int = SLAB) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and whether it is kept."""
    rows = rows.select("vec_id", "embedding")
    vectors = stage(distinct_vectors(rows), "vectors")
    found = stage(links(vectors, cosine, slab), "vector-links")
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    grouped = vectors.join(roots(found.filter("a <> b"), "vector-components"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = grouped.join(least, "root").join(counted, "node", "left")
    known = known.select("embedding", F.xxhash64("embedding").alias("_hash"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    all_rows = rows.withColumn("_hash", F.xxhash64("embedding")).alias("r")
    out = all_rows.join(known.alias("k"), (F.col("r._hash") == F.col("k._hash")) & (F.col("r.embedding") == F.col("k.embedding")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op5_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
  l AS (SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r < b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
  s AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  w(a, b) AS (SELECT r, r FROM v UNION SELECT w.a, s.b FROM w JOIN s ON w.b = s.a),
  c AS (SELECT w.a AS r, min(v.vec_id) AS component_id FROM w JOIN v ON v.r = w.b GROUP BY w.a),
  n AS (SELECT a AS r, count(*) AS n FROM s GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN c USING (r) LEFT JOIN n USING (r)"""
