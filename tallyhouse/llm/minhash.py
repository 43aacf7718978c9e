"""Near-duplicate documents by MinHash and a multi-index Hamming join.

A document's set of word shingles has a signature of ``PLACES`` minima of ``b``
= 32 bits each. Signatures that differ in at most ``DISTANCE`` places are
candidates. They are split into ``CHUNKS`` chunks: by the pigeonhole principle
some chunk of such a pair differs in at most ``DISTANCE // CHUNKS`` = 1 place.
These errors are enumerated: a chunk is indexed once for each place left out, so
every pair under the distance shares a key, whatever the data. Documents at the
similarity threshold exceed the distance once in some hundred thousand pairs.
Candidates are confirmed on the full sets of shingles.

Documents of equal sets are collapsed first. A key's documents are never paired
among each other at once:

1. Each document meets its key's leader, the document that shares most keys.
   That confirms nearly all links of a large group, in one comparison each.
2. Only keys whose other documents still lie in different components go on.
   They are compared in tasks of bounded size (large keys in squares of slices),
   each pair in the first key that it shares; a task skips what is connected
   already and returns no more links than it has documents.

Cases: a document without words, or with a null text, has an empty set and links
with nothing; one or two words are one shingle; repeated rows are equal
documents; a null id stays null, and its component is the least id it reaches,
if any; an empty table gives an empty result; other columns are not read, and
``keep`` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.components import roots
from tallyhouse.llm.text_bytes import mixed, slices, utf8, word_hashes
from tallyhouse.staging import stage

SHINGLE = 3
PERCENT = 85
PLACES = 32
CHUNKS = 8
DISTANCE = 15
#: Documents of one slice of a key, and rows per group of small tasks.
SLICE = 2000
TASK_ROWS = 4000

_WIDE = PLACES // CHUNKS
assert DISTANCE // CHUNKS == 1, "the index leaves out one place of a chunk"
_DRAWN = np.random.default_rng(10).integers(1, 1 << 63, (2, PLACES), dtype=np.uint64)
_TIMES, _PLUS = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]
_ORDER = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct shingles."""
    words, first = word_hashes(data, at)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * _ORDER[k % 3] + words[k : k + len(rolled)]
    rolled = mixed(rolled)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= width:
            yield np.unique(rolled[lo : hi - width + 1])
        elif hi > lo:
            whole = np.uint64(hi - lo)
            for word in words[lo:hi]:
                whole = mixed(np.array([whole * _ORDER[0] + word]))[0]
            yield np.array([whole])
        else:
            yield np.zeros(0, np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of the drawn functions, 32 bits each."""
    least = np.full(PLACES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for lo in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[lo : lo + 4096, None] * _TIMES + _PLUS).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _sums(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    signed = lambda x: int(x.view(np.int64)) if len(hashes) else 0
    with np.errstate(over="ignore"):
        other = mixed(hashes * _ORDER[1] + _ORDER[2])
        return signed(np.add.reduce(hashes)), signed(np.add.reduce(other))


def _measured(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                rows = [(len(s), *_sums(s), signature(s).tobytes()) for s in shingle_sets(*utf8(part.column(2)), width)]
                n, low, high, signs = zip(*rows, strict=True)
                made = [pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(signs, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], ["doc_id", "text_hash", "n_shingles", "low", "high", "signature"])

    return run


def _text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set, chunk and place left out, a hash of the chunk's other places."""
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, CHUNKS, _WIDE).astype(np.uint64)
        node = np.asarray(batch.column(0))
        for chunk in range(CHUNKS):
            for left_out in range(_WIDE):
                key = np.full(len(signs), np.uint64(chunk * _WIDE + left_out + 1))
                for place in range(_WIDE):
                    if place != left_out:
                        key = mixed(key * _ORDER[0] + signs[:, chunk, place])
                index = np.full(len(signs), chunk * _WIDE + left_out, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(key.view(np.int64)), pa.array(index)], ["node", "key", "index"])


def _with_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                sets = [s.tobytes() for s in shingle_sets(*utf8(part.column(1)), width)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if not small or 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = [_alike(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent) for i in range(len(batch))]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of signatures, the index of the first key that both have."""
    same = (a == b).reshape(-1, CHUNKS, _WIDE)
    but_one = (same.sum(2)[:, :, None] - same) == _WIDE - 1  # the other places of the chunk agree
    return but_one.reshape(len(a), -1).argmax(1)


def _compared(percent: int):
    """Links between documents of different components, for the tasks of one group."""

    def one(rows: pd.DataFrame, found: list) -> None:
        square = rows["low"].iloc[0] != rows["high"].iloc[0]
        index = rows["index"].iloc[0]
        signs = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(-1, PLACES)
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        node, mine = rows["node"].to_numpy(), rows["slice"].to_numpy()
        parent = {c: c for c in rows["root"]}

        def find(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        root = rows["root"].tolist()
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        for i in range(len(rows)):
            if square and mine[i] != low:
                continue
            others = np.flatnonzero(mine == high) if square else np.arange(i + 1, len(rows))
            own = find(root[i])
            others = others[[find(root[j]) != own for j in others.tolist()]] if len(others) else others
            others = others[(signs[others] != signs[i]).sum(1) <= DISTANCE]
            if len(others):
                others = others[_first_shared(signs[others], np.broadcast_to(signs[i], (len(others), PLACES))) == index]
            for j in others.tolist():
                x, y = find(root[i]), find(root[j])
                if x != y and _alike(sets[i], sets[j], percent):
                    parent[max(x, y)] = min(x, y)
                    found.append((node[i], node[j]))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        for _, task in rows.groupby(["key", "low", "high"], sort=False):
            one(task.reset_index(drop=True), found)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _tasks(members: DataFrame, sets: DataFrame, slice_rows: int) -> DataFrame:
    """Members of open keys with their sets, in the tasks that they take part in."""
    n = F.ceil(F.col("n_members") / slice_rows).cast("int")
    cut = members.withColumn("slices", n).withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    met = met.withColumns({"low": F.least("slice", "other"), "high": F.greatest("slice", "other")})
    return met.join(sets, "node").select("key", "index", "low", "high", "slice", "node", "root", "signature", "shingles", "n_members")


def components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, slice_rows: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """Measured documents, and distinct sets with the least id of their component."""
    rows = docs.select("doc_id", _text_hash().alias("text_hash"), "text")
    measured = stage(
        rows.mapInArrow(_measured(width), "doc_id long, text_hash long, n_shingles long, low long, high long, signature binary"),
        "minhash-documents",
    )
    per = measured.filter(F.col("n_shingles") > 0).groupBy("low", "high", "n_shingles")
    first = F.min_by(F.struct("doc_id", "text_hash", "signature"), F.struct("doc_id", "text_hash"))
    sets = per.agg(F.min("doc_id").alias("least_id"), first.alias("first")).select("*", "first.*").drop("first")
    sets = stage(sets.withColumn("node", F.monotonically_increasing_id()), "minhash-sets")

    keyed = sets.select("node", "signature").mapInArrow(_keys, "node long, key long, index int")
    keyed = stage(keyed, "minhash-keys")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    members = stage(keyed.join(shared, "key"), "minhash-members")
    rank = members.groupBy("node").agg(F.sum("n").alias("rank"))
    leaders = members.join(rank, "node").groupBy("key").agg(F.max_by("node", F.struct("rank", "node")).alias("leader"))
    members = stage(members.join(leaders, "key"), "minhash-members")

    wanted = sets.join(members.select("node").distinct(), "node").select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["_id"]) & (rows["text_hash"] == wanted["_hash"])).select("node", "text")
    full = texts.mapInArrow(_with_sets(width), "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
    full = stage(full.join(sets.select("node", "signature"), "node"), "minhash-shingles")

    near = members.select(F.col("node").alias("a"), F.col("leader").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    pairs = near.join(full.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    pairs = pairs.join(full.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    links = stage(pairs.mapInArrow(_confirmed(percent), "a long, b long"), "minhash-links")

    led = stage(roots(links, "minhash-components"), "minhash-roots")
    rest = members.filter(F.col("node") != F.col("leader")).join(led, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n_members"), F.min("root").alias("one"), F.max("root").alias("two"))
    still = rest.drop("n", "leader").join(per.filter(F.col("one") != F.col("two")).select("key", "n_members"), "key")
    tasks = _tasks(still, full, slice_rows)
    copies = still.agg(F.sum(F.ceil(F.col("n_members") / slice_rows))).first()[0]  # a member is in as many tasks as its key has slices
    n_groups = max(1, (copies or 0) // TASK_ROWS)
    # keys of many members have a group per square of slices, small ones share groups
    group = F.pmod(F.xxhash64("key", "low", "high"), F.lit(n_groups))
    more = tasks.groupBy(group.alias("group")).applyInPandas(_compared(percent), "a long, b long")
    links = stage(links.unionByName(more), "minhash-links")

    known = sets.join(roots(links, "minhash-components"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = stage(known.select("root", "low", "high", "n_shingles", "least_id"), "minhash-known")
    # written, so that Spark can split a large root in the join
    least = stage(known.groupBy("root").agg(F.min("least_id").alias("component_id")), "minhash-least")
    return measured, known.join(least, "root").select("low", "high", "n_shingles", "component_id")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, slice_rows: int = SLICE) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and whether it is kept."""
    measured, known = components(docs, width, percent, slice_rows)
    out = measured.join(known, ["low", "high", "n_shingles"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "text_hash")


def keep(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one of least id, with the columns of ``docs``; documents without an id stay.

    Of rows that repeat the kept id and text one stays.
    """
    found = near_duplicates(docs, width, percent)
    kept = found.filter(F.col("kept") | F.col("doc_id").isNull()).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    # numbered columns clash with none made here
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*at.values()).withColumn("hash", _text_hash(at["text"]))
    same = F.col(at["doc_id"]).eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    once = rows.join(kept, same, "left_semi").dropDuplicates([at["doc_id"], "hash"])
    return once.select(*[F.col(n).alias(c) for c, n in at.items()])


def op10_minhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")


ORACLE = rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
  g AS (SELECT DISTINCT r, CASE WHEN len(words) < 3 THEN words ELSE words[i : i + 2] END AS g
    FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM d WHERE len(words) > 0) x),
  n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
  p AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM g a JOIN g b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
  l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * p.n >= {PERCENT} * (x.n + y.n - p.n)),
  s AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  w(a, b) AS (SELECT r, r FROM d UNION SELECT w.a, s.b FROM w JOIN s ON w.b = s.a),
  c AS (SELECT w.a AS r, min(d.doc_id) AS component_id FROM w JOIN d ON d.r = w.b GROUP BY w.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)"""
