"""Benchmark passages in documents, by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words; an item with fewer
is one window. A window is the set of its shingles of ``SHINGLE`` words, and it
is contained in a stretch of a document when all of them are, in their places.
Shingles are ordered by rarity, counted over all documents. Of a set that must
be contained whole, the necessary prefix is one shingle, the rarest: a document
without it cannot hold the window, and a window whose rarest shingle is in no
document is left out.

Documents are read twice, once to count the shingles that items have, once to
find the places of prefix shingles. Both passes look up a bit table of at most
``2 ** MOST_BITS`` bits, whatever the size of the benchmark. The table only
thins out: what passes it by chance falls away in the join on the shingle. The
windows themselves are joined, never broadcast by hand. A place that meets a
window is kept if the window fits between the ends of the document (positional
and length bound) and the words there equal those of the window.

A shingle's places are rows, so a frequent passage is many rows of one key in an
inner join, which Spark splits. Nothing is grouped but by document and item.

Cases: a null or empty text has no words, in documents as in items, and an item
without words has no windows; repeated documents are rows of their own; rows of
one ``item_id`` are one item, whose windows are those of all its rows; a null
``item_id`` is one item, written as an empty text; an empty benchmark leaves all
documents clean; an empty table gives an empty result; a document's places are
written out in rows of at most ``PIECE``, so long texts are whole; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text_bytes import mixed, prefix_sums, slices, stretch_hash, utf8
from tallyhouse.staging import stage

WINDOW = 10
SHINGLE = 3
#: The bit table has about 64 bits per shingle, and 8 MB at most.
MOST_BITS, LEAST_BITS = 26, 16
#: Places of a document in one row.
PIECE = 1024
#: Shingles that a task counts before it hands the counts on.
COUNTED_AT_ONCE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the text with A-Z in lower case.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of several texts: their places in ``text``, hashes, and each text's first word."""

    def __init__(self, column: pa.Array):
        data, at = utf8(column)
        data, at = _LOWER[data[at[0] : at[-1]]], at - at[0]
        inside = _IN_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        before = np.concatenate([[False], inside])[:-1] & ~edge[:-1]
        after = np.concatenate([inside, [False]])[1:] & ~edge[1:]
        self.start, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, at)
        self.hashes = stretch_hash(prefix_sums(data), self.start, self.end)
        self.text = data.tobytes()

    def shingles(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``length`` words from each word on, and the words at which one begins within its text."""
        n = max(len(self.hashes) - length + 1, 0)
        found = np.full(n, length, np.uint64)
        for step in range(length):
            found = mixed(found * _ODD + self.hashes[step : step + n])
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hashes))
        return found, np.flatnonzero(left[:n] >= length)

    def stretch(self, first: int, last: int) -> str:
        """Words ``first`` to before ``last``, with one blank between them."""
        places = zip(self.start[first:last].tolist(), self.end[first:last].tolist(), strict=True)
        return b" ".join(self.text[a:b] for a, b in places).decode()


def _cut(window: int):
    """The windows of each item: their words and shingles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = Words(batch.column(1).slice(lo, hi - lo))
                hashes = {length: words.shingles(length)[0].view(np.int64) for length in range(1, SHINGLE + 1)}
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                for item, (a, b) in zip(ids, zip(words.first.tolist(), words.first.tolist()[1:], strict=False), strict=True):
                    n = min(window, b - a)
                    size = min(SHINGLE, n)
                    starts = range(a, b - n + 1) if n else []
                    for at in range(0, len(starts), PIECE):
                        some = starts[at : at + PIECE]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item": pa.array([item] * len(some), pa.string()),
                                "n": pa.array([n] * len(some), pa.int32()),
                                "words": [words.stretch(i, i + n) for i in some],
                                "shingles": pa.array([hashes[size][i : i + n - size + 1] for i in some], pa.list_(pa.int64())),
                            }
                        )

    return cut


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, n, words, shingles`` per item and window; ``words`` are parted by one blank."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInArrow(_cut(window), "item string, n int, words string, shingles array<long>")


def bit_table(hashes: DataFrame, n: int) -> Broadcast:
    """A bit for each of about ``n`` hashes ``shingle``; its size does not follow ``n`` beyond ``MOST_BITS``."""
    bits = min(max((64 * max(n, 1)).bit_length(), LEAST_BITS), MOST_BITS)
    places = hashes.select(F.shiftrightunsigned("shingle", 64 - bits).alias("place"))
    bit = places.select(F.shiftrightunsigned("place", 3).alias("byte"), F.expr("shiftleft(1, cast(place % 8 as int))").alias("bit"))
    found = bit.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (bits - 3), np.uint8)
    table[found["byte"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return hashes.sparkSession.sparkContext.broadcast(table)


def _known(table: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    place = shingles >> np.uint64(64 - 3 - (len(table) - 1).bit_length())
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _counts(table: Broadcast, lengths: list[int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(number)], ["shingle", "n"])

        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                words = Words(batch.column(0).slice(lo, hi - lo))
                for length in lengths:
                    hashes, places = words.shingles(length)
                    hashes = hashes[places]
                    hashes = hashes[_known(table.value, hashes)]
                    every, which = np.unique(np.concatenate([found, hashes]), return_inverse=True)
                    weights = np.concatenate([number, np.ones(len(hashes), np.int64)])
                    found, number = every, np.bincount(which, weights, len(every)).astype(np.int64)
                if len(found) > COUNTED_AT_ONCE:
                    yield rows()
                    found, number = found[:0], number[:0]
        yield rows()

    return count


def _places(table: Broadcast, lengths: list[int], window: int):
    """Per document its number of words and the places of prefix shingles, with the words around them."""
    kind = pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("from", pa.int64()), ("words", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                words = Words(batch.column(2).slice(lo, hi - lo))
                found: dict[int, list[dict]] = {}
                for length in lengths:
                    hashes, places = words.shingles(length)
                    places = places[_known(table.value, hashes[places])]
                    around = window - length if length == SHINGLE else 0
                    text = np.searchsorted(words.first, places, side="right") - 1
                    begin, stop = words.first[text], words.first[text + 1]
                    first, last = np.maximum(places - around, begin), np.minimum(places + length + around, stop)
                    columns = (text, hashes[places].view(np.int64), places - begin, first - begin, first, last)
                    for row, shingle, at, skipped, a, b in zip(*(c.tolist() for c in columns), strict=True):
                        found.setdefault(row, []).append({"shingle": shingle, "at": at, "from": skipped, "words": words.stretch(a, b)})
                sizes = np.diff(words.first).tolist()
                pieces = [(row, at) for row in range(hi - lo) for at in range(0, max(len(found.get(row, [])), 1), PIECE)]
                for at in range(0, len(pieces), PIECE):
                    some = pieces[at : at + PIECE]
                    rows = pa.array([lo + row for row, _ in some], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array([sizes[row] for row, _ in some], pa.int64()),
                            pa.array([piece == 0 for _, piece in some]),
                            pa.array([found.get(row, [])[piece : piece + PIECE] for row, piece in some], pa.list_(kind)),
                        ],
                        ["row", "doc_id", "n_words", "leads", "places"],
                    )

    return find


def prefixes(cut: DataFrame, frequency: DataFrame) -> DataFrame:
    """Per distinct window that can occur its rarest ``shingle`` and the place ``offset`` of it."""
    every = cut.groupBy("n", "words").agg(F.first("shingles").alias("shingles"))
    each = every.select("n", "words", F.posexplode("shingles").alias("offset", "shingle"))
    rated = each.join(frequency, "shingle", "left")
    rarest = rated.groupBy("n", "words").agg(F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "shingle", "offset")).alias("p"))
    return rarest.filter("p.found > 0").select("n", "words", "p.shingle", "p.offset")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, the windows found in them, and which windows an item has.

    ``row, doc_id, n_words``; ``row, start, n, words`` with ``start`` counted
    from 0; ``item, words``. ``row`` tells rows of one ``doc_id`` apart.
    """
    if window < SHINGLE:
        raise ValueError(f"a window has {SHINGLE} words at least")
    cut = stage(windows(benchmark, window), "benchmark-windows")
    shingles = cut.select(F.explode("shingles").alias("shingle"))
    lengths = sorted({min(r.n, SHINGLE) for r in cut.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()})
    table = bit_table(shingles, shingles.count())
    counts = docs.select("text").mapInArrow(_counts(table, lengths), "shingle long, n long")
    frequency = stage(counts.groupBy("shingle").agg(F.sum("n").alias("found")), "shingle-counts")
    prefix = stage(prefixes(cut, frequency), "window-prefixes")
    rare = bit_table(prefix.select("shingle"), prefix.count())
    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = dict(given.dtypes)["doc_id"]
    schema = f"row long, doc_id {kind}, n_words long, leads boolean, places array<struct<shingle: long, at: long, from: long, words: string>>"
    found = stage(given.mapInArrow(_places(rare, lengths, window), schema), "shingle-places")
    place = found.select("row", "n_words", F.explode("places").alias("p")).select(
        "row", "n_words", "p.shingle", "p.at", F.col("p.from").alias("skipped"), F.split("p.words", " ").alias("around")
    )
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    there = F.slice("around", F.greatest(start - F.col("skipped") + 1, F.lit(1)).cast("int"), F.col("n"))
    met = place.join(prefix, "shingle").filter(fits).filter(F.array_join(there, " ") == F.col("words"))
    hits = stage(met.select("row", start.alias("start"), "n", "words"), "window-hits")
    return found.filter("leads").select("row", "doc_id", "n_words"), hits, cut.select("item", "words").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, those inside any window, and the items that have these windows."""
    rows, hits, items = scan(docs, benchmark, window)
    end = F.col("start") + F.col("n")
    earlier = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    fresh = end - F.greatest("start", F.least(end, F.coalesce("reach", F.lit(0))))
    covered = hits.select("row", "start", "n", F.max(end).over(earlier).alias("reach")).groupBy("row").agg(F.sum(fresh).alias("n_hit"))
    met = hits.select("row", "words").distinct().join(items, "words").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    none = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        rows.join(covered, "row", "left")
        .join(met, "row", "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(none).cast("long").alias("n_items"),
            F.sha2(F.array_join(none, ",").cast("binary"), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _oracle() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}')"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
    b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS words, least({WINDOW}, len(words)) AS n FROM benchmark),
    bi AS (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM b WHERE n > 0),
    bw AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS w FROM bi),
    di AS (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) s WHERE len(words) >= n),
    dw AS (SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS w FROM di),
    hits AS (SELECT r, i, n, item FROM dw JOIN bw USING (n, w)),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits) h) c GROUP BY r),
    met AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN met USING (r)"""


ORACLE = _oracle()
