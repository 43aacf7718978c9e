"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

A byte is removed if a string of ``LEAST`` bytes that covers it also starts
somewhere else. To find such strings without one suffix array of everything,
the texts are cut into contexts that can be compared apart:

* Each window of ``LEAST`` bytes is owned by its anchor, the ``GRAM`` bytes with
  the least hash in it, the first of several. Equal windows have equal anchors
  at equal places. Neighbouring windows with one anchor form a unit; its context
  is all their bytes. Windows of different anchors are never equal, and an
  anchor that occurs once owns no repeated window.
* Equal contexts are counted before the shuffle, and one of each goes on.
  Where all contexts of an anchor are the same, nothing is left to compare.
* The contexts of other anchors are dealt out by anchor to shards of bounded
  size. A shard's contexts form one string with a separator of its own behind
  each. Its Burrows-Wheeler transform is expanded breadth first: intervals of
  rows that begin with the same bytes are extended backward, level by level, so
  that common prefixes are derived by increasing length. The expansion stops at
  ``LEAST``: rows that no level has told apart begin with a repeated string.
* An anchor with more distinct contexts than a shard takes is split by the place
  of the window before its anchor: windows of a narrower range have more bytes
  in common, which are the new key. At the width of one window all contexts of a
  key are equal, so the splitting ends for any data.

The transform's interval step reads the distinct preceding bytes of all intervals
of a level at once from a wavelet matrix in NumPy.

Cases: a null or empty text has 0 bytes, no spans and the hash of nothing; a text
below ``LEAST`` bytes is left whole; repeated rows are occurrences of their own,
so a repeated text of ``LEAST`` bytes or more is removed in all its rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.text_bytes import prefix_sums, slices, stretch_hash, utf8
from tallyhouse.staging import stage

LEAST = 400
GRAM = 32
#: Bytes of contexts per shard, and of one anchor's contexts before it is split.
SHARD = 1 << 20
#: Widths of the ranges of places before the anchor into which windows are split, in turn.
WIDTHS = (48, 6, 1)

UNIT = "key long, c1 long, c2 long, t1 long, t2 long, start long, size int, ahead int"


def _text_key() -> tuple[Column, Column]:
    text = F.md5(F.coalesce("text", F.lit("")))
    half = lambda at: F.conv(F.substring(text, at, 15), 16, 10).cast("long")
    return half(1).alias("t1"), half(16).alias("t2")


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of the first least one, as far as their bits beside a place tell."""
    bits = np.uint64(len(values).bit_length())
    best, span = values >> bits << bits | np.arange(len(values), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def anchors(data: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of one text: start, number of windows, place of the anchor, and the anchor's hash."""
    if len(data) < least:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = stretch_hash(sums, at, at + gram)
    owner = _leftmost_least(grams, least - gram + 1)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(owner)]]))
    return starts, sizes, owner[starts], grams[owner[starts]]


def _digest(context: bytes) -> tuple[int, int]:
    found = hashlib.blake2b(context, digest_size=16).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)


def _units(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                data, at = utf8(part.column(2))
                t1, t2 = (np.asarray(part.column(i)) for i in (0, 1))
                made: list[tuple] = []
                for i in np.flatnonzero(np.diff(at) >= least).tolist():
                    text = data[at[i] : at[i + 1]]
                    starts, sizes, owners, keys = anchors(text, least)
                    raw = text.tobytes()
                    for s, n, a, key in zip(starts.tolist(), sizes.tolist(), owners.tolist(), keys.view(np.int64).tolist(), strict=True):
                        made.append((key, *_digest(raw[s : s + n - 1 + least]), t1[i], t2[i], s, n, a - s))
                columns = list(zip(*made, strict=True)) or [()] * 8
                kinds = [pa.int64()] * 6 + [pa.int32()] * 2
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in UNIT.split(", ")])

    return run


def _cut_out(least: int):
    """The contexts that a text lends, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                rows = []
                for text, wanted in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_pylist(), strict=True):
                    raw = (text or "").encode()
                    for w in wanted:
                        s = w["start"]
                        rows.append((w["key"], w["c1"], w["c2"], w["n"], raw[s : s + w["size"] - 1 + least], w["size"], w["ahead"]))
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "c1", "c2", "n", "context", "size", "ahead"])

    return run


# --- one shard ---------------------------------------------------------------


def suffix_order(text: np.ndarray, most: int) -> np.ndarray:
    """Suffixes in order of their first ``most`` values at least, by doubling the compared length.

    As many values as a number takes are compared at first, and then only
    suffixes that are not told apart yet. A rank is 1 and the place of the first of
    equals, and 0 behind the end.
    """
    n = len(text)
    bits = int(text.max(initial=0) + 1).bit_length()
    span = max(1, min(62 // bits, n))
    key = np.zeros(n, np.int64)
    for i in range(span):  # 0 is behind the end
        key <<= bits
        key[: n - i] |= text[i:] + 1
    order = np.argsort(key)
    place, rank = np.arange(1, n + 1), np.zeros(n + max(most, span), np.int64)
    differs = np.concatenate([[True], key[order][1:] != key[order][:-1], [True]])[: n + 1]
    rank[order] = np.maximum.accumulate(place * differs[:-1])
    open_ = np.flatnonzero(~(differs[:-1] & differs[1:]))
    while span < most and len(open_):
        these = order[open_]
        pair = rank[these] * (n + 1) + rank[these + span]
        by_pair = np.argsort(pair)
        these, pair = these[by_pair], pair[by_pair]
        order[open_] = these
        differs = np.concatenate([[True], pair[1:] != pair[:-1], [True]])
        rank[these] = np.maximum.accumulate((open_ + 1) * differs[:-1])
        open_ = open_[~(differs[:-1] & differs[1:])]
        span *= 2
    return order


class WaveletMatrix:
    """Counts of bits before each place, from the highest bit down."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros, self.before = [], []
        values = values.astype(np.uint16)
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.before.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(one == 0, dtype=np.int32)]))
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])
        self.sorted_start = np.zeros(1 << bits, np.int64)
        changes = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        self.sorted_start[values[changes]] = changes

    def distinct(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct values of all intervals: value, and the interval of its occurrences among all of that value."""
        value = np.zeros(len(low), np.int64)
        for before, zeros in zip(self.before, self.zeros, strict=True):
            l0, h0 = before[low], before[high]
            l1, h1 = zeros + low - l0, zeros + high - h0
            in0, in1 = l0 < h0, l1 < h1
            low, high = np.concatenate([l0[in0], l1[in1]]), np.concatenate([h0[in0], h1[in1]])
            value = np.concatenate([value[in0] * 2, value[in1] * 2 + 1])
        start = self.sorted_start[value]
        return value, low - start, high - start


def repeated_starts(contexts: list[bytes], least: int) -> list[np.ndarray]:
    """Per context, the starts of strings of ``least`` bytes that start elsewhere in the contexts too."""
    sizes = np.array([len(c) for c in contexts])
    joined = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)  # no byte of UTF-8
    ends = np.cumsum(sizes + 1) - 1
    present = np.unique(joined[joined != 255])
    code = np.zeros(256, np.int64)
    code[present] = np.arange(1, len(present) + 1)
    text = code[joined]  # 0 is the separator
    n, k = len(text), len(ends)
    # every separator is a value of its own, below all bytes
    told_apart = text + k - 1
    told_apart[ends] = np.arange(k)
    order = suffix_order(told_apart, least)
    bwt = text[order - 1]
    bits = max(1, int(len(present)).bit_length())
    matrix = WaveletMatrix(bwt, bits)
    # intervals whose rows all have one preceding byte, as most soon do, go on as they are
    extended = np.empty(n, np.int64)  # by the row, the one that begins one byte earlier
    extended[np.argsort(bwt.astype(np.uint16), kind="stable")] = np.arange(n)
    run = np.cumsum(np.concatenate([[0], bwt[1:] != bwt[:-1]]))
    first_row = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(present) + 1))])

    bounded = np.zeros(n + 1, bool)  # rows at which a shorter common prefix ends
    bounded[n] = True
    bounded[: k + 1] = True  # rows of separators, each alone
    low, high = np.arange(k), np.arange(1, k + 1)
    starts = first_row[1:-1][np.diff(first_row)[1:] > 0]
    stops = first_row[2:][np.diff(first_row)[1:] > 0]
    bounded[starts] = bounded[stops] = True
    low, high = np.concatenate([low, starts]), np.concatenate([high, stops])
    for _ in range(1, least):
        if not len(low):
            break
        alike = run[low] == run[high - 1]
        value, before, until = matrix.distinct(low[~alike], high[~alike])
        real = value > 0  # nothing is extended over a separator
        value, before, until = value[real], before[real], until[real]
        low, high = low[alike], high[alike]
        real = bwt[low] > 0
        low, high = low[real], high[real]
        at = extended[low]
        low, high = np.concatenate([at, first_row[value] + before]), np.concatenate([at + high - low, first_row[value] + until])
        new = ~bounded[high]
        low, high = low[new], high[new]
        _, once = np.unique(high, return_index=True)
        low, high = low[once], high[once]
        bounded[high] = True
    shares = ~bounded[:n]  # the row has ``least`` bytes in common with the one before
    repeated = shares.copy()
    repeated[:-1] |= shares[1:]
    places = np.sort(order[repeated])
    of = np.searchsorted(ends, places)
    begins = ends - sizes
    cuts = np.searchsorted(of, np.arange(k + 1))
    return [places[cuts[i] : cuts[i + 1]] - begins[i] for i in range(k)]


def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive starts, as first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True))


def _shard(least: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        # a shard is somewhat uneven: it is worked off in parts of bounded size that keep anchors together
        weight = rows["context"].map(len).groupby(rows["key"]).sum()
        part_of = (weight.cumsum() // SHARD).to_dict()
        for _, part in rows.groupby(rows["key"].map(part_of)):
            for row, starts in zip(part.itertuples(), repeated_starts(part["context"].tolist(), least), strict=True):
                out += [(row.c1, row.c2, first, last) for first, last in ranges(starts)]
        return pd.DataFrame(out, columns=["c1", "c2", "first", "last"], dtype="int64")

    return run


# --- anchors with many contexts ------------------------------------------------


def _narrowed(width: int, least: int):
    """Pieces of contexts whose windows start in one range of places before the anchor.

    A range's windows all have the bytes from its latest start to its earliest end; those are the piece's key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                context, ahead, size = r["context"], r["ahead"], r["size"]
                for part in range((ahead - size + 1) // width, ahead // width + 1):
                    latest = ahead - part * width
                    first, last = max(0, latest - width + 1), min(size - 1, latest)
                    if first <= last:
                        piece = context[first : last + least]
                        key, _ = _digest(b"%d:" % part + context[latest : latest - width + 1 + least])
                        rows.append((r["c1"], r["c2"], first, *_digest(piece), key, r["n"], piece, last - first + 1, ahead - first))
            columns = list(zip(*rows, strict=True)) or [()] * 10
            kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.int32()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in PIECE.split(", ")])

    return run


PIECE = "c1 long, c2 long, off int, d1 long, d2 long, key long, n long, context binary, size int, ahead int"
CONTEXT = ["key", "c1", "c2", "n", "context", "size", "ahead"]


def _repeats(contexts: DataFrame, least: int, shard: int, widths: tuple[int, ...]) -> DataFrame:
    """``c1``, ``c2`` and the ranges of starts in them that are repeated, for keys of several distinct contexts."""
    n_bytes = F.length("context")
    per = contexts.groupBy("key").agg(F.sum(n_bytes).alias("n_bytes"), F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1)
    per = stage(per, "suffix-sizes")
    sized = contexts.join(per, "key")
    small = sized.filter(F.col("n_bytes") <= shard) if widths else sized
    total = per.filter(F.col("n_bytes") <= shard).agg(F.sum("n_bytes")).first()[0] or 0
    dealt = small.groupBy(F.pmod(F.xxhash64("key"), F.lit(total // shard + 1)).alias("shard"))
    found = dealt.applyInPandas(_shard(least), "c1 long, c2 long, first long, last long")
    if not widths or per.filter(F.col("n_bytes") > shard).isEmpty():
        return found
    large = sized.filter(F.col("n_bytes") > shard).select(*CONTEXT)
    pieces = stage(large.mapInArrow(_narrowed(widths[0], least), PIECE), "suffix-pieces")
    distinct = pieces.groupBy("key", F.col("d1").alias("c1"), F.col("d2").alias("c2")).agg(
        F.sum("n").alias("n"), F.first("context").alias("context"), F.first("size").alias("size"), F.first("ahead").alias("ahead")
    )
    narrow = stage(distinct.select(*CONTEXT), "suffix-narrowed")
    inner = _whole(narrow).unionByName(_repeats(narrow, least, shard, widths[1:]))
    inner = stage(inner.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), "first", "last").distinct(), "suffix-inner")
    back = pieces.select("c1", "c2", "off", "d1", "d2").join(inner, ["d1", "d2"])
    return found.unionByName(back.select("c1", "c2", (F.col("off") + F.col("first")).alias("first"), (F.col("off") + F.col("last")).alias("last")))


def _whole(contexts: DataFrame) -> DataFrame:
    """Contexts that occur more than once are repeated from end to end."""
    size = F.col("size").cast("long")
    return contexts.filter(F.col("n") > 1).select("c1", "c2", F.lit(0).cast("long").alias("first"), (size - 1).alias("last"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = (text or "").encode()
            runs: list[list[int]] = []
            for span in sorted((s["from"], s["to"]) for s in spans or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], span[1])
                else:
                    runs.append(list(span))
            at, parts = 0, []
            for first, last in runs:
                parts.append(raw[at:first])
                at = last
            kept = b"".join([*parts, raw[at:]])
            spans = [{"from": a, "to": b} for a, b in runs]
            rows.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest(), spans, kept.decode(errors="replace")))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text"])


def repeated_spans(docs: DataFrame, least: int = LEAST, shard: int = SHARD, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per document: its bytes, the removed byte ranges ``spans``, their sum and number, the hash of what is kept, and that as text.

    A character of which only some bytes are removed is shown as U+FFFD; ``spans`` and the hash are exact.
    """
    texts = docs.select("doc_id", *_text_key(), "text")
    units = stage(texts.select("t1", "t2", "text").mapInArrow(_units(least), UNIT), "suffix-units")
    # written first: a join that meets a grouped side in the same stage could not split a frequent anchor
    shared = stage(units.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key"), "suffix-keys")
    shared = stage(units.join(shared, "key"), "suffix-shared")
    # all occurrences of a context are equal, so any may lend its bytes
    lender = F.min(F.struct("t1", "t2", "start", "size", "ahead")).alias("lender")
    distinct = stage(shared.groupBy("key", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), lender).select("key", "c1", "c2", "n", "lender.*"), "suffix-distinct")
    several = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1).select("key")
    wanted = distinct.join(several, "key").groupBy("t1", "t2").agg(F.collect_list(F.struct("key", "c1", "c2", "n", "start", "size", "ahead")).alias("wanted"))
    one = texts.join(wanted, ["t1", "t2"]).select("text", "wanted").mapInArrow(_cut_out(least), "key long, c1 long, c2 long, n long, context binary, size int, ahead int")
    # rows that repeat a text lend the same contexts
    contexts = one.groupBy("key", "c1", "c2").agg(*[F.first(c).alias(c) for c in ("n", "context", "size", "ahead")])
    contexts = stage(contexts.select(*CONTEXT), "suffix-contexts")
    found = stage(_whole(distinct).unionByName(_repeats(contexts, least, shard, widths)), "suffix-found")
    at = shared.select("c1", "c2", "t1", "t2", "start").join(found, ["c1", "c2"])
    spans = at.select("t1", "t2", (F.col("start") + F.col("first")).alias("from"), (F.col("start") + F.col("last") + least).alias("to")).distinct()
    per = spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    kind = dict(docs.dtypes)["doc_id"]
    return (
        texts.join(per, ["t1", "t2"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_removed, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<from: long, to: long>>, kept_text string")
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
