"""Records of CSV files of any size, although cells may hold line breaks.

Files are read as lines, which split over tasks. A line begins a record unless
it begins inside a quoted cell. What a line does to that state depends on the
state it meets, and there are four cases: it keeps it, swaps it, or leaves
either value whatever came before. So the state before a line is that after
the last line that leaves a value, turned by the swaps since; the same holds
for whole splits, of which there is one row per 128 MB or so.

A task reads the lines of a split in order, so records are put together where
they are read. Only pieces of records that go over the edge of a split are
shuffled: two a split at most. The pass for the states keeps these pieces for
either state, so the lines are not read again for them; a piece that is too long
to be kept there makes a further pass over the lines.

The format: a quote opens a cell only where the cell begins, ``""`` inside a
quoted cell is a quote, and what follows a closing quote belongs to the cell up
to the next comma or line end. Lines end in ``\\r\\n``, ``\\n`` or ``\\r``, and
empty lines between records are passed over. A file whose last quoted cell is
never closed is refused, and so is a header that is longer than a split. A file
with ``\\r`` ends alone is one line to Spark, and so one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

# Over bytes, for a matcher that runs in linear time. Of a run of quotes inside a
# quoted cell all pairs belong to it: what closes it is not followed by a quote.
_INSIDE = r'[^"]*(?:""[^"]*)*'
_AFTER = r'(?:[^",][^,]*)?'
_CELL = rf'(?:"{_INSIDE}"{_AFTER}|[^",][^,]*)?'
_OPENS = rf'\A(?:{_CELL},)*"{_INSIDE}\z'
_STAYS_OPEN = rf'\A{_INSIDE}(?:"{_AFTER}(?:,{_CELL})*,"{_INSIDE})?\z'


def read_lines(spark: SparkSession, where: str | list[str]) -> DataFrame:
    """``value`` without its ``line_end``, and its file and split; the rows of a split follow each other in order."""
    # A lone \r inside a line ends a line as well; the last one is half of \r\n.
    parts = F.when(F.contains("value", F.lit("\r")), F.split("value", r"\r(?!\z)")).otherwise(F.array("value"))
    lines = (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", "*.csv")
        .text(where)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.size(parts).alias("parts"),
            F.posexplode(parts).alias("part", "text"),
        )
    )
    last = F.col("part") == F.col("parts") - 1
    returned = last & F.endswith("text", F.lit("\r"))
    value = F.when(returned, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return lines.select(
        "file",
        "split",
        value.alias("value"),
        F.when(~last, "\r").when(returned, "\r\n").otherwise("\n").alias("line_end"),
    )


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[pa.RecordBatch]]]:
    """The lines of each split; its file and place are the first two columns."""

    def cut() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file, split = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            begins = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
            for lo, hi in zip([0, *begins.tolist()], [*begins.tolist(), len(batch)], strict=True):
                if lo < hi:
                    yield batch.slice(lo, hi - lo)

    return groupby(cut(), key=lambda part: (part.column(0)[0].as_py(), part.column(1)[0].as_py()))


def _open_after(values: pa.Array) -> list[np.ndarray]:
    """Whether a quoted cell is open after each line: ``if_out`` and ``if_in``, when none or one is open before it."""
    found = values.cast(pa.binary())
    return [pc.match_substring_regex(found, p).to_numpy(zero_copy_only=False).astype(np.int64) for p in (_OPENS, _STAYS_OPEN)]


def _states(entered: int, if_out: np.ndarray, if_in: np.ndarray) -> np.ndarray:
    """The state before each line, and after the last one, if the first is met in the state given."""
    leaves = np.where(if_out == if_in, np.arange(1, len(if_out) + 1), 0)
    last = np.concatenate([[0], np.maximum.accumulate(leaves)])  # 1 + the last line that leaves a value
    swaps = np.concatenate([[0], np.cumsum((if_out == 1) & (if_in == 0))])
    return (np.concatenate([[entered], if_out])[last] + swaps - swaps[last]) % 2


def _text(values: pa.Array, ends: pa.Array) -> list[str]:
    return list(chain.from_iterable(zip(values.to_pylist(), ends.to_pylist(), strict=True)))


_PER_SPLIT = (
    "file string, split long, lines long, if_out int, if_in int, starts_if_out long, starts_if_in long, header string, "
    "head_if_in string, tail_if_out string, tail_if_in string, tail_line_if_out long, tail_line_if_in long"
)
#: Bytes of a piece at the edge of a split that the pass for the states keeps.
EDGE_BYTES = 2**16


class _Edges:
    """What a split holds of the records over its edges, if its first line is met in the state given; None where too long."""

    def __init__(self) -> None:
        self.head: list[str] | None = []
        self.tail: list[str] | None = []
        self.tail_line, self.begun, self.sizes = 0, False, [0, 0]

    def read(self, part: pa.RecordBatch, sizes: np.ndarray, line: int, states: np.ndarray, begins: np.ndarray) -> None:
        kept = begins | (states == 1)
        starts = np.flatnonzero(begins)
        if not self.begun:
            self.head = self._added(self.head, 0, part, sizes, kept[: starts[0]] if len(starts) else kept, 0)
        if len(starts):
            last = int(starts[-1])
            self.begun, self.tail_line, self.sizes[1] = True, line + last + 1, 0
            self.tail = self._added([], 1, part, sizes, kept[last:], last)
        elif self.begun:
            self.tail = self._added(self.tail, 1, part, sizes, kept, 0)

    def _added(self, text: list[str] | None, which: int, part: pa.RecordBatch, sizes: np.ndarray, kept: np.ndarray, first: int) -> list[str] | None:
        rows = first + np.flatnonzero(kept)
        self.sizes[which] += int(sizes[rows].sum())
        if text is None or self.sizes[which] > EDGE_BYTES:
            return None
        mine = pa.array(rows)
        return text + _text(part.column(2).take(mine), part.column(3).take(mine))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split of ``file, split, value, line_end``."""
    for (file, split), parts in _splits(batches):
        lines, state, starts, header, in_header = 0, [0, 1], [0, 0], [], split == 0
        edges = [_Edges(), _Edges()]
        for part in parts:
            if_out, if_in = _open_after(part.column(2))
            sizes = pc.binary_length(part.column(2)).to_numpy()
            for entered in (0, 1):
                states = _states(state[entered], if_out, if_in)
                begins = (states[:-1] == 0) & (sizes > 0)
                if in_header and entered == 0:
                    record = starts[0] + np.cumsum(begins)
                    mine = pa.array(np.flatnonzero((record == 1) & (begins | (states[:-1] == 1))))
                    header += _text(part.column(2).take(mine), part.column(3).take(mine))
                    in_header = record[-1] <= 1
                edges[entered].read(part, sizes, lines, states[:-1], begins)
                starts[entered] += int(begins.sum())
                state[entered] = int(states[-1])
            lines += len(part)
        tails = [e.tail if s else None for e, s in zip(edges, state, strict=True)]
        pieces = [None if text is None else "".join(text) for text in (edges[1].head, *tails)]
        row = [file, split, lines, *state, *starts, "".join(header[:-1]), *pieces, *(e.tail_line for e in edges)]
        columns = [c.split() for c in _PER_SPLIT.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for v, (_, k) in zip(row, columns, strict=True)], [c for c, _ in columns])


_RECORD = "file string, record long, line long, value string, line_end string, edge boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records after the header, of ``file, split, entered, lines_before, records_before, value, line_end``.

    What a split holds of a record that began before it, or goes on after it, is an ``edge``.
    """

    def rows(file: str, record: np.ndarray, line: np.ndarray, value: pa.Array, line_end: str, edge: bool) -> pa.RecordBatch:
        n = len(record)
        whole = [pa.array(np.asarray(c, np.int64)) for c in (record, line)]
        columns = [pa.repeat(pa.scalar(file), n), *whole, value, pa.repeat(pa.scalar(line_end), n), pa.repeat(pa.scalar(edge), n)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RECORD.split(", ")])

    for (file, _), parts in _splits(batches):
        state, line, record = -1, 0, 0
        rest: list[str] = []  # values and line ends of the record that is being read
        since, before = 0, True
        for part in parts:
            if state < 0:
                state, line, record = (part.column(i)[0].as_py() for i in (2, 3, 4))
            states = _states(state, *_open_after(part.column(5)))
            state = int(states[-1])
            begins = (states[:-1] == 0) & pc.not_equal(part.column(5), "").to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(begins | (states[:-1] == 1))
            starts = np.flatnonzero(begins[kept])
            value, line_end = (part.column(i).take(pa.array(kept)) for i in (5, 6))
            number = line + 1 + kept
            line += len(part)
            head = int(starts[0]) if len(starts) else len(kept)
            if head:
                since = since if rest else int(number[0])
                rest += _text(value[:head], line_end[:head])
            if not len(starts):
                continue
            if rest and record > 1:
                yield rows(file, [record], [since], pa.array(["".join(rest[:-1])]), rest[-1], before)
            skipped = 1 if record == 0 else 0  # the header
            if len(starts) > skipped + 1:
                ends = np.zeros(len(kept), bool)
                ends[starts[1:] - 1] = True
                text = pc.binary_join_element_wise(value, pc.if_else(pa.array(ends), "", line_end), "").cast(pa.large_string())
                _, at, data = text.buffers()
                cuts = np.frombuffer(at, np.int64)[text.offset :][starts[skipped:]]
                whole = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data).cast(pa.string())
                yield rows(file, record + 1 + np.arange(skipped, len(starts) - 1), number[starts[skipped:-1]], whole, "", False)
            last = int(starts[-1])
            rest, since, before = _text(value[last:], line_end[last:]), int(number[last]), False
            record += len(starts)
        if rest and record > 1:
            yield rows(file, [record], [since], pa.array(["".join(rest[:-1])]), rest[-1], before or state == 1)


def _with_state(rows: DataFrame, order: WindowSpec) -> DataFrame:
    """Add ``state``, 1 for an open cell before the row as far as the rows before tell, and ``swaps``."""
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when((F.col("if_out") == 1) & (F.col("if_in") == 0), 1).otherwise(0)
    left = F.when(F.col("if_out") == F.col("if_in"), (F.col("if_out") + F.col("swaps")) % 2)
    return (
        rows.withColumn("swaps", F.coalesce(F.sum(swap).over(earlier), F.lit(0)))
        .withColumn("state", (F.last(left, ignorenulls=True).over(earlier) + F.col("swaps")) % 2)
    )


def _state(entered: Column | int) -> Column:
    """The state before a row of a split that is entered with the state given."""
    entered = F.lit(entered) if isinstance(entered, int) else entered
    return F.coalesce(F.col("state"), (entered + F.col("swaps")) % 2)


def _after(entered: int) -> Column:
    return F.when(_state(entered) == 1, F.col("if_in")).otherwise(F.col("if_out"))


def _together(pieces: DataFrame) -> DataFrame:
    """Records of ``file, record, line, value``, where a value ends with its line end."""
    in_order = F.array_sort(F.collect_list(F.struct("line", "value")))
    text = F.array_join(F.transform(in_order, lambda p: p.value), "")
    return (
        pieces.groupBy("file", "record")
        .agg(F.min("line").alias("line"), F.regexp_replace(text, r"(?:\r\n|\r|\n)\z", "").alias("value"))
        .select("file", "line", "value")
    )


def read_splits(lines: DataFrame) -> DataFrame:
    """One row per split: the state it is entered and left with, lines and records before it, and the file's header.

    ``head`` and ``tail`` are what it holds of the records that began before it
    and go on after it, or NULL; ``reread`` tells that one of them was too long.
    """
    per_split = lines.mapInArrow(_summed, _PER_SPLIT)
    by_split = Window.partitionBy("file").orderBy("split")
    before = by_split.rowsBetween(Window.unboundedPreceding, -1)

    def met(name: str) -> Column:
        return F.when(F.col("entered") == 1, F.col(f"{name}_if_in")).otherwise(F.col(f"{name}_if_out"))

    starts = met("starts")
    goes_on = (_after(0) == 1) & (starts > 0)
    head, tail = F.when(F.col("entered") == 1, F.col("head_if_in")), F.when(goes_on, met("tail"))
    return (
        _with_state(per_split, by_split)
        .withColumn("entered", _state(0))
        .select(
            "file",
            "split",
            "entered",
            _after(0).alias("left_open"),
            starts.alias("starts"),
            F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
            F.coalesce(F.sum(starts).over(before), F.lit(0)).alias("records_before"),
            F.when(F.col("split") == 0, F.col("header")).alias("header"),
            (F.col("split") == F.max("split").over(Window.partitionBy("file"))).alias("is_last"),
            head.alias("head"),
            tail.alias("tail"),
            met("tail_line").alias("tail_line"),
            (((F.col("entered") == 1) & head.isNull()) | (goes_on & tail.isNull())).alias("reread"),
        )
    )


def read_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """``file``, ``line`` of its first line, and text per record after the header of its file."""
    # one row per split: broadcast, so that the lines stay where they are read, in order
    states = F.broadcast(splits.select("file", "split", "entered", "lines_before", "records_before"))
    placed = lines.join(states, ["file", "split"]).select(
        "file", "split", "entered", "lines_before", "records_before", "value", "line_end"
    )
    records = placed.mapInArrow(_cut, _RECORD)
    whole = records.filter("not edge").select("file", "line", "value")
    over_edges = splits.agg(F.count_if(F.col("entered") == 1).alias("n"), F.count_if("reread").alias("reread")).first()
    if not over_edges.n:
        return whole
    if over_edges.reread:
        pieces = records.filter("edge").select("file", "record", "line", F.concat("value", "line_end").alias("value"))
    else:
        at = F.col("lines_before")
        head = F.struct(F.col("records_before").alias("record"), (at + 1).alias("line"), F.col("head").alias("value"))
        tail = F.struct((F.col("records_before") + F.col("starts")).alias("record"), (at + F.col("tail_line")).alias("line"), F.col("tail").alias("value"))
        pieces = splits.select("file", F.explode(F.array(head, tail)).alias("p")).select("file", "p.*").filter("value is not null and record > 1")
    return whole.unionByName(_together(pieces))
