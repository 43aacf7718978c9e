"""Repair of conversation structure, by Hirschberg's divide-and-conquer over four states.

Roles of a repaired conversation begin with ``(s?(ua)+)?``: a system turn if any,
then pairs of user and assistant. Where a repair stands is one of four states:
nothing yet, after a system, a user or an assistant turn. A row is kept, given
the role that may follow, or deleted, after as many inserted turns as pay; so a
row is a 4 x 4 matrix of costs between states. Forward costs from the one end and
backward costs from the other meet in the middle of a conversation; the state
there is the one of least sum, among equal ones the one whose first half has the
ASCII-least audit. The halves are then solved alike, with nothing kept but two
vectors.

Audits are compared without being written: those that lead to different states
after the same rows differ, and none begins another. So a vector carries, beside
the costs, the order of its states' audits, and one step updates it.

A conversation may hold any share of the rows. Rows are dealt out by ranges of
their order, so it spans as many parts as it needs; each part yields its matrix
in one pass, matrices of a conversation (one per part) are solved alike, which
gives each part the states at its ends, and parts are then solved on their own.
Texts are left out of all this and meet the edits in one join. Only the digest
of a repaired text takes a conversation in its order, as a hash must, row by row
and without holding more than the audit.

Cases: a null role or text is one space, and a null ``conv_id`` is one
conversation; rows without a turn come first, rows of one turn are ordered by
role, then by the hash of the text; a role is told by its first character as it
stands, and one that is empty or begins otherwise is never kept; a very long text
is a row like others; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
INITIALS = "sua"
FAULTS = ["none", "blank", "duplicate", "truncated"]
BLANKS = " \t\n\x0b\f\r"

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What an inserted or re-roled turn becomes, by state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert at the end, by state.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

#: From each state to each: ``None`` or a cost and what orders ways of equal cost.
Matrix = tuple
#: Per state: ``None`` or a cost, and the place of its audit among all states'.
Front = tuple


def row_matrix(code: int) -> Matrix:
    """The ways through a row of a kind: cost and edits, the least of each. See ``code_of`` for kinds."""
    fault, initial = divmod(code, 4)
    rows = []
    for entered in range(4):
        best: list = [None] * 4
        state = entered
        for inserted in range(3):
            ways = [(state, DELETE, "D")]
            if FAULTS[fault] not in ("blank", "duplicate"):
                extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
                ways.append((NEXT[state], REROLE + extra, "R"))
                if (initial == 0 and state == START) or initial + 1 == NEXT[state]:
                    ways.append((initial + 1, KEEP + extra, "K"))
            for left, cost, edit in ways:
                way = (cost + INSERT * inserted, "I" * inserted + edit)
                best[left] = min(best[left] or way, way)
            state = NEXT[state]
        rows.append(tuple(best))
    return tuple(rows)


ROWS = [row_matrix(code) for code in range(4 * len(FAULTS))]


def front_at(state: int) -> Front:
    return tuple((0, 0) if s == state else None for s in range(4))


def through(front: Front, matrix: Matrix) -> Front:
    """The front after a matrix."""
    best: list = [None] * 4
    for state, known in enumerate(front):
        for left, way in enumerate(matrix[state] if known else ()):
            if way:
                found = (known[0] + way[0], known[1], way[1])
                best[left] = min(best[left] or found, found)
    order = sorted(b[1:] for b in best if b)
    return tuple(b and (b[0], order.index(b[1:])) for b in best)


def back_through(costs: tuple, matrix: Matrix) -> tuple:
    """Costs to the end from before a matrix, by state."""

    def least(ways: tuple) -> int | None:
        return min((way[0] + c for way, c in zip(ways, costs, strict=True) if way and c is not None), default=None)

    return tuple(map(least, matrix))


def _less(front: Front) -> tuple[Front, int]:
    low = min(known[0] for known in front if known)
    return tuple(known and (known[0] - low, known[1]) for known in front), low


@lru_cache(maxsize=1 << 16)
def _row_through(front: Front, code: int) -> tuple[Front, int]:
    """``through`` a row, less the least cost: few fronts differ, so most steps are looked up."""
    return _less(through(front, ROWS[code]))


@lru_cache(maxsize=1 << 16)
def _row_back(costs: tuple, code: int) -> tuple:
    found = back_through(costs, ROWS[code])
    low = min(c for c in found if c is not None)
    return tuple(None if c is None else c - low for c in found)


def part_matrix(fronts: list[tuple[Front, int]]) -> Matrix:
    """The matrix of several rows, from the fronts that began at each state and their costs so far."""
    return tuple(tuple(known and (known[0] + base, known[1]) for known in front) for front, base in fronts)


def crossings(items: list, entered: int, left: int, forward, backward) -> list[int]:
    """The states between items of the cheapest and then ASCII-least way from ``entered`` to ``left``."""
    states = [entered] + [left] * len(items)
    spans = [(0, len(items))]
    while spans:
        low, high = spans.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        front = front_at(states[low])
        for at in range(low, middle):
            front = forward(front, items[at])
        costs = tuple(0 if s == states[high] else None for s in range(4))
        for at in range(high - 1, middle - 1, -1):
            costs = backward(costs, items[at])
        met = [(f[0] + c, f[1], s) for s, (f, c) in enumerate(zip(front, costs, strict=True)) if f and c is not None]
        states[middle] = min(met)[2]
        spans += [(low, middle), (middle, high)]
    return states


def row_states(codes: bytes, entered: int, left: int) -> list[int]:
    return crossings(codes, entered, left, lambda front, code: _row_through(front, code)[0], _row_back)


def part_states(matrices: list[Matrix]) -> list[int]:
    """The states at the ends of a conversation's parts."""
    front = front_at(START)
    for matrix in matrices:
        front = through(front, matrix)
    left = min((known[0] + INSERT * CLOSING[s], known[1], s) for s, known in enumerate(front) if known)[2]
    return crossings(matrices, START, left, through, back_through)


@lru_cache(maxsize=256)
def inserted_roles(state: int, n: int) -> tuple[str, ...]:
    roles = []
    for _ in range(n):
        state = NEXT[state]
        roles.append(ROLES[state])
    return tuple(roles)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults of known kinds, by the checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .filter("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def coded(rows: DataFrame) -> DataFrame:
    """Per row ``id`` its conversation, place in the order, and ``code``: four times the fault, plus the initial's place."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    light = rows.select(
        "id",
        "conv_id",
        "turn",
        "role",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
        (F.position(F.substring("role", 1, 1), F.lit(INITIALS)) - 1).alias("place"),
    )
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "id")).alias("e")
    first = light.groupBy("conv_id", "role", "text_hash").agg(earliest).select(F.col("e.id").alias("id"), F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0)
    initial = F.when((F.col("place") < 0) | (F.col("role") == ""), len(INITIALS)).otherwise(F.col("place"))
    return light.join(first, "id", "left").select(
        "id", "conv_id", "turn", "role", "text_hash", (4 * fault + initial).cast("int").alias("code")
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers rows and conversations of a part; the matrix of a conversation's part comes with its last row."""
    part, run, place, last = TaskContext.get().partitionId(), -1, 0, None
    fronts: list = []
    held: pa.RecordBatch | None = None

    def rows(batch: pa.RecordBatch, runs: list[int], begin: int, matrices: list) -> pa.RecordBatch:
        n = len(batch)
        columns = [pa.array([part] * n, pa.int32()), pa.array(runs, pa.int64()), pa.array(range(begin, begin + n), pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, *batch.columns[:4], pa.array(matrices, pa.list_(pa.int64()))], NUMBERED_COLUMNS)

    def flat() -> list[int]:
        return [v for ways in part_matrix(fronts) for way in ways for v in (way or (-1, 0))]

    for batch in batches:
        runs, matrices = [], []
        for conv, code in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if run < 0 or conv != last:
                if matrices:
                    matrices[-1] = flat()
                elif held:
                    held[3][-1] = flat()
                run, last, fronts = run + 1, conv, [(front_at(s), 0) for s in range(4)]
            fronts = [(after, base + low) for front, base in fronts for after, low in [_row_through(front, code)]]
            runs.append(run)
            matrices.append(None)
        if held:
            yield rows(*held)
        if len(batch):
            held = (batch, runs, place, matrices)
            place += len(batch)
    if held:
        held[3][-1] = flat()
        yield rows(*held)


NUMBERED_COLUMNS = ["part", "run", "place", "id", "conv_id", "turn", "code", "matrix"]


def numbered(codes: DataFrame) -> DataFrame:
    """Rows in their order: ``part`` and ``place`` in it, ``run`` for the conversation there, its ``matrix``."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text_hash", "id"]
    dealt = codes.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "conv_id", "turn", "code")
    kinds = dict(dealt.dtypes)
    schema = f"part int, run long, place long, id long, conv_id {kinds['conv_id']}, turn {kinds['turn']}, code int, matrix array<long>"
    return dealt.mapInArrow(_numbered, schema)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the states at the ends of its parts."""
    for batch in batches:
        out: dict[str, list[int]] = {name: [] for name in ("part", "run", "entered", "left", "closing")}
        for parts in batch.column(0).to_pylist():
            matrices = []
            for found in parts:
                ways = [None if cost < 0 else (cost, order) for cost, order in zip(found["matrix"][::2], found["matrix"][1::2], strict=True)]
                matrices.append(tuple(tuple(ways[4 * s : 4 * s + 4]) for s in range(4)))
            states = part_states(matrices)
            for found, entered, left in zip(parts, states, states[1:], strict=False):
                closing = CLOSING[left] if found is parts[-1] else 0
                for name, value in zip(out, (found["part"], found["run"], entered, left, closing), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict({name: pa.array(v, pa.int64()) for name, v in out.items()})


def part_ends(rows: DataFrame) -> DataFrame:
    """``part, run`` with the states ``entered`` and ``left``, and the turns to insert after the conversation's last row."""
    matrices = rows.filter("matrix is not null").groupBy("conv_id")
    parts = matrices.agg(F.sort_array(F.collect_list(F.struct("part", "run", "matrix"))).alias("parts")).select("parts")
    return parts.mapInArrow(_solved, "part long, run long, entered long, left long, closing long")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of whole runs; each run begins with the row of its ends, which is at place -1."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
        begins = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if last is not None and tuple(keys[0]) != last:
            begins = np.concatenate([[0], begins])
        last = tuple(keys[-1])
        if len(begins):
            held.append(batch.slice(0, begins[-1]))
            yield _run_edits(pa.Table.from_batches(held))
            held = [batch.slice(begins[-1])]
        else:
            held.append(batch)
    if held:
        yield _run_edits(pa.Table.from_batches(held))


def _run_edits(rows: pa.Table) -> pa.RecordBatch:
    place, code = rows["place"].to_numpy(), rows["code"].fill_null(0).to_numpy()
    heads = np.flatnonzero(place < 0).tolist()
    ends = {name: rows[name].take(heads).to_pylist() for name in ("entered", "left", "closing")}
    kept: list[int] = []
    edits, costs, before, after = [], [], [], []
    for number, (head, stop) in enumerate(pairwise([*heads, len(rows)])):
        codes = bytes(code[head + 1 : stop].tolist())
        states = row_states(codes, ends["entered"][number], ends["left"][number])
        kept += range(head + 1, stop)
        for kind, entered, left in zip(codes, states, states[1:], strict=False):
            cost, edit = ROWS[kind][entered][left]
            edits.append(edit)
            costs.append(cost)
            before.append(entered)
            after.append(0)
        after[-1] = ends["closing"][number]
        costs[-1] += INSERT * after[-1]
        edits[-1] += "I" * after[-1]
    table = rows.take(pa.array(kept, pa.int64())).select(["conv_id", "part", "place", "id", "turn", "code"]).combine_chunks()
    added = {"state": pa.array(before, pa.int32()), "closing": pa.array(after, pa.int32()), "edits": pa.array(edits, pa.string()), "cost": pa.array(costs, pa.int64())}
    columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
    return pa.RecordBatch.from_arrays([*columns, *added.values()], [*table.column_names, *added])


def edits(rows: DataFrame) -> DataFrame:
    """Per row of ``conv_id, turn, role, text`` what becomes of it.

    ``conv_id, part, place`` give the order; ``edits`` has an ``I`` for each turn
    inserted before, then ``K``, ``R`` or ``D`` for the row, then an ``I`` for each
    of the ``closing`` turns after the conversation's last row; ``state`` is where
    the repair stands before; ``role`` and ``text`` are those given.
    """
    space = F.lit(" ")
    given = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    given = stage(given.withColumn("id", F.monotonically_increasing_id()), "turns")
    order = stage(numbered(coded(given)), "turns-in-order")
    heads = part_ends(order)
    one = order.select("part", "run", "place", "id", "conv_id", "turn", "code").unionByName(
        heads.select(F.col("part").cast("int").alias("part"), "run", F.lit(-1).cast("long").alias("place"), "entered", "left", "closing"),
        allowMissingColumns=True,
    )
    kinds = dict(given.dtypes)
    schema = f"conv_id {kinds['conv_id']}, part int, place long, id long, turn {kinds['turn']}, code int, state int, closing int, edits string, cost long"
    found = one.repartition("part", "run").sortWithinPartitions("part", "run", "place").mapInArrow(_edited, schema)
    return found.join(given.select("id", "role", "text"), "id").drop("id")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows in its order."""
    last, state = None, None
    out: list[dict] = []

    def ended() -> dict:
        turns = state["turns"]
        gaps = 0 if turns is None else turns[1] - turns[0] + 1 - turns[2]
        audit = "".join(state["audit"])
        counts = {name: state["faults"][i] for i, name in enumerate(FAULTS) if i}
        return {"conv_id": last, "gaps": gaps, **counts, "illegal": state["illegal"], "cost": state["cost"], "audit": audit, "repaired_sha256": state["hash"].hexdigest()}

    def line(role: str, text: str = "") -> None:
        state["hash"].update(f"{state['joint']}{role}:{text}".encode())
        state["joint"] = "\n"

    for batch in batches:
        for conv, turn, code, before, closing, edit, cost, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != last:
                if state is not None:
                    out.append(ended())
                last = conv
                state = {"turns": None, "faults": [0] * 4, "illegal": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "joint": "", "initial": None}
            fault, initial = divmod(code, 4)
            state["faults"][fault] += 1
            if turn is not None:
                least, greatest, n = state["turns"] or (turn, None, 0)
                state["turns"] = (least, turn, n + (turn != greatest))
            if state["initial"] is not None and (state["initial"], initial) not in ((0, 1), (1, 2), (2, 1)):
                state["illegal"] += 1
            state["initial"] = initial
            state["cost"] += cost
            state["audit"].append(edit)
            n = len(edit) - 1 - closing
            for inserted in inserted_roles(before, n):
                line(inserted)
            kind = edit[n]
            if kind == "K":
                line(role, text)
            elif kind == "R":
                line(inserted_roles(before, n + 1)[-1], text)
            if closing:
                # a closing turn follows a user's or, before it, makes one
                for inserted in ("user", "assistant")[-closing:]:
                    line(inserted)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_digest_schema(batch.schema.field(0).type))
            out.clear()
    if state is not None:
        yield pa.RecordBatch.from_pylist([ended()], schema=_digest_schema(batch.schema.field(0).type))


NUMBERS = ["gaps", *FAULTS[1:], "illegal", "cost"]


def _digest_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), *[(name, pa.int64()) for name in NUMBERS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def digests(found: DataFrame) -> DataFrame:
    """Per conversation of ``edits`` its faults, cost, audit and the hash of its repaired lines."""
    order = ["conv_id", "part", "place"]
    rows = found.repartition("conv_id").sortWithinPartitions(*order)
    rows = rows.select("conv_id", "turn", "code", "state", "closing", "edits", "cost", "role", "text")
    numbers = ", ".join(f"{name} long" for name in NUMBERS)
    schema = f"conv_id {dict(found.dtypes)['conv_id']}, {numbers}, audit string, repaired_sha256 string"
    return rows.mapInArrow(_digests, schema)


def repaired_digests(rows: DataFrame, given: DataFrame) -> DataFrame:
    """``digests`` of ``rows`` for every ``conv_id`` of ``given``; one without rows has zeros and empty texts."""
    ids = given.select("conv_id").distinct().alias("g")
    found = digests(edits(rows)).alias("f")
    joined = ids.join(found, F.col("g.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    numbers = [F.coalesce(name, F.lit(0)).alias(name) for name in NUMBERS]
    nothing = hashlib.sha256().hexdigest()
    return joined.select("g.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired_digests(damaged(rows), rows)
