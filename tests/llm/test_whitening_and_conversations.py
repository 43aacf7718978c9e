"""Whitening against NumPy's own decomposition, and conversation repair against a plain search."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from tallyhouse.llm import conversations, whitening

# --- whitening ---------------------------------------------------------------------


def _matrices():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "drawn", (x := rng.standard_normal((300, 24)) * rng.uniform(0.1, 9, 24)).T @ x
    yield "equal values", q @ np.diag(np.r_[np.full(20, 5.0), np.linspace(0, 4, 20)]) @ q.T
    yield "value at the mean", np.diag([-1.0, 0, 1])
    yield "low rank", (x := rng.standard_normal((3, 30))).T @ x
    yield "wide", np.diag([1e8, 1, 1e-8, 0])
    yield "scalar", np.eye(5) * 3
    yield "zero", np.zeros((4, 4))
    yield "one", np.array([[2.0]])


@pytest.mark.parametrize("name,a", list(_matrices()))
def test_components(name, a):
    a = (a + a.T) / 2
    values, vectors = whitening.components(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * size


def test_polar_factor_of_singular_and_tiny_matrices():
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((6, 6)))[0]
    for values in ([1, -1, 2, -3, 1e-9, -1e-12], [1e-200, -1e-200, 3e-200, 1e-200, -2e-200, 5e-200]):
        u = whitening.polar_factor(q @ np.diag(values) @ q.T)
        assert np.abs(u @ u.T - np.eye(6)).max() < 1e-12
        assert np.abs(u - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-3  # the sign of 1e-12 is at the rounding


def _expected(rows, k=4):
    """The contract, by NumPy: ``vec_id, component`` to the row's other values."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for size in {len(v) for _, v in usable}:
        fixed = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in usable if len(v) == size]
        x = np.array(sorted({tuple(v) for _, v in fixed}), float)
        n, total = len(x), [sum(int(v) for v in column) for column in x.T]
        u = x - np.array(total) / n
        cov = u.T @ u / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        for i, v in fixed:
            deviation = sum((n * c - t) ** 2 for c, t in zip(v, total, strict=True))
            for c in range(min(k, size)):
                flat = values[c] <= 1e-12 * max(np.trace(cov), 1e-300)
                w = None if flat else abs((np.array(v) - np.array(total) / n) @ vectors[:, c] / math.sqrt(values[c]))
                out.append((i, c + 1, n, deviation, w, 0.0 if flat else values[c] / np.trace(cov)))
    return out


SCHEMA = "vec_id long, embedding array<float>, size int, n long, x string, dim int, `row` string, part int"


def _vectors(rows):
    return [(i, v, 1, 2, "x", 3, "r", 4) for i, v in rows]


def _check(spark, rows):
    found = whitening.whitened(spark.createDataFrame(_vectors(rows), SCHEMA).repartition(3)).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[5], 6))
    have = sorted(((r.vec_id, r.component, r.n, r.deviation, None if r.whitened is None else abs(r.whitened), r.explained) for r in found), key=key)
    want = sorted(_expected(rows), key=key)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    for h, w in zip(have, want, strict=True):
        assert (h[4] is None) == (w[4] is None)
        assert h[4] is None or h[4] == pytest.approx(w[4], rel=1e-6, abs=1e-9)
        assert h[5] == pytest.approx(w[5], rel=1e-9, abs=1e-12)
    return found


def test_whitened(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.2, 8)
    rows = [(i, [float(v) for v in rng.standard_normal(8) * scale]) for i in range(200)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(5, rows[5][1]), (None, rows[6][1])]
    rows += [(2000, None), (2001, [1.0, None] * 4), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (2004, [])]
    rows += [(3000 + i, [float(v) for v in rng.standard_normal(2)]) for i in range(9)]
    rows += [(4000, [1.0, 2.0, 3.0])]  # alone of its length: no variance
    found = _check(spark, rows)
    assert all(r.identity_error < 1e-9 for r in found if r.n == 200 or r.n == 9)
    assert [r.identity_error for r in found if r.vec_id == 4000] == [None] * 3
    assert len([r for r in found if r.vec_id == 5]) == 8
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whitened_entries_beyond_a_long(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 5.0])]
    found = whitening.whitened(spark.createDataFrame(_vectors(rows), SCHEMA)).collect()
    assert len(found) == 6 and {r.deviation for r in found if r.vec_id < 3} == {None}
    # beside such entries the other dimension is below the rounding
    assert all((r.whitened is None) == (r.component == 2) for r in found)


def test_whitened_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = whitening.op11_whitening(spark, sf_dir).collect()
    want = {(r[0], r[1]): r for r in _expected(rows)}
    assert len(found) == len(want) == 4 * len(rows)
    for r in found:
        w = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == w[2:4] and r.identity_error <= 1e-4
        assert abs(r.whitened) == pytest.approx(w[4], rel=1e-6, abs=1e-9) and r.explained == pytest.approx(w[5], rel=1e-9)


# --- conversations ---------------------------------------------------------------


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(conversations.BLANKS)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "none"
        seen.add((role, text))
        out.append(fault)
    return out


def _cheapest(rows, faults):
    """Cost, audit and repaired turns, from the end to the start over all ways."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {s: (0, "", ()) if s in ("", "a") else None for s in after}

    def inserts(best):
        for _ in range(3):  # one turn inserted at a time
            for s, role in after.items():
                then = best.get(role)
                if then:
                    way = (3 + then[0], "I" + then[1], ((names[role], ""), *then[2]))
                    best[s] = min(best[s] or way, way)
        return best

    best = inserts(best)
    for (_, role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        before = {}
        for s, role_after in after.items():
            ways = [(4 + best[s][0], "D" + best[s][1], best[s][2])] if best[s] else []
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                then = best[role_after]
                if then:
                    ways.append((3 + extra + then[0], "R" + then[1], ((names[role_after], text), *then[2])))
                initial = role[:1]
                if (initial == role_after or (initial, s) == ("s", "")) and best.get(initial):
                    then = best[initial]
                    ways.append((extra + then[0], "K" + then[1], ((role, text), *then[2])))
            before[s] = min(ways, default=None)
        best = inserts(before)
    return best[""]


def _digest(rows):
    """The contract's row for one conversation of ``turn, role, text`` in order."""
    faults = _faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, repaired = _cheapest(rows, faults)
    assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in repaired))
    text = "\n".join(f"{role}:{text}" for role, text in repaired)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def _by_conversation(rows):
    found = {}
    rows = [(conv, turn, " " if role is None else role, " " if text is None else text) for conv, turn, role, text in rows]
    text_hash = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], text_hash(r[3]))):
        found.setdefault(conv, []).append((turn, role, text))
    return found


COLUMNS = [*conversations.NUMBERS, "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string, id long, code int, part string, place int, kind string, matrix int"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "p", 9, "k", 1) for r in rows], TURNS)


def _drawn(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "uncle"]
    texts = ["Yes.", "No!", "cut off", "", " \t", "Ends? ", "é ok.\n", "so it goes"]
    return [(conv, t, rng.choice(roles), rng.choice(texts) + ("" if rng.random() < 0.4 else f" {t}.")) for t in range(n) if rng.random() < 0.9]


def test_repair_equals_a_plain_search(spark):
    rng = random.Random(4)
    rows = [r for conv in range(250) for r in _drawn(rng, conv, rng.randrange(14))]
    rows += [(900, None, "user", "No turn."), (900, None, "assistant", "None."), (900, 3, "user", "Three."), (900, 3, "user", "Three.")]
    rows += [(None, 0, "user", "Who?"), (None, 1, None, None), (901, None, None, None), (902, 5, "system", "Alone.")]
    found = conversations.repaired_digests(_turns(spark, rows).repartition(3), _turns(spark, [*rows, (903, 0, "user", "Gone.")]))
    have = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    want = {conv: _digest(turns) for conv, turns in _by_conversation(rows).items()}
    assert have.pop(903) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert have == want
    assert want[902][5:7] == (4, "D") and want[901][6] == "D"


def test_repair_of_one_conversation_over_many_parts(spark):
    """A hot conversation is cut into ranges; its edits are those of the whole."""
    rng = random.Random(5)
    rows = _drawn(rng, 7, 700) + [r for conv in range(20) for r in _drawn(rng, conv + 8, 3)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = conversations.edits(_turns(spark, rows)).cache()
        assert edits.filter("conv_id = 7").select("part").distinct().count() > 4
        have = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversations.digests(edits).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert have == {conv: _digest(turns) for conv, turns in _by_conversation(rows).items()}


def test_empty_conversations(spark):
    none = _turns(spark, [])
    assert conversations.repaired_digests(conversations.damaged(none), none).count() == 0
    assert conversations.edits(none).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"Turn {t}. So?") for c in range(20) for t in range(6)] + [(None, None, None, None), (1, None, "user", None)]
    have = [tuple(r) for r in conversations.damaged(_turns(spark, rows)).collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, _damaged(rows)))


def test_repair_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    have = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversations.op13_conversation_repair(spark, sf_dir).collect()}
    left = {conv: _digest(turns) for conv, turns in _by_conversation(_damaged(rows)).items()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert have == {conv: left.get(conv, nothing) for conv in {r[0] for r in rows}}
