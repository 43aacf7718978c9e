import csv
import datetime as dt
import json
import random

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.plans import loyalty, orders
from tallyhouse.sources import csv_records, exports, mirror, reference_csv, snapshots
from tallyhouse.staging import stage


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


# --- exports


def test_columns_are_united_by_name(spark, tmp_path, rows):
    folder = tmp_path / "in put"
    write(folder, "order_history_20260101_20260107.csv", "A,B,C\n1,2,3\n4,,\"\"\n")
    write(folder, "order_history_20260108_20260114.csv", "﻿C,A,D\nz,3,q\n")
    write(folder, "order_history_20260115_20260121.csv", "A,B,C\n")
    write(folder, "again [1] {x}.csv", "D,A\nr,5\n")
    write(folder, "notes.txt", "A\n9\n")
    got = exports.read_exports(spark, str(folder))
    assert rows(got, "A", "B", "C", "D") == [("1", "2", "3", None), ("3", None, "z", "q"), ("4", None, None, None), ("5", None, None, "r")]
    named = {r.A: r._source_file.rsplit("/", 1)[1] for r in got.collect()}
    assert named["3"] == "order_history_20260108_20260114.csv"
    assert got.schema["_loaded_at"].dataType.typeName() == "timestamp"


def test_quotes_and_line_breaks(spark, tmp_path, rows):
    write(tmp_path, "a.csv", 'A,B\n1,"he said ""hi"", ok\nline2"\n2,"back\\slash"\n')
    want = [("1", 'he said "hi", ok\nline2'), ("2", "back\\slash")]
    assert rows(exports.read_exports(spark, str(tmp_path)), "A", "B") == want


def test_row_numbers_follow_files_and_rows(spark, tmp_path):
    # The longer file is scheduled first; the order must come from the names.
    write(tmp_path, "a.csv", "A,B\n" + "".join(f"a{i},x\n" for i in range(20)))
    write(tmp_path, "b.csv", "B,A\n" + "".join(f"y,b{i}\n" for i in range(500)))
    write(tmp_path, "c.csv", "A,B\n" + "".join(f"c{i},z\n" for i in range(100)))
    got = [r.A for r in exports.read_exports(spark, str(tmp_path)).orderBy("_row_seq").collect()]
    assert got == [f"a{i}" for i in range(20)] + [f"b{i}" for i in range(500)] + [f"c{i}" for i in range(100)]


@pytest.fixture
def split_size(spark):
    """Sets the size of splits; Spark reads it when a job runs."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_large_files_are_split(spark, tmp_path, split_size, line_end):
    """Random cells with quotes and line breaks, cut every few bytes, against the csv module."""
    rng = random.Random(11)
    words = ["a", "bb", "", 'say "hi"', "x,y", f"line{line_end}break", '"', line_end, f'{line_end}"{line_end}', "é⭐️", "back\\slash", '",",', '"""']
    want = []
    for name in ("a.csv", "b.csv"):
        data = [[f"{name}{i}", rng.choice(words), rng.choice(words)] for i in range(120)]
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f, lineterminator=line_end).writerows([["id", 'B "x"', "C`d"], *data])
        want += data
    for size in (61, 1000, 1 << 27):
        split_size(size)
        rows = exports.read_exports(spark, str(tmp_path))
        got = [list(r)[:3] for r in rows.select("id", '`B "x"`', "`C``d`", "_row_seq").orderBy("_row_seq").collect()]
        assert got == [[c or None for c in row] for row in want]


STRAY = ["id,size", '1,7in 5" pizza', '2,"a ""b"""', '3,"x" y', '4, "z', '5,it\'s "so", '.rstrip(", "), '6,"p', 'q"', "7,w"]


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\r"])
def test_one_answer_for_every_split_size(spark, tmp_path, split_size, line_end):
    """Quotes inside unquoted cells, all kinds of line ends, and blank lines."""
    text = line_end + line_end.join(STRAY[:4]) + line_end * 3 + line_end.join(STRAY[4:])
    (tmp_path / "a.csv").write_bytes(text.encode())
    want = [("1", '7in 5" pizza'), ("2", 'a "b"'), ("3", '"x" y'), ("4", ' "z'), ("5", 'it\'s "so"'), ("6", f"p{line_end}q"), ("7", "w")]
    for size in (7, 20, 1 << 27):
        split_size(size)
        got = exports.read_exports(spark, str(tmp_path))
        assert got.count() == 7
        assert [tuple(r) for r in got.orderBy("_row_seq").select("id", "size").collect()] == want


def test_lines_of_whole_records_are_not_shuffled(spark, tmp_path, split_size):
    """Only what goes over the edge of a split is, and nothing if no record does."""
    write(tmp_path, "a.csv", "A,B\n" + "".join(f'{i},"x\ny{i}"\n' for i in range(200)))
    plan = lambda rows: rows._jdf.queryExecution().executedPlan().toString()

    def read(size):
        split_size(size)
        lines = csv_records.read_lines(spark, str(tmp_path))
        splits = stage(csv_records.read_splits(lines), "splits")
        return splits, csv_records.read_records(lines, splits)

    splits, records = read(1 << 20)
    assert splits.count() == 1 and records.count() == 200
    assert "Window" not in plan(records) and "hashpartitioning" not in plan(records)
    splits, records = read(64)
    assert splits.filter("entered = 1").count() > 5
    assert "Window" not in plan(records) and "edge" in plan(records)
    assert sorted((r.line, r.value) for r in records.collect()) == [(2 + 2 * i, f'{i},"x\ny{i}"') for i in range(200)]


@pytest.mark.parametrize(("size", "scans"), [(50, 1), (200_000, 2)])
def test_lines_are_not_read_again_for_records_over_an_edge(spark, tmp_path, split_size, size, scans):
    """Their pieces come from the pass for the states, unless one is too long to be kept there."""
    cell = "\n".join("y" * 9 for _ in range(size // 10))
    write(tmp_path, "a.csv", "A,B\n" + "".join(f'{i},"{cell}{i}"\n' for i in range(12)))
    split_size(size * 3 // 2)
    got = exports.read_exports(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == scans
    assert [(r.A, r.B) for r in got.orderBy("_row_seq").collect()] == [(str(i), f"{cell}{i}") for i in range(12)]


def test_same_rows_as_duckdb(spark, tmp_path, rows):
    write(tmp_path, "a.csv", 'A,B\n1,7in 5" pizza\n2,"x\ny"\n')
    write(tmp_path, "b.csv", 'B,C`d\n"say ""hi"", you",q\n,r\n')
    read = f"read_csv('{tmp_path}/*.csv', all_varchar = true, union_by_name = true, header = true, delim = ',', quote = '\"', escape = '\"', strict_mode = false)"
    want = sorted(map(repr, duckdb.sql(f"SELECT A, B, \"C`d\" FROM {read}").fetchall()))
    assert sorted(repr(tuple(r)) for r in exports.read_exports(spark, str(tmp_path)).select("A", "B", "`C``d`").collect()) == want


def test_long_lines_and_cells(spark, tmp_path):
    """Patterns neither recurse nor backtrack on many cells or quotes."""
    many = ",".join(f"c{i}" for i in range(5000))
    write(tmp_path, "a.csv", f'{many}\n"{"" * 3}{chr(34) * 200_000}"{"," * 4999}\n')
    got = exports.read_exports(spark, str(tmp_path)).select("c0").collect()
    assert [len(r.c0) for r in got] == [100_000]


def test_unclosed_cells_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", 'A,B\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="not closed in .*a.csv"):
        exports.read_exports(spark, str(tmp_path))


def test_repeated_and_blank_headers():
    assert exports.unique_names(["A", "a", "", "B", "A"]) == ["A", "a_1", "column2", "B", "A_2"]


def test_malformed_export_stops_the_job(spark, tmp_path):
    write(tmp_path, "a.csv", "A,B\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        exports.read_exports(spark, str(tmp_path)).select("A", "B").collect()


def test_file_ranges_include_header_only_files(spark, tmp_path):
    write(tmp_path, "order_history_20260101_20260107.csv", "A\n")
    write(tmp_path, "x_order_history_20260108_20260114.csv", "A\n1\n")
    write(tmp_path, "order_history_2026_20260114.csv", "A\n1\n")
    files = exports.list_files(spark, str(tmp_path))
    got = sorted(tuple(r)[1:] for r in exports.file_ranges(files).collect())
    assert got == [(dt.date(2026, 1, 1), dt.date(2026, 1, 7)), (dt.date(2026, 1, 8), dt.date(2026, 1, 14))]
    write(tmp_path, "order_history_20260199_20260207.csv", "A\n")
    with pytest.raises(PySparkException):
        exports.file_ranges(exports.list_files(spark, str(tmp_path))).collect()


# --- reference files


def test_menu(spark, tmp_path, rows):
    header = "item_name,category,subcategory,is_veg,size,list_price,unit_cost,active\n"
    write(tmp_path, "menu.csv", header + '"Tea, hot",Drinks,,true,,12.5,,false\nBun,Bread,,,L,,3,true\n')
    assert rows(reference_csv.read_menu(spark, str(tmp_path / "menu.csv")).drop("_row_seq")) == [
        ("Bun", "Bread", None, None, "L", None, 3.0, True),
        ("Tea, hot", "Drinks", None, True, None, 12.5, None, False),
    ]
    write(tmp_path, "bad.csv", header + "Bun,Bread,,maybe,L,,3,true\n")
    with pytest.raises(PySparkException):
        reference_csv.read_menu(spark, str(tmp_path / "bad.csv")).collect()


def test_price_sheet(spark, tmp_path):
    write(
        tmp_path,
        "sheet.csv",
        "making_cost,item_name,zomato_list_price,extra\n1, Tea ,10,a\n,,5,b\nx,Bun,1_000,c\n2,Tea,,d\n,Éclair, 7.5 ,\n",
    )
    got = reference_csv.read_price_sheet(spark, str(tmp_path / "sheet.csv")).orderBy("sheet_seq")
    picked = [tuple(r) for r in got.select("item_name", "zomato_list_price", "making_cost", "local_price").collect()]
    assert picked == [("Tea", None, 2.0, None), ("Bun", 1000.0, None, None), ("Éclair", 7.5, None, None)]


def test_price_sheet_is_optional(spark, tmp_path):
    for path in (None, str(tmp_path / "none.csv")):
        sheet = reference_csv.read_price_sheet(spark, path)
        assert sheet.isEmpty() and "zomato_list_price" in sheet.columns


# --- snapshots

ORDER = {
    "order_id": 7, "status": "confirmed", "order_type": "pickup", "food_total": 250, "delivery_fee": 0, "total": 250,
    "created_at": "2026-08-16T09:00:00Z", "confirmed_at": "2026-08-16T10:00:00+05:30", "customer_phone": "ph1",
    "customer_name": None,
    "items": [{"catalog_id": 3, "name": "Tea", "qty": "2", "unit_price": 12.5}, {"name": "Bun", "qty": None, "unit_price": "x"}],
}


def written(tmp_path, *documents):
    folder = tmp_path / f"snap{len(list(tmp_path.iterdir()))}"
    for i, document in enumerate(documents):
        write(folder, f"{i}.json", json.dumps(document, indent=1))
    return str(folder)


def direct_raw(spark, tmp_path, *documents):
    found = snapshots.read_sections(spark, written(tmp_path, *documents), snapshots.ORDERS_SECTIONS)
    return snapshots.direct_orders_raw(found["orders"])


def loyalty_sections(spark, path, **how):
    found = snapshots.read_sections(spark, str(path), snapshots.LOYALTY_SECTIONS, **how)
    return {name: snapshots.raw_elements(elements) for name, elements in found.items()}


def test_direct_orders(spark, tmp_path, rows):
    one = {"ok": True, "generated_at": "2026-08-17", "orders": [ORDER]}
    two = {"ok": 1, "generated_at": "2026-08-18", "orders": [{**ORDER, "order_id": "8", "items": []}]}
    three = {"ok": "yes", "orders": []}
    raw = direct_raw(spark, tmp_path, one, two, three)
    typed = orders.direct_orders(raw)
    placed = dt.datetime(2026, 8, 16, 10)
    assert rows(typed, "order_id", "source", "order_placed_at", "slot_at", "total", "customer_name") == [
        (7, "direct", placed, None, 250, None),
        (8, "direct", placed, None, 250, None),
    ]
    assert rows(orders.direct_order_items(raw)) == [
        (7, "direct", "3", "Tea", 2, 12.5),
        (7, "direct", None, "Bun", None, None),
    ]
    assert rows(raw, "_generated_at") == [("2026-08-17",), ("2026-08-18",)]


@pytest.mark.parametrize("field", snapshots.DIRECT_REQUIRED)
def test_direct_orders_need_their_fields(spark, tmp_path, field):
    short = {k: v for k, v in ORDER.items() if k != field}
    raw = direct_raw(spark, tmp_path, {"ok": True, "orders": [ORDER, short]})
    with pytest.raises(PySparkException, match=f"order without {field}"):
        raw.select("order_id").collect()


@pytest.mark.parametrize("flag", [{"ok": False}, {}, {"ok": None}, {"ok": 0}, {"ok": ""}])
def test_refused_snapshot_writes_nothing(spark, tmp_path, flag):
    document = {**flag, "ledger": [{"id": 1}]}
    with pytest.raises(ValueError, match="refused"):
        loyalty_sections(spark, written(tmp_path, {"ok": True}, document))
    parsed = spark.createDataFrame([(json.dumps(document),)], "doc string").selectExpr(
        f"from_json(doc, '{snapshots.LOYALTY_ENVELOPE}') d"
    )
    out = tmp_path / "out"
    with pytest.raises(PySparkException, match="refused"):
        snapshots.raw_section(snapshots.require_ok(parsed.select("d.*")), "ledger").write.parquet(str(out))
    assert not list(out.glob("*.parquet"))


def test_empty_and_broken_snapshots_are_refused(spark, tmp_path):
    write(tmp_path, "empty.json", "")
    with pytest.raises((ValueError, PySparkException)):
        loyalty_sections(spark, tmp_path / "empty.json")
    write(tmp_path, "page.json", "<html>sign in</html>")
    with pytest.raises((ValueError, PySparkException)):
        loyalty_sections(spark, tmp_path / "page.json")


def test_documents_per_line_are_never_cut_short(spark, tmp_path):
    lines = [json.dumps({"ok": True, "ledger": [{"id": i}]}) for i in range(3)]
    write(tmp_path, "lines.json", "\n".join(lines) + "\n")
    with pytest.raises(ValueError, match="one_per_line"):
        loyalty_sections(spark, tmp_path)
    assert loyalty_sections(spark, tmp_path, one_per_line=True)["ledger"].count() == 3


@pytest.mark.parametrize(
    "text,one_per_line",
    [
        ('{"ok": true}{"ok": false}', False),
        ('{"ok": true}, {"ok": true}', False),
        ('{"ok": true} {"ok": true}\n', True),
        ('{"ok": true,\n "ledger": [1', False),
        ('{"ok": true} rest', False),
        ('[{"ok": true}]', False),
        ("null", False),
        ("{'ok': true}", False),
    ],
)
def test_a_unit_holds_exactly_one_document(spark, tmp_path, text, one_per_line):
    write(tmp_path, "good.json", '{"ok": true}\n')
    write(tmp_path, "two.json", text)
    with pytest.raises(ValueError, match="exactly one document"):
        loyalty_sections(spark, tmp_path, one_per_line=one_per_line)


def test_a_snapshot_without_orders_is_refused(spark, tmp_path):
    for orders_section in ({}, {"orders": None}, {"orders": {"a": 1}}):
        with pytest.raises(ValueError, match="no orders"):
            direct_raw(spark, tmp_path, {"ok": True, "orders": []}, {"ok": True, **orders_section})


def test_a_snapshot_is_read_once(spark, tmp_path):
    """All sections come from one job over the source; what is read later is the stored table."""
    group = "snapshot-once"
    path = written(tmp_path, {"ok": True, "ledger": [{"id": 1}, {"id": 2}], "balances": [{"customer_id": 1}]})
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = loyalty_sections(spark, path)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert [found[name].count() for name in ("ledger", "balances", "referrals")] == [2, 1, 0]
    assert all(path not in file for file in found["ledger"].inputFiles())


def test_loyalty_sections(spark, tmp_path, rows):
    document = {
        "ok": True,
        "ledger": [{"id": 1, "customer_id": "5", "delta": -20, "kind": "spend", "order_id": "x", "extra": {"a": [1]}}],
        "referrals": [
            {"id": i, "same_device": s, "created_at": "2026-08-16 10:00:00", "rewarded_at": "2026"}
            for i, s in ((1, 0), (2, 1), (3, None), (4, True), (5, "1"))
        ],
    }
    found = loyalty_sections(spark, written(tmp_path, document))
    raw = found["ledger"]
    assert json.loads(raw.first().raw) == document["ledger"][0]
    assert rows(loyalty.ledger(raw)) == [(1, 5, None, -20, "spend", None, None, None)]
    assert found["balances"].isEmpty()
    flags = loyalty.referrals(found["referrals"]).orderBy("referral_id")
    assert [r.same_device for r in flags.collect()] == [False, True, None, None, True]
    assert {(str(r.created_at), r.rewarded_at) for r in flags.collect()} == {("2026-08-16 10:00:00", None)}


# --- mirror

COLUMNS = {
    "whole": [1, 2, None], "part": [1, 2.5, None], "text": ["a", "b", None], "flag": [True, False, None],
    "day": ["2026-08-16", "2026-01-01", None], "at": ["2026-08-16 10:00:00", "2026-08-16 11:00:00", None], "at_t": ["2026-08-16T10:00:00.25", "2026-08-16T11:00:00.5", None], "at_both": ["2026-08-16 10:00:00", "2026-08-16T11:00:00", None], "at_uneven": ["2026-08-16 10:00:00", "2026-08-16 11:00:00.5", None],
    "zone": ["2026-08-16T10:00:00.25Z", "2026-08-16 10:00:00+05:30", None], "day_or_time": ["2026-08-16", "2026-08-16 10:00:00", None],
    "iso": ["2026-08-16T10:00:00Z", None, "2026-08-16T10:00:01Z"], "day_or_word": ["2026-08-16", "soon", None],
    "mixed": [1, "a", None], "nothing": [None, None, None], "object": [{"a": 1, "b": "x"}, None, {"a": 2, "b": None}],
    "list": [[1, 2], [], None], "flag_or_number": [True, 3, None], "time": ["10:00:00", "11:00:00", None],
    "number_text": ["1", "2", None],
}
STAMP = "2026-08-29T10:00:00.000Z"


def mirror_of(spark, tmp_path, *documents):
    return mirror.read_mirror(spark, written(tmp_path, *documents))


def test_mirror_types(spark, tmp_path):
    table = {"columns": list(COLUMNS), "rows": [list(r) for r in zip(*COLUMNS.values())]}
    got = mirror_of(spark, tmp_path, {"ok": True, "generated_at": STAMP, "tables": {"t": table}}).tables["t"]
    records = [dict(zip(COLUMNS, r), synced_at=STAMP) for r in zip(*COLUMNS.values())]
    (tmp_path / "records.json").write_text(json.dumps(records))
    con = duckdb.connect()
    read = f"read_json_auto('{tmp_path}/records.json')"
    wanted = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE SELECT * FROM {read}").fetchall()}
    alike = {
        "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "struct<a:bigint,b:string>": "STRUCT(a BIGINT, b VARCHAR)",
        "array<bigint>": "BIGINT[]",
    }
    kinds = {f.name: alike[f.dataType.simpleString()] for f in got.schema}
    # JSON columns are text here, and times of day stay text.
    text = {name: "VARCHAR" if kind in ("JSON", "TIME", '"NULL"') else kind for name, kind in wanted.items()}
    assert kinds == text
    plain = [c for c, kind in wanted.items() if kind != "TIME" and not kind.startswith("STRUCT")]
    picked = ", ".join(f'timezone(\'UTC\', "{c}")' if "ZONE" in wanted[c] else f'"{c}"' for c in plain)
    want = con.execute(f"SELECT {picked} FROM {read}").fetchall()
    have = [tuple(r) for r in got.select(*[F.to_timestamp_ntz(c) if "ZONE" in wanted[c] else c for c in plain]).collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, want))
    assert [r.object and tuple(r.object) for r in got.select("object").collect()].count((1, "x")) == 1


def test_mirror_short_rows_and_reports(spark, tmp_path, rows):
    document = {
        "ok": True,
        "generated_at": "2026-08-29",
        "tables": {
            "short": {"columns": ["a", "b", "c"], "rows": [[1], [2, "x"], [None, "y", ]]},
            "bare": {"columns": [], "rows": []},
            "no_rows": {"columns": ["a"], "rows": []},
            "stamped": {"columns": ["synced_at", "a"], "rows": [["never", 1]]},
        },
        "failed": {"lost": "timeout"},
    }
    found = mirror_of(spark, tmp_path, document)
    assert found.tables["short"].columns == ["a", "b", "synced_at"]
    assert rows(found.tables["short"], "a", "b") == [(1, None), (2, "x"), (None, "y")]
    assert found.empty == ["bare"] and found.failed == {"lost": "timeout"}
    assert found.tables["no_rows"].columns == ["json"] and found.tables["no_rows"].isEmpty()
    assert rows(found.tables["stamped"]) == [(dt.date(2026, 8, 29), 1)]


def test_mirror_pages_may_order_columns_differently(spark, tmp_path, rows):
    pages = [
        {"ok": True, "generated_at": "2026-08-29", "tables": {"t": {"columns": ["a", "b"], "rows": [[1, "x"], [2]]}}},
        {"ok": True, "generated_at": "2026-08-29", "tables": {"t": {"columns": ["b", "a", "c"], "rows": [["y", 3, 0.5]]}}},
    ]
    found = mirror_of(spark, tmp_path, *pages).tables["t"]
    assert rows(found, "a", "b", "c") == [(1, "x", None), (2, None, None), (3, "y", 0.5)]


def test_mirror_needs_its_sections(spark, tmp_path):
    with pytest.raises(ValueError, match="no tables"):
        mirror_of(spark, tmp_path, {"ok": True, "generated_at": "2026-08-29"})
