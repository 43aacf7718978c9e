"""Benchmark passages in documents, against the SQL, on odd rows and frequent passages."""

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from tallyhouse.llm import decontamination

DOCS = "doc_id long, text string, row string, n int, words string, item string, shingle int, places string"
ITEMS = "item_id long, text string, n int, words string, doc_id int"


def _frame(spark, rows, schema):
    blank = [None] * (len(schema.split(", ")) - 2)
    return spark.createDataFrame([(*r, *blank) for r in rows], schema)


def _same_as_sql(found, docs, items):
    db = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        db.register(name, pa.table({key: pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    wanted = db.execute(decontamination.ORACLE)
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(found.columns)
    have = Counter(tuple(r) for r in found.select(*names).collect())
    assert have == Counter(wanted.fetchall())
    return {r[0]: dict(zip(names, r, strict=True)) for r in have}


def _prose(rng, n, words=40):
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "élan", "the"]) + str(rng.randrange(words)) for _ in range(n))


def _upper(text):
    return "".join(c.upper() if c.isascii() else c for c in text)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(7)
    items = [(i, _prose(rng, 12 + i)) for i in range(12)]
    items += [(20, "rare four words here"), (21, "two words"), (22, "soloword"), (23, None), (24, ""), (25, " .,! "), (None, "an item of no id"), (None, "another such item")]
    items += [(30, items[3][1]), (31, " ".join(items[4][1].split()[2:13])), (20, "rare four words here"), (32, "ten " * 30)]
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a two Words, b"), (6, "SOLOWORD!"), (6, "SOLOWORD!"), (None, "rare, four: words (here) soloword")]
    docs += [(10 + i, f"{_prose(rng, 30)} {_upper(items[i][1])} {_prose(rng, 20)}") for i in range(12)]
    docs += [(40 + i, items[5][1].replace(" ", " -- ")) for i in range(30)]
    docs += [(80, " ".join(items[6][1].split()[:9])), (81, " ".join(items[6][1].split()[:10])), (82, " ".join(items[6][1].split()[1:]) + " " + items[6][1])]
    docs += [(83, "ten " * 3000), (84, "ten " * 9), (85, "rare four words"), (86, "an item of no id"), (87, "four words here rare four"), (88, (items[7][1] + " ") * 200)]
    docs += [(100 + i, _prose(rng, 200, 900)) for i in range(40)]
    return docs, items


def test_equals_its_sql(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(decontamination, "PIECE", 7)  # rows of few places
    found = decontamination.contaminated(_frame(spark, docs, DOCS).repartition(3), _frame(spark, items, ITEMS).repartition(2))
    by = _same_as_sql(found, docs, items)
    assert by[80]["n_hit"] == 0 and by[81]["n_hit"] == 10
    assert by[83]["n_hit"] == by[83]["n_words"] == 3000 and by[84]["n_hit"] == 0
    assert by[13]["n_items"] == 2 and by[86]["n_items"] == 1
    assert not any(by[100 + i]["contaminated"] for i in range(40))


def test_a_crowded_bit_table_only_costs_time(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(decontamination, "LEAST_BITS", 4)
    monkeypatch.setattr(decontamination, "MOST_BITS", 4)
    _same_as_sql(decontamination.contaminated(_frame(spark, docs, DOCS), _frame(spark, items, ITEMS)), docs, items)


def test_counts_are_handed_on_in_pieces(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(decontamination, "COUNTED_AT_ONCE", 5)
    _same_as_sql(decontamination.contaminated(_frame(spark, docs, DOCS), _frame(spark, items, ITEMS)), docs, items)


@pytest.mark.parametrize("some_docs,some_items", [(True, False), (False, True), (False, False)])
def test_empty_tables(spark, tables, some_docs, some_items):
    docs, items = (tables[0] if some_docs else []), (tables[1] if some_items else [])
    found = decontamination.contaminated(_frame(spark, docs, DOCS), _frame(spark, items, ITEMS))
    _same_as_sql(found, docs, items)
    assert found.filter("contaminated").count() == 0


def test_the_prefix_is_the_rarest_shingle(spark):
    """Of a window with a common and a rare end, the rare one is looked for."""
    common = "here is a very common start of a sentence"
    items = [(1, f"{common} zebra quagga okapi")]
    docs = [(i, common) for i in range(50)] + [(99, f"{common} zebra quagga okapi")]
    cut = decontamination.windows(_frame(spark, items, ITEMS)).cache()
    table = decontamination.bit_table(cut.selectExpr("explode(shingles) as shingle"), 20)
    counts = _frame(spark, docs, DOCS).select("text").mapInArrow(decontamination._counts(table, [3]), "shingle long, n long")
    prefix = decontamination.prefixes(cut, counts.groupBy("shingle").agg({"n": "sum"}).toDF("shingle", "found")).collect()
    assert len(prefix) == 3 and all(" ".join(r.words.split()[r.offset : r.offset + 3]) not in common for r in prefix)
