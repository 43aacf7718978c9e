"""Mirror of arbitrary tables from columns-and-rows snapshots, types inferred."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage
from .snapshots import check, read_documents, require_ok

TABLES_ENVELOPE = (
    "ok variant, generated_at string, "
    "tables map<string, struct<columns: array<string>, rows: array<array<variant>>>>, "
    "failed map<string, string>"
)

# Fixed value: the column that says when a snapshot was taken.
SYNCED_AT = "synced_at"

# Text columns whose values all have one of these forms become dates or times.
_DAY, _CLOCK = r"^\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}:\d{2}:\d{2}"
_FORMS = {
    "date": (rf"{_DAY}$", "date"),
    "blank": (rf"{_DAY} {_CLOCK}$", "timestamp_ntz"),
    "blank, fraction": (rf"{_DAY} {_CLOCK}\.\d+$", "timestamp_ntz"),
    "T": (rf"{_DAY}T{_CLOCK}$", "timestamp_ntz"),
    "zone": (rf"{_DAY}[ T]{_CLOCK}(\.\d+)?(Z|[+-]\d{{2}}(:\d{{2}})?)$", "timestamp"),
}


@dataclass
class Mirror:
    """Typed tables by name, and what could not be mirrored."""

    tables: dict[str, DataFrame]
    empty: list[str]
    failed: dict[str, str]


def _cells(layouts: list[list[str]]) -> dict[str, Column]:
    """One expression per column name for the value in a row of a table.

    Names and values are zipped: names beyond the row's end have no value, and
    of repeated names the last counts. Pages of one table may list its columns
    differently; then each row looks its names up. ``synced_at`` is always the
    snapshot's.
    """
    cells = {}
    for name in dict.fromkeys(name for layout in layouts for name in layout):
        if len(layouts) == 1:
            spots = [i for i, n in enumerate(layouts[0]) if n == name]
            cells[name] = F.coalesce(*[F.get("row", F.lit(i)) for i in reversed(spots)])
        else:
            names = F.slice(F.col("columns"), F.lit(1), F.least(F.size("columns"), F.size("row")))
            at = F.array_position(F.reverse(names), name)
            cells[name] = F.when(at > 0, F.get("row", (F.size(names) - at).cast("int")))
    cells[SYNCED_AT] = F.col("generated_at").cast("variant")
    return cells


def _spark_type(inferred: str) -> str:
    """Type text of a variant schema -> column type; mixed values stay JSON text."""
    if inferred in ("VOID", "VARIANT"):
        return "json"
    for found, wanted in ((r"DECIMAL\(\d+,\d+\)", "DOUBLE"), ("OBJECT<", "STRUCT<"), (r"\bVOID\b", "STRING")):
        inferred = re.sub(found, wanted, inferred)
    return "json" if inferred == "OBJECT" else inferred.lower()


def _typed(name: str, kind: str) -> Column:
    cell = F.col(f"`{name}`")
    if kind == "json":
        value = F.when(F.schema_of_variant(cell) != "VOID", F.to_json(cell))
    elif kind in ("date", "timestamp_ntz", "timestamp"):
        value = F.try_variant_get(cell, "$", "string").cast(kind)
    else:
        value = F.try_variant_get(cell, "$", kind)
    return value.alias(name)


def _form(cell: Column) -> Column:
    """Which of the date and time forms a text has; empty for none, NULL for no text."""
    text = F.try_variant_get(cell, "$", "string")
    form = F.when(text.isNull(), None).when(~text.rlike(_DAY), "")
    for name, (pattern, kind) in _FORMS.items():
        form = form.when(text.rlike(pattern) & text.try_cast(kind).isNotNull(), name)
    return form.otherwise("")


def _infer(cells: DataFrame) -> dict[str, str]:
    """Column types in one pass; columns that no row reaches are left out."""
    named = [F.col(f"`{name}`") for name in cells.columns]
    # Forms are columns first: an aggregation would work them out for min and max apart.
    formed = cells.select(
        *[cell.alias(f"v{i}") for i, cell in enumerate(named)],
        *[_form(cell).alias(f"f{i}") for i, cell in enumerate(named)],
    )
    aggs = []
    for i in range(len(named)):
        aggs += [
            F.count(f"v{i}").alias(f"n{i}"),
            F.schema_of_variant_agg(f"v{i}").alias(f"t{i}"),
            F.min(f"f{i}").alias(f"low{i}"),
            F.max(f"f{i}").alias(f"high{i}"),
        ]
    found = formed.agg(*aggs).first()
    kinds: dict[str, str] = {}
    for i, name in enumerate(cells.columns):
        if found[f"n{i}"] == 0:
            continue
        kind = _spark_type(found[f"t{i}"] or "VOID")
        if kind == "string" and found[f"low{i}"] == found[f"high{i}"]:
            _, kind = _FORMS.get(found[f"low{i}"], (None, kind))
        kinds[name] = kind
    return kinds


def _stored(documents: DataFrame) -> DataFrame:
    """One stored row per table row, and one per table that failed, with its ``message``.

    They are in a folder per table: a large document is spread over tasks, and
    each table reads its own folder only.
    """
    kind = "array<struct<name: string, columns: array<string>, rows: array<array<variant>>, message: string>>"
    none = F.array().cast(kind)
    found = F.transform(
        F.map_entries("tables"),
        lambda e: F.struct(
            e.key.alias("name"), e.value.columns.alias("columns"), e.value.rows.alias("rows"), F.lit(None).cast("string").alias("message")
        ),
    )
    lost = F.transform(
        F.map_entries("failed"),
        lambda e: F.struct(
            e.key.alias("name"),
            F.lit(None).cast("array<string>").alias("columns"),
            F.lit(None).cast("array<array<variant>>").alias("rows"),
            F.coalesce(e.value, F.lit("")).alias("message"),
        ),
    )
    entries = F.concat(F.coalesce(found, none), F.coalesce(lost, none))
    flat = documents.select("generated_at", F.explode(entries).alias("t")).select(
        "generated_at", "t.name", "t.columns", "t.message", F.explode_outer("t.rows").alias("row")
    )
    return stage(flat, "mirror", partition_by=["name"])


def mirror_tables(envelopes: DataFrame) -> Mirror:
    """Rebuild every table of a parsed snapshot with ``synced_at`` and inferred types.

    The driver sees table and column names and one type per column. Tables
    without columns are left out and named in ``empty``; those the sender could
    not read are in ``failed``.
    """
    accepted = require_ok(envelopes).filter(
        check(
            F.col("tables").isNotNull() & F.col("generated_at").isNotNull(),
            "snapshot has no tables or no generated_at",
        )
    )
    return _mirror(_stored(accepted))


def _mirror(stored: DataFrame) -> Mirror:
    failed = {
        r.name: r.message for r in stored.filter("message is not null").select("name", "message").distinct().collect()
    }
    flat = stored.filter("message is null")
    layouts = (
        flat.groupBy("name", "columns").agg(F.count("row").alias("rows")).orderBy("name", "columns").collect()
    )
    columns_of: dict[str, list[list[str]]] = {}
    rows_of: dict[str, int] = {}
    for layout in layouts:
        columns_of.setdefault(layout.name, []).append(layout.columns or [])
        rows_of[layout.name] = rows_of.get(layout.name, 0) + layout.rows

    spark = stored.sparkSession
    tables, empty = {}, []
    for name, given in columns_of.items():
        if not any(given):
            empty.append(name)
        elif not rows_of[name]:
            # Columns but no rows: the inferred schema of an empty list.
            tables[name] = spark.createDataFrame([], "json string")
        else:
            rows = flat.filter((F.col("name") == name) & F.col("row").isNotNull())
            cells = rows.select(*[cell.alias(c) for c, cell in _cells([g for g in given if g]).items()])
            kinds = _infer(cells)
            tables[name] = cells.select(*[_typed(c, kind) for c, kind in kinds.items()])
    return Mirror(tables, empty, failed)


def read_mirror(spark: SparkSession, path: str, one_per_line: bool = False) -> Mirror:
    """``mirror_tables`` of a snapshot's files, which are read once."""
    documents, gate = read_documents(spark, path, TABLES_ENVELOPE, one_per_line, ["tables", "generated_at"])
    stored = _stored(documents)
    gate.pass_or_refuse()
    return _mirror(stored)
