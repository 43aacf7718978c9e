"""Weekly order exports: many CSV files whose headers may differ."""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import EXPORT_FILE_DATE, EXPORT_FILE_PATTERN
from ..staging import stage
from .csv_records import read_lines, read_records, read_splits

# Lines take 18 digits of a row's number and its file's rank 19 more: both are
# 64-bit numbers that no count of lines or files comes near.
_RANK_UNIT = 10**18
#: Room between the ranks of neighbouring files, for files that arrive later.
RANK_STEP = 2**30


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``path, file_path, modified_at, length`` per file, without opening any.

    ``path`` is for reading; ``file_path`` is its URI form, as in ``_metadata``.

    Unlike ``_metadata`` on a CSV read this also shows files that hold only a
    header, or nothing at all, which still cover their week. No scan yields a
    row for a file of no bytes, so the names come from the listing behind the
    scan; such a file has length 0, and no time.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    # The listing writes an empty host as file:///, the metadata as file:/.
    listed = [(re.sub(r"^([\w+.-]+):///", r"\1:/", name),) for name in listing.inputFiles()]
    names = spark.createDataFrame(listed, "file_path string")
    opened = listing.select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("modificationTime").alias("modified_at"),
        "length",
    )
    return names.join(opened, "file_path", "left").select(
        F.coalesce("path", "file_path").alias("path"),
        "file_path",
        "modified_at",
        F.coalesce("length", F.lit(0)).alias("length"),
    )


def ranked(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Add ``rank``, which follows the file names and leaves room between them.

    ``known`` holds ``file_path, rank`` of files that keep their rank; new ones
    share the room between their neighbours. ``rank`` is NULL where there is no
    room left. The windows see one row per file.
    """
    by_name = Window.orderBy("file_path")
    if known is None:
        return files.withColumn("rank", F.row_number().over(by_name) * F.lit(RANK_STEP).cast("long"))
    placed = files.join(known.select("file_path", F.col("rank").alias("_own")), "file_path", "left")
    before = F.last("_own", ignorenulls=True).over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("_own", ignorenulls=True).over(by_name.rowsBetween(0, Window.unboundedFollowing))
    placed = placed.select("*", F.coalesce(before, F.lit(0)).alias("_before"), after.alias("_after"))
    in_gap = Window.partitionBy("_before", "_after")
    nth = F.row_number().over(in_gap.orderBy("file_path"))
    step = F.coalesce(
        F.expr("(_after - _before) div (_new + 1)"),
        F.lit(RANK_STEP),
    )
    placed = placed.withColumn("_new", F.count_if(F.col("_own").isNull()).over(in_gap)).withColumn("_step", step)
    new = placed.filter("_own is null").withColumn("rank", F.when(F.col("_step") > 0, F.col("_before") + nth * F.col("_step")))
    old = placed.filter("_own is not null").withColumn("rank", F.col("_own"))
    return old.unionByName(new).select(*files.columns, "rank")


def file_ranges(files: DataFrame) -> DataFrame:
    """``start_date, end_date`` read from the names of matching files; a bad date stops the job."""

    def date(group: int):
        text = F.regexp_extract("file_path", EXPORT_FILE_PATTERN, group)
        found = F.try_to_timestamp(text, F.lit(EXPORT_FILE_DATE)).cast("date")
        bad = F.raise_error(F.concat(F.lit("no date in the name of "), "file_path")).cast("date")
        return F.when(found.isNotNull(), found).otherwise(bad)

    return files.filter(F.col("file_path").rlike(EXPORT_FILE_PATTERN)).select(
        "file_path", date(1).alias("start_date"), date(2).alias("end_date")
    )


def unique_names(header: list[str]) -> list[str]:
    """Column names as declared; repeats get ``_1``, ``_2``, blanks their position."""
    taken: set[str] = set()
    names = []
    for position, raw in enumerate(header):
        base = raw if raw.strip() else f"column{position}"
        name, n = base, 0
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def _names(header: str) -> list[str]:
    return unique_names(next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), []))


def _literal(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_exports(
    spark: SparkSession,
    folder: str,
    paths: list[str] | None = None,
    first_rank: int = 0,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """All export files as text columns, united by column name.

    Files of every size go through one reader, which splits them over tasks;
    its module states the format. Records are parsed by the header of their
    file; the driver sees the distinct headers only. Adds ``_source_file``,
    ``_loaded_at`` and ``_row_seq``, a number that follows file name and then
    row order. ``paths`` reads these files only, ranked from ``first_rank`` on;
    ``ranks`` gives each ``file_path`` its ``rank`` instead.
    A record with another number of cells than its header stops the job.
    """
    lines = read_lines(spark, folder if paths is None else [_literal(p) for p in paths])
    splits = stage(read_splits(lines), "export-splits")
    in_header = (F.col("split") == 0) & (F.col("starts") == 1)
    unclosed = splits.filter((F.col("left_open") == 1) & (F.col("is_last") | in_header))
    if bad := unclosed.select("file").first():
        raise ValueError(f"a quoted cell is not closed in {bad.file}")
    heads = splits.filter(F.col("header") != "").select("file", "header")
    if ranks is None:
        heads = heads.withColumn("rank", F.row_number().over(Window.orderBy("file")) + F.lit(first_rank - 1))
    else:
        heads = heads.join(ranks.select(F.col("file_path").alias("file"), "rank"), "file")
    headers = heads.groupBy("header").agg(F.min("rank").alias("rank")).orderBy("rank").collect()
    if not headers:
        raise FileNotFoundError(f"no export with a header in {folder}")
    # Names that differ in case only are one column.
    columns: dict[str, tuple[str, list[Column]]] = {}
    parsed = {}
    for n, row in enumerate(headers):
        names = _names(row.header)
        fields = ", ".join(f"c{i} string" for i in range(len(names)))
        cells = F.from_csv("value", fields, {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"})
        parsed[f"_h{n}"] = F.when(F.col("_header") == n, cells)
        for i, name in enumerate(names):
            columns.setdefault(name.lower(), (name, []))[1].append(F.col(f"_h{n}.c{i}"))
    numbers = [F.when(F.col("header") == row.header, n) for n, row in enumerate(headers)]
    # one row per file: broadcast, so that records stay where they are read
    heads = F.broadcast(heads.select("file", "rank", F.coalesce(*numbers).alias("_header")))
    return (
        read_records(lines, splits)
        .join(heads, "file")
        .select("file", "rank", "line", *[cells.alias(name) for name, cells in parsed.items()])
        .select(
            *[F.coalesce(*cells).alias(name) for name, cells in columns.values()],
            F.col("file").alias("_source_file"),
            (F.col("rank").cast("decimal(19,0)") * F.lit(_RANK_UNIT).cast("decimal(19,0)") + F.col("line")).alias("_row_seq"),
            F.current_timestamp().alias("_loaded_at"),
        )
    )
