"""The menu and the price sheet: reference files the owner keeps by hand."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import to_double
from ..functions.text import strip
from ..schemas import MENU_COLUMNS, SHEET_NUMBERS


def read_menu(spark: SparkSession, path: str) -> DataFrame:
    """Menu items by position of the declared columns, and ``_row_seq``; a bad value stops the job."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name, _ in MENU_COLUMNS])
    rows = spark.read.schema(schema).csv(
        path, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST"
    )
    typed = [_strict(name, kind).alias(name) for name, kind in MENU_COLUMNS]
    return rows.select(*typed, F.monotonically_increasing_id().alias("_row_seq"))


def _strict(name: str, kind: str) -> Column:
    """A cast that stops the job at what is not a value, whatever the session's settings."""
    text = F.col(name)
    if kind == "string":
        return text
    value = to_double(text) if kind == "double" else text.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"menu: {name} cannot be "), text))
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(bad.cast(kind))


def sheet_from_text(rows: DataFrame, seq: str) -> DataFrame:
    """Type the text rows of a price sheet: one row per name, numbers or NULL.

    Blank and unreadable cells are absent, not zero. Rows without a name are
    skipped. Of rows with the same name the last one counts, at the place of
    the first: ``sheet_seq`` keeps that place.
    """
    def text(name: str) -> Column:
        return strip(F.col(name)) if name in rows.columns else F.lit(None).cast("string")

    typed = rows.select(
        text("item_name").alias("item_name"),
        *[to_double(text(n)).alias(n) for n in SHEET_NUMBERS],
        F.col(seq).alias("_seq"),
    ).filter("item_name <> ''")
    return (
        typed.groupBy("item_name")
        .agg(
            F.max_by(F.struct(*SHEET_NUMBERS), "_seq").alias("_last"),
            F.min("_seq").alias("sheet_seq"),
        )
        .select("item_name", "_last.*", "sheet_seq")
    )


def read_price_sheet(spark: SparkSession, path: str | None) -> DataFrame:
    """The price sheet, or an empty one of the same columns when there is no file."""
    empty = "item_name string, " + ", ".join(f"{n} double" for n in SHEET_NUMBERS) + ", sheet_seq bigint"
    if path is None:
        return spark.createDataFrame([], empty)
    try:
        rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], empty)
    return sheet_from_text(rows.withColumn("_seq", F.monotonically_increasing_id()), "_seq")
