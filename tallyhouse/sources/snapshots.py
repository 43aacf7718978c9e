"""JSON snapshots: direct orders and the loyalty ledger.

A snapshot is one document or a folder of them, each with an ``ok`` flag. Every
document is parsed by its own task, and once: the write that stores its elements
also counts what it is refused for, and nothing is published before that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIRECT_REQUIRED
from ..staging import stage

# The sections of a snapshot; orders must be there.
ORDERS_SECTIONS = ["orders"]
LOYALTY_SECTIONS = ["ledger", "balances", "referrals"]
REQUIRED_SECTIONS = ["orders"]


def envelope(sections: list[str]) -> str:
    return ", ".join(["ok variant", "generated_at string", *[f"{name} array<variant>" for name in sections]])


LOYALTY_ENVELOPE = envelope(LOYALTY_SECTIONS)

# JSON texts that do not count as "ok".
_FALSY = ["false", "null", "0", "0.0", '""', "[]", "{}"]


def check(condition: Column, message: str | Column) -> Column:
    """A filter that is true or stops the job."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))


def says_ok() -> Column:
    return F.coalesce(~F.to_json("ok").isin(_FALSY), F.lit(False))


def require_ok(envelopes: DataFrame) -> DataFrame:
    """Pass documents on only if each says ``ok``; stop before anything is written."""
    return envelopes.filter(check(says_ok(), "snapshot refused: it does not say ok"))


@dataclass
class Gate:
    """What the pass over a snapshot finds wrong with it."""

    seen: Observation
    path: str
    unit: str
    needed: list[str]

    def pass_or_refuse(self) -> None:
        found = self.seen.get
        if not found["documents"]:
            raise ValueError(f"snapshot refused: nothing in {self.path}")
        if found["per_line"]:
            raise ValueError(f"snapshot refused: {self.path} has a document per line, read it with one_per_line")
        if found["broken"]:
            raise ValueError(
                f"snapshot refused: a {self.unit} of {self.path} does not hold exactly one document; deliver one per {self.unit}"
            )
        if found["not_ok"]:
            raise ValueError("snapshot refused: it does not say ok")
        if found["incomplete"]:
            raise ValueError(f"snapshot refused: a document of {self.path} has no {' or no '.join(self.needed)}")


def read_documents(spark: SparkSession, path: str, schema: str, one_per_line: bool, needed: list[str]) -> tuple[DataFrame, Gate]:
    """Documents of a snapshot, one per file or one per line, and the gate to pass once they are stored.

    A text is parsed as a list with it as the only element, so that what follows
    a first document is not passed over: then the list has another length, or is
    no JSON. ``needed`` are fields that must not be missing.
    """
    texts = spark.read.text(path, wholetext=not one_per_line).filter(F.trim(F.regexp_replace("value", r"\s", " ")) != "")
    listed = F.concat(F.lit("["), "value", F.lit("]"))
    parsed = F.from_json(listed, f"array<struct<{schema}>>", {"allowSingleQuotes": "false"})
    lines = F.filter(F.split("value", "\n"), lambda line: F.trim(line) != "")
    objects = F.forall(lines, lambda line: F.trim(line).startswith("{"))
    given = texts.select(parsed.alias("parsed"), F.when(parsed.isNull(), (F.size(lines) > 1) & objects).alias("per_line"))
    one = F.coalesce((F.size("parsed") == 1) & F.get("parsed", F.lit(0)).isNotNull(), F.lit(False))
    documents = given.select(one.alias("one"), "per_line", F.when(one, F.get("parsed", F.lit(0))).alias("d")).select("one", "per_line", "d.*")
    lacks = F.lit(False)
    for name in needed:
        lacks = lacks | F.col(name).isNull()
    seen = Observation()
    observed = documents.observe(
        seen,
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.coalesce("per_line", F.lit(False))).alias("per_line"),
        F.count_if(~F.col("one")).alias("broken"),
        F.count_if(F.col("one") & ~says_ok()).alias("not_ok"),
        F.count_if(F.col("one") & lacks).alias("incomplete"),
    )
    return observed.filter("one").drop("one", "per_line"), Gate(seen, path, "line" if one_per_line else "file", needed)


def read_sections(spark: SparkSession, path: str, sections: list[str], one_per_line: bool = False) -> dict[str, DataFrame]:
    """Per section its elements: ``generated_at`` of the document, and ``element``.

    One pass stores them in a folder per section; a section that no document
    has gives no rows, unless it must be there.
    """
    needed = [name for name in sections if name in REQUIRED_SECTIONS]
    documents, gate = read_documents(spark, path, envelope(sections), one_per_line, needed)
    none = F.array().cast("array<struct<section: string, element: variant>>")

    def elements(name: str) -> Column:
        named = F.transform(F.col(name), lambda e: F.struct(F.lit(name).alias("section"), e.alias("element")))
        return F.coalesce(named, none)

    every = documents.select("generated_at", F.explode(F.concat(*map(elements, sections))).alias("e"))
    stored = stage(every.select("generated_at", "e.element", "e.section"), "snapshot", partition_by=["section"])
    gate.pass_or_refuse()
    return {name: stored.filter(F.col("section") == name).drop("section") for name in sections}


def direct_orders_raw(elements: DataFrame) -> DataFrame:
    """One row per order of a snapshot's section, its items kept as JSON text.

    Required fields must be present (NULL is allowed); others may be missing.
    """
    orders = elements.select("generated_at", F.col("element").alias("o"))

    def value(field: str, kind: str = "string") -> Column:
        return F.try_variant_get("o", f"$.{field}", kind)

    missing = F.concat_ws(
        ", ", *[F.when(value(f, "variant").isNull(), F.lit(f)) for f in DIRECT_REQUIRED]
    )

    def text(field: str) -> Column:
        return value(field).alias(field)

    def whole(field: str) -> Column:
        return F.round(value(field).cast("double")).cast("int").alias(field)

    return orders.filter(check(missing == "", F.concat(F.lit("order without "), missing))).select(
        whole("order_id"),
        *[text(f) for f in ("status", "order_type", "slot_at", "distance_band", "locality")],
        *[whole(f) for f in ("food_total", "delivery_fee", "total")],
        *[text(f) for f in ("created_at", "confirmed_at", "customer_phone", "customer_name")],
        F.to_json(value("items", "variant")).alias("items_json"),
        F.col("generated_at").alias("_generated_at"),
        F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_elements(elements: DataFrame) -> DataFrame:
    """One JSON text per element.

    Kept as text so that a field the source adds is never lost on the way in.
    """
    return elements.select(F.to_json("element").alias("raw"))


def raw_section(envelopes: DataFrame, section: str) -> DataFrame:
    """The same of documents that are parsed already; a missing section gives no rows."""
    return raw_elements(envelopes.select(F.explode(section).alias("element")))
