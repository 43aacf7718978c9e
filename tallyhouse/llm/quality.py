"""Quality rules as a ledger of bit masks.

Every rule is evaluated once per document; the ledger keeps its measurements
and one failure bit per rule. A policy is a version and the set of rules that
reject; applying one, or asking what a rule alone rejects, only reads bits.

Everything is arithmetic within the document's row: no shuffle and no Python.
Windows of three words are compared by 64-bit hashes within one document.

Cases: a null text has no words and fails ``few_words``; an empty table gives
an empty ledger; repeated rows and equal ids each keep their row. Columns of
the ledger replace columns of the same name in the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Place in the list is the rule's bit: never reorder, only append.
RULES = ["few_words", "repeated_words", "symbols", "repeated_lines", "word_length"]


@dataclass(frozen=True)
class Policy:
    """The rules that reject under one version of the policy."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy("v1", tuple(RULES))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _from(array: Column, start: int) -> Column:
    return F.slice(array, start, F.greatest(F.size(array) - (start - 1), F.lit(0)))


def _window_hashes(hashes: Column) -> Column:
    pairs = F.zip_with(hashes, _from(hashes, 2), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, _from(hashes, 3), lambda ab, c: F.xxhash64(ab, c))
    return F.slice(windows, 1, F.greatest(F.size(hashes) - 2, F.lit(0)))


def _repeats(windows: Column) -> Column:
    """Whether any window occurs twice."""
    return F.size(F.array_distinct(windows)) < F.size(windows)


PLACED = "array<struct<w:bigint,i:int>>"


def _placed(windows: Column) -> Column:
    """Windows with their places, equal ones together; nothing where no window occurs twice."""
    both = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))).cast(PLACED)
    return F.when(_repeats(windows), F.sort_array(both)).otherwise(F.array().cast(PLACED))


def _repeat_places(placed: Column) -> Column:
    """Places, in order, of windows that occur twice or more."""
    nothing = F.array(F.lit(None).cast("struct<w:bigint,i:int>"))
    ahead = F.zip_with(placed, F.concat(nothing, placed), lambda x, y: F.struct(x.alias("x"), (x["w"] == y["w"]).alias("before")))
    both = F.zip_with(
        ahead, _from(placed, 2),
        lambda p, z: F.when(F.coalesce(p["before"], F.lit(False)) | F.coalesce(p["x"]["w"] == z["w"], F.lit(False)), p["x"]["i"]),
    )
    return F.sort_array(F.filter(both, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words that lie in a window of three at one of the places."""
    steps = F.zip_with(places, _from(places, 2), lambda i, j: F.coalesce(F.least(j - i, F.lit(3)), F.lit(3)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)


def _computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that no later filter or projection computes again: it comes out of a generator."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``c0``, ``c1`` and so on, which clash with none made here."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def _own(docs: DataFrame, but: list[str] | None = None) -> list[Column]:
    """The numbered columns under their own names, without those of ``but``."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in (but or [])]


def _measure(docs: DataFrame) -> DataFrame:
    """The numbered columns of ``docs``, and the measurements."""
    text = F.coalesce(F.col(f"c{docs.columns.index('text')}"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    parts = _computed_once(_numbered(docs), "parts", F.struct(words.alias("words"), lines.alias("lines")))
    words, lines = F.col("parts.words"), F.col("parts.lines")
    hashed = _computed_once(parts, "hashes", F.transform(words, lambda w: F.xxhash64(w)))
    windows = _computed_once(hashed, "windows", _window_hashes(F.col("hashes")))
    placed = _computed_once(windows, "placed", _placed(F.col("windows")))
    places = _computed_once(placed, "places", _repeat_places(F.col("placed")))
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, SPACE, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col("places")),
    }
    measured = _computed_once(places, "measured", F.struct(*[c.cast("long").alias(n) for n, c in found.items()]))
    return measured.withColumns({n: F.col(f"measured.{n}") for n in found}).drop("parts", "hashes", "windows", "placed", "places", "measured")


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements of every rule; columns of these names are replaced."""
    rows = _measure(docs)
    names = rows.columns[len(docs.columns) :]
    return rows.select(*_own(docs, names), *names)


def _ledger(docs: DataFrame) -> DataFrame:
    """The numbered columns of ``docs``, measurements and ``fail_bits``."""
    n_words = F.col("n_words")
    failed = {
        "few_words": n_words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n_words,
        "symbols": 5 * F.col("n_symbols") > n_words,
        "repeated_lines": (F.col("n_lines") >= 4) & (2 * F.col("n_dup_lines") > F.col("n_lines")),
        "word_length": (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 20 * n_words),
    }
    bits = [F.when(failed[rule], 1 << place).otherwise(0) for place, rule in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return _measure(docs).withColumn("fail_bits", total.cast("long"))


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with measurements and ``fail_bits``, one bit per rule of ``RULES``; columns of these names are replaced."""
    rows = _ledger(docs)
    names = rows.columns[len(docs.columns) :]
    return rows.select(*_own(docs, names), *names)


def rejects(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def keep(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The documents that no rule of the policy rejects, with their own columns only."""
    return _ledger(docs).filter(~rejects(policy)).select(*_own(docs))


def ablation(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Per rule of the policy: documents it fails, those it alone rejects, and those kept without it."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    sets = rows.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** len(RULES) rows
    per = sets.withColumn("rule", F.explode(F.array(*[F.lit(rule) for rule in policy.rules])))
    bit = F.element_at(F.create_map(*[F.lit(x) for rule in policy.rules for x in (rule, 1 << RULES.index(rule))]), F.col("rule"))
    return (
        per.withColumn("bit", bit)
        .groupBy(F.lit(policy.version).alias("version"), "rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_alone"),
            F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", *MEASURES, rejects(BASE).alias("base_failed"), (~rejects(STANDARD)).alias("kept"), "fail_bits")


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
w AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) > 2),
t AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM w),
g AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM t WHERE n > 1),
c AS (SELECT r, sum(least(coalesce(j - i, 3), 3)) AS n FROM g GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN c USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & 3 <> 0 AS base_failed, bits = 0 AS kept,
  CAST(bits AS BIGINT) AS fail_bits FROM b"""
