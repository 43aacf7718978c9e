"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A batch of changes inserts, deletes or revises documents' counts. Against the
counts that are current, each change becomes signed rows: a new count adds, a
deleted one subtracts, a revised one does both. The batch's rows are summed by
source, language and tokenizer version, and totals are the sum of all batches,
so nothing is counted twice or read again.

A batch is one folder per table, overwritten when it is tried again, and counts
only from the moment its commit is written. A batch that is committed is not
applied again, so a job may repeat any step after a failure.

Cases: a null or empty text has 0 tokens; null sources, languages and ids are
values of their own; repeated rows add up; inserting a document that is there
revises it; deleting one that is not changes nothing; empty tables give empty
totals; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.token_ids import TokenIds, default_path
from tallyhouse.staging import stage, stage_path

GROUP = ["source", "lang", "tokenizer_version"]
DOCUMENT = ["doc_id", *GROUP]


def _sizes(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds.of(path)
        for batch in batches:
            sizes = pa.array([len(ids) for ids in tokens.texts_ids(batch.column(3))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), sizes], ["doc_id", "source", "lang", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, version: str, path: str | None = None) -> DataFrame:
    """``doc_id``, source, language, tokenizer version and the number of tokens."""
    rows = docs.select("doc_id", "source", "lang", "text")
    kinds = dict(rows.dtypes)
    schema = f"doc_id {kinds['doc_id']}, source string, lang string, n_tokens long"
    return rows.mapInArrow(_sizes(path or default_path()), schema).withColumn("tokenizer_version", F.lit(version))


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, table: str, batch: str) -> str:
        return f"{self.root}/{table}/{batch}"

    def batches(self) -> list[str]:
        """Committed batches, in no order; one short name each."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.root}/commits")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        return [s.getPath().getName() for s in files.listStatus(folder) if files.exists(hadoop.Path(s.getPath(), "_SUCCESS"))]

    def _read(self, table: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(self._path(table, batch)) for batch in sorted(self.batches())]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def current(self) -> DataFrame | None:
        """The counts of the documents that are there."""
        rows = self._read("documents")
        if rows is None:
            return None
        return rows.groupBy(*DOCUMENT).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter(F.col("n_docs") != 0)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits ``changes`` (``DOCUMENT``, ``n_tokens``, ``op``: insert, delete or revise) once; says whether it did."""
        if batch in self.batches():
            return False
        new = changes.filter(F.col("op") != "delete").groupBy(*DOCUMENT).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        there = self.current()
        if there is not None:
            touched = changes.select(F.col("doc_id").alias("_id"), F.col("tokenizer_version").alias("_version")).distinct()
            same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("tokenizer_version").eqNullSafe(F.col("_version"))
            old = there.join(touched, same, "left_semi")
            new = new.unionByName(old.withColumns({"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")}))
        signed = new.groupBy(*DOCUMENT).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        signed.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0)).write.mode("overwrite").parquet(self._path("documents", batch))
        written = self.spark.read.parquet(self._path("documents", batch))
        summed = written.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        summed.write.mode("overwrite").parquet(self._path("totals", batch))
        self.spark.range(1).select(F.lit(batch).alias("batch")).coalesce(1).write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def totals(self) -> DataFrame | None:
        """Documents and tokens by source, language and tokenizer version."""
        rows = self._read("totals")
        if rows is None:
            return None
        return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def load(rollup: Rollup, counts: DataFrame) -> None:
    """All of ``counts`` in three batches. The second also revises an eighth of the documents wrongly and deletes another; the third undoes that."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(8))  # rows of one document stay in one batch
    op = lambda rows, name: rows.withColumn("op", F.lit(name))
    revised, deleted, late = counts.filter(part == 0), counts.filter(part == 1), counts.filter(part >= 5)
    wrong = revised.withColumn("n_tokens", F.col("n_tokens") + 1)
    gone = deleted.withColumn("n_tokens", F.lit(None).cast("long"))
    second = op(late, "insert").unionByName(op(wrong, "revise")).unionByName(op(gone, "delete"))
    rollup.apply("first", op(counts.filter(part < 5), "insert"))
    rollup.apply("second", second)
    rollup.apply("second", second)
    rollup.apply("third", op(revised, "revise").unionByName(op(deleted, "insert")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in batches with revisions and deletes, one of them committed again without effect."""
    rollup = Rollup(spark, stage_path(spark, "token-counts"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    load(rollup, stage(count_tokens(docs, "byte_bpe_50k"), "token-counts-documents"))
    return rollup.totals()
