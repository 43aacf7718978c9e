"""Intermediate tables in the shared folder.

A staged table cuts lineage, survives the loss of executors, and gives
Catalyst real sizes, so that joins against it broadcast only when it is
measured to be below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: How tables are compressed: they are written once and read a few times.
CODEC = "zstd"

_local_root: str | None = None
_open_blocks: list[list[str]] = []


def stage_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tallyhouse-")
        root = _local_root
    return f"{root.rstrip('/')}/tallyhouse/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _open_blocks:
        paths.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder by Spark's own file systems; one that is not there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged_until_end(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is staged inside, for blocks that publish all that they make."""
    paths: list[str] = []
    _open_blocks.append(paths)
    try:
        yield
    finally:
        _open_blocks.remove(paths)
        for path in paths:
            remove_folder(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each job inside when it ends.

    Otherwise they stay until the driver happens to collect garbage, those of a
    whole build beside each other.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    with shuffles_removed(spark):
        df.write.option("compression", CODEC).parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)
