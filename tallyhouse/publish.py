"""Published tables: layers, full refresh without a gap, versions, views, build report."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import CODEC, remove_folder, shuffles_removed

# The layers.
LAYERS = ["bronze", "silver", "gold", "d1"]
#: Which folder each table of the last complete build is in.
VERSIONS = "bronze.table_versions"
#: The folder of rows whose partition value is NULL.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _kinds(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


@dataclass
class _Written:
    """A table that is written, and may not have its name yet."""

    path: str
    schema: T.StructType
    partition_by: str | None


class Snapshot:
    """The tables of one build, whatever is published meanwhile."""

    def __init__(self, spark: SparkSession, tables: dict[str, _Written]):
        self.spark, self.tables = spark, tables

    def table(self, name: str) -> DataFrame:
        found = self.tables[name]
        return self.spark.read.schema(found.schema).parquet(found.path)


@dataclass
class Warehouse:
    """Tables below ``root``, registered in the session catalog."""

    spark: SparkSession
    root: str
    counts: list[tuple[str, int, str]] = field(default_factory=list)
    #: What was measured while a table was written, by table.
    measured: dict[str, dict[str, int]] = field(default_factory=dict)
    #: Partition columns by which ``replace_partitions`` gets rows gathered, as those of a file are where it is read.
    gathered: tuple[str, ...] = ("_file_id",)
    _waiting: dict[str, _Written] | None = None
    _last_steps: list[Callable[[], object]] = field(default_factory=list)

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")

    def exists(self, name: str) -> bool:
        """Whether this warehouse has the table; one that another root left in the catalog is not its own."""
        if name in (self._waiting or {}):
            return True
        location = self._location(name)
        if location is None:
            return False
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        qualified = [p.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(p).toString() for p in (path(location), path(self._folder(name)))]
        return qualified[0].startswith(f"{qualified[1]}/")

    def table(self, name: str) -> DataFrame:
        """The table; inside ``together`` as it will be."""
        if name in (self._waiting or {}):
            return Snapshot(self.spark, self._waiting).table(name)
        return self.spark.table(name)

    @contextmanager
    def together(self) -> Iterator[None]:
        """Publish what is written inside when all of it is written, or nothing.

        The last step is one table, ``VERSIONS``, which lists the folder of each
        table; ``snapshot`` reads it, so its readers see all of a build or
        nothing of it. The names in the catalog follow one after another.
        Shuffle files go with the job that made them.
        """
        self._waiting, self._last_steps = {}, []
        try:
            with shuffles_removed(self.spark):
                yield
        except BaseException:
            for written in self._waiting.values():
                remove_folder(self.spark, written.path)
            raise
        else:
            waiting, steps = self._waiting, self._last_steps
            self._waiting = None
            self._move(waiting)
            for step in steps:
                step()
        finally:
            self._waiting = None

    def snapshot(self) -> Snapshot:
        """The tables of the last complete build. They stay readable until the build after the next."""
        return Snapshot(self.spark, self._versions())

    def _versions(self) -> dict[str, _Written]:
        if not self.spark.catalog.tableExists(VERSIONS):
            return {}
        rows = self.spark.table(VERSIONS).collect()
        return {r.table: _Written(r.path, T.StructType.fromJson(json.loads(r.schema)), r.partition_by) for r in rows}

    def publish(
        self,
        name: str,
        df: DataFrame,
        note: str = "",
        partition_by: str | None = None,
        measure: dict[str, Column] | None = None,
        listed: bool = True,
        gathered: bool = False,
    ) -> DataFrame:
        """Replace a table in full.

        The rows go to a new folder first and the name moves to it only when
        the write has succeeded; a job that fails leaves the old table alone.
        The name is there all the time, unless the columns have changed: then
        the table is dropped and made anew.
        Rows are counted during the write, and so are the aggregates in
        ``measure``. Readers of the old table keep its files until the next
        refresh: the version in use and the one before it stay, older ones are
        removed.

        ``partition_by`` names a column that becomes the last one and gets a
        folder per value; values with many rows are written by several tasks.
        Rows that are ``gathered`` come by that value already, as those of a file
        do where it is read, and are written without a shuffle.
        A table that is not ``listed`` is left out of the report.
        """
        path = f"{self._folder(name)}/{uuid.uuid4().hex}"
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (measure or {}).items()])
        if partition_by:
            df = df.select(*[c for c in df.columns if c != partition_by], partition_by)
            rows = rows if gathered else rows.hint("rebalance", F.col(partition_by))
        rows.write.option("compression", CODEC).parquet(path, partitionBy=partition_by)
        self.measured[name] = dict(seen.get)
        if listed:
            self.note(name, self.measured[name]["rows"], note)
        written = _Written(path, df.schema, partition_by)
        if self._waiting is None:
            self._move({name: written}, alone=True)
        else:
            self._waiting[name] = written
        return self.table(name)

    def _move(self, tables: dict[str, _Written], alone: bool = False) -> None:
        versions = self._versions()
        if not alone or tables.keys() & versions.keys():
            self._write_versions(versions | tables)
        for name, written in tables.items():
            self._name(name, written)

    def _write_versions(self, versions: dict[str, _Written]) -> None:
        rows = [(name, w.path, w.schema.json(), w.partition_by) for name, w in versions.items()]
        listed = self.spark.createDataFrame(rows, "table string, path string, schema string, partition_by string").coalesce(1)
        path = f"{self._folder(VERSIONS)}/{uuid.uuid4().hex}"
        listed.write.parquet(path)
        self._name(VERSIONS, _Written(path, listed.schema, None))

    def _name(self, name: str, written: _Written) -> None:
        """Let a name stand for a folder."""
        before = self._location(name)
        kinds = [(f.name, f.dataType.simpleString()) for f in written.schema.fields]
        if self.spark.catalog.tableExists(name) and _kinds(self.spark.table(name)) == kinds:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{written.path}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._create(name, written)
        self._remove_versions(name, {written.path, before})

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _create(self, name: str, written: _Written) -> None:
        if not written.partition_by:
            self.spark.catalog.createTable(name, written.path, "parquet", written.schema)
            return
        # the folders alone say which partitions there are, so that they move along with the name
        managed = "spark.sql.hive.manageFilesourcePartitions"
        kept = self.spark.conf.get(managed)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema.fields)
        self.spark.conf.set(managed, "false")
        try:
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{written.partition_by}`) LOCATION '{written.path}'"
            )
        finally:
            self.spark.conf.set(managed, kept)

    def replace_partitions(
        self, name: str, df: DataFrame, partition_by: str, gone: Iterable[object] = (), measure: dict[str, Column] | None = None
    ) -> dict[str, int]:
        """Replace the partitions that ``df`` has rows of, in place, and remove those that are ``gone``.

        Returns the aggregates in ``measure``, taken during the write.

        All other partitions keep their files. ``df`` may have columns that the
        table does not have yet; it must not read the table itself. Partitions
        are replaced one after another: a reader may meet some of them old and
        some new. Rows of a column in ``gathered`` are written without a shuffle.
        """
        known = {c.lower() for c in self.spark.table(name).columns}
        if new := [(c, kind) for c, kind in _kinds(df) if c.lower() not in known]:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {kind}' for c, kind in new)})")
        path = self._location(name)
        seen = Observation()
        rows = df.observe(seen, *[c.alias(n) for n, c in measure.items()]) if measure else df
        rows = rows if partition_by in self.gathered else rows.hint("rebalance", F.col(partition_by))
        options = {"partitionOverwriteMode": "dynamic", "compression": CODEC}
        rows.write.mode("overwrite").options(**options).parquet(path, partitionBy=partition_by)
        for value in gone:
            remove_folder(self.spark, f"{path}/{partition_by}={_NULL_FOLDER if value is None else value}")
        self.spark.catalog.refreshTable(name)
        if new and name in (versions := self._versions()):
            self._write_versions(versions | {name: _Written(path, self.spark.table(name).schema, partition_by)})
        return dict(seen.get) if measure else {}

    def _location(self, name: str) -> str | None:
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        return next((r.data_type for r in rows if r.col_name == "Location"), None)

    def _remove_versions(self, name: str, kept: set[str | None]) -> None:
        """Remove versions of a table below its folder, but for those to keep."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self._folder(name))
        stay = {path.rsplit("/", 1)[1] for path in kept if path}
        for found in folder.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(folder):
            version = found.getPath().getName()
            if re.fullmatch("[0-9a-f]{32}", version) and version not in stay:
                remove_folder(self.spark, found.getPath().toString())

    def drop(self, name: str, note: str) -> None:
        def step() -> None:
            versions = self._versions()
            if versions.pop(name, None):
                self._write_versions(versions)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

        self.at_end(step)
        self.note(name, 0, note)

    def view(self, name: str, sql: str) -> None:
        """Register a query that is evaluated when it is read."""
        self.at_end(lambda: self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}"))

    def at_end(self, step: Callable[[], object]) -> None:
        """Do something after the tables of ``together`` are published, or at once."""
        if self._waiting is None:
            step()
        else:
            self._last_steps.append(step)

    def note(self, name: str, rows: int, note: str = "") -> None:
        self.counts.append((name, rows, note))

    def report(self) -> DataFrame:
        """``table, rows, note`` for everything published by this object."""
        return self.spark.createDataFrame(self.counts, "table string, rows bigint, note string")
