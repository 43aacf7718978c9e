"""Command line of the build: ``python -m tallyhouse --root … --exports … --menu …``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from .plans.build import Inputs, build
from .plans.refresh import refresh
from .publish import Warehouse
from .session import get_session
from .streaming.incremental import rebuild_if_changed


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, by Spark's own file systems."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> bool:
    """Build the warehouse and print its report; False if nothing had changed."""
    parser = argparse.ArgumentParser(prog="tallyhouse", description="Refresh the warehouse from its input files.")
    parser.add_argument("--root", required=True, help="folder of the published tables")
    parser.add_argument("--exports", required=True, help="folder of the weekly order exports")
    parser.add_argument("--menu", required=True, help="menu CSV file")
    parser.add_argument("--price-sheet", help="price sheet CSV file, if there is one")
    parser.add_argument("--direct-orders", help="direct-order snapshot; its tables stay as they are without")
    parser.add_argument("--loyalty", help="loyalty snapshot; its tables stay as they are without")
    parser.add_argument("--tables", help="snapshot of further tables to mirror")
    parser.add_argument("--one-per-line", action="store_true", help="snapshot files hold one document per line")
    parser.add_argument("--if-changed", action="store_true", help="bring up to date, and only if a CSV file was added, edited or removed")
    given = vars(parser.parse_args(argv))
    root, if_changed = given.pop("root"), given.pop("if_changed")
    inputs = Inputs(**given)
    spark = spark or get_session()

    def run(how: Callable[[SparkSession, str, Inputs], Warehouse]) -> None:
        how(spark, root, inputs).report().show(1000, truncate=False)

    if not if_changed:
        run(build)
        return True
    warehouse = Warehouse(spark, root)
    warehouse.create_layers()
    # a sheet that is not there yet counts as added when it comes
    watched = [p for p in (inputs.exports, inputs.menu, inputs.price_sheet) if p and _exists(spark, p)]
    return rebuild_if_changed(warehouse, watched, lambda: run(refresh))


if __name__ == "__main__":
    main()
