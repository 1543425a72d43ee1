"""Tables whose files never change, and a manifest that names those which count.

A version of the manifest is a folder of its own, ``manifest/v=<n>``, with a row for each live part.  Parts are written
first, under names that no one reads yet; the version that names them comes last.  A job that fails between leaves files
that no version names.  Older versions stay readable until ``sweep``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast if they are narrow; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark for broadcast if ``df`` (cheap to evaluate, narrow rows) is checked to be small; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


class Versions:
    """The versions of a table under ``root``; ``schema``: what a manifest tells of each part."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def latest(self) -> int:
        """The number of the last whole version; 0 before the first."""
        path, files = self.files("manifest")
        if not files.exists(path):
            return 0
        names = [f.getPath() for f in files.listStatus(path)]
        whole = [int(n.getName().removeprefix("v=")) for n in names if n.getName().startswith("v=") and files.exists(n.suffix("/_SUCCESS"))]
        return max(whole, default=0)

    def files(self, name: str):
        """A path below the root, and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def parts(self, version: int | None = None) -> list:
        """The rows of a version (the latest): one for each part, so as many as there were writes since the last merge."""
        version = self.latest() if version is None else version
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/manifest/v={version}").collect() if version else []

    def publish(self, rows: list) -> int:
        """Make ``rows`` the next version."""
        version = self.latest() + 1
        # What a failed write left under this number is not a version.
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")
        return version

    def fresh(self) -> str:
        """A name for a part that is not written yet."""
        return uuid.uuid4().hex[:16]

    def read(self, names: list[str], what: Callable[[str], str], schema: str) -> DataFrame:
        """The tables of the parts ``names`` as one; empty with ``schema`` if there are none."""
        each = [self.spark.read.schema(schema).parquet(what(n)) for n in names]
        return reduce(DataFrame.unionByName, each) if each else self.spark.createDataFrame([], schema)
