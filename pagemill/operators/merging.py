"""A keyed table with upserts, deletes and versions, in files that are never changed.

Rows lie in buckets by a hash of their key.  A write adds a delta: new values and tombstones, numbered by the version
that it makes.  A read takes base files as they are where no delta touches their bucket (no shuffle, columns and filters
pushed down), and settles the other buckets by key: the greatest number counts, a tombstone leaves nothing.  Compaction
writes the touched buckets anew as base files and leaves all others alone.  Every version stays readable until
``sweep``; its manifest says which buckets of a base part are live in it, and which deltas.

A write may carry a token (a stream's batch number): a second write with it changes nothing, also after compaction.
There is one writer at a time.

Defined cases: a key with several rows in one write is settled by ``order`` or else refused; null keys are keys; an
empty write makes a version without a delta; deleting what isn't there changes nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagemill.operators.patching import settled
from pagemill.operators.ranking import last_by
from pagemill.operators.versions import Versions

BUCKETS = 16
BASE, DELTA, TOKEN = "base", "delta", "token"
_OWN = ("_deleted", "_seq", "_bucket")


class MergeTable:
    """A table of ``schema`` (a DDL string; no column may be called _deleted, _seq or _bucket) under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.schema = StructType.fromDDL(schema)
        if set(self.schema.names) & set(_OWN):
            raise ValueError(f"reserved names: {_OWN}")
        self.stored = StructType.fromDDL(schema + ", _deleted boolean, _seq long, _bucket int")
        self.versions = Versions(spark, root, "kind string, part string, seq long, live array<int>")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _store(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Write a part; its name, and the buckets that it has rows of."""
        part = self.versions.fresh()
        # Spark deals the rows by bucket, and a large bucket to several tasks by its size: written once, without a count.
        dealt = rows.withColumn("_bucket", self._bucket()).hint("rebalance", "_bucket")
        dealt.sortWithinPartitions("_bucket", *self.keys).write.partitionBy("_bucket").parquet(self._path(part))
        path, files = self.versions.files(f"parts/{part}")
        names = [f.getPath().getName() for f in files.listStatus(path)]  # a folder for each bucket at most
        return part, sorted(int(n.removeprefix("_bucket=")) for n in names if n.startswith("_bucket="))

    def _path(self, part: str) -> str:
        return f"{self.root}/parts/{part}"

    def _write(self, rows: DataFrame, token: str | None) -> int:
        now, seq = self.versions.parts(), self.versions.latest() + 1
        if token is not None and any(r.kind == TOKEN and r.part == token for r in now):
            return seq - 1
        part, live = self._store(rows.withColumn("_seq", F.lit(seq).cast("long")).select(*self.schema.names, "_deleted", "_seq"))
        kept = [tuple(r) for r in now] + ([(DELTA, part, seq, live)] if live else []) + ([(TOKEN, token, seq, [])] if token is not None else [])
        return self.versions.publish(kept)

    def upsert(self, rows: DataFrame, order: Sequence[str] = (), token: str | None = None) -> int:
        """Put ``rows`` in the place of those with their keys; returns the version that has them."""
        rest = [c for c in self.schema.names if c not in self.keys]
        return self._write(settled(rows, self.keys, rest, order).withColumn("_deleted", F.lit(False)), token)

    def delete(self, rows: DataFrame, token: str | None = None) -> int:
        """Take away the rows with the keys in ``rows``."""
        gone = rows.select(*self.keys).distinct()
        nothing = {c: F.lit(None).cast(self.schema[c].dataType) for c in self.schema.names if c not in self.keys}
        return self._write(gone.withColumns(nothing | {"_deleted": F.lit(True)}), token)

    def _scans(self, parts: list, wanted: set[int]) -> list[DataFrame]:
        """The rows of each part whose buckets are ``wanted``; only their folders are read."""
        some = [(r.part, sorted(b for b in r.live if b in wanted)) for r in parts]
        return [self.spark.read.schema(self.stored).parquet(self._path(part)).filter(F.col("_bucket").isin(live)) for part, live in some if live]

    def _settled(self, now: list, touched: set[int]) -> DataFrame:
        """The last row of each key in the touched buckets, tombstones among them."""
        rows = reduce(DataFrame.unionByName, self._scans([r for r in now if r.kind != TOKEN], touched))
        return last_by(rows, self.keys, ["_seq", "_deleted"])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the latest)."""
        now = self.versions.parts(version)
        touched = {b for r in now if r.kind == DELTA for b in r.live}
        rows = self._scans([r for r in now if r.kind == BASE], set(range(self.buckets)) - touched) + ([self._settled(now, touched)] if touched else [])
        rows = reduce(DataFrame.unionByName, rows) if rows else self.spark.createDataFrame([], self.stored)
        return rows.filter("NOT _deleted").select(*self.schema.names)

    def compact(self) -> int:
        """Write touched buckets as base files, without tombstones; all others keep their files."""
        now = self.versions.parts()
        touched = {b for r in now if r.kind == DELTA for b in r.live}
        if not touched:
            return self.versions.latest()
        part, live = self._store(self._settled(now, touched).filter("NOT _deleted").select(*self.schema.names, "_deleted", "_seq"))
        kept = [(r.kind, r.part, r.seq, [b for b in r.live if b not in touched]) for r in now if r.kind == BASE]
        tokens = [tuple(r) for r in now if r.kind == TOKEN]
        return self.versions.publish([r for r in kept if r[3]] + ([(BASE, part, self.versions.latest() + 1, live)] if live else []) + tokens)

    def sweep(self, keep_from: int) -> list[str]:
        """Take away the files that no version from ``keep_from`` on names, and older versions; returns the parts that went."""
        last = self.versions.latest()
        kept = {r.part for v in range(keep_from, last + 1) for r in self.versions.parts(v)}
        old = {r.part for v in range(1, keep_from) for r in self.versions.parts(v) if r.kind != TOKEN}
        for gone in [*(f"parts/{part}" for part in sorted(old - kept)), *(f"manifest/v={v}" for v in range(1, keep_from))]:
            path, files = self.versions.files(gone)
            files.delete(path, True)
        return sorted(old - kept)
