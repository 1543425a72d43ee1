"""A ledger of ingested files: what each of them gave, so that nothing is lost unsaid.

Each file of a folder has one row: path, bytes, modified, batch, footer_rows (null if the footer can't be read), read_rows,
kept_rows, state and reason.  States: ``read``; ``empty`` (a whole file without rows); ``superseded`` (read, but all its
rows gave way to later ones of their keys); ``partial`` (fewer rows than the footer says: the file is damaged behind
them); ``corrupt`` (no footer).  Footers are read by tasks, a few bytes of each file.

A stream takes a file once.  ``retried`` takes partial and corrupt files anew whose length or time has changed since;
their rows come as a later batch, so that they replace the half that was read.  ``reset`` forgets a checkpoint and its
ledger: the next run reads everything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.merging import MergeTable
from pagemill.operators.ranking import last_by
from pagemill.operators.versions import Versions
from pagemill.plans import query, table
from pagemill.scratch import scratch_path
from pagemill.sources.archives import open_file
from pagemill.streaming.ingest import file_stream

LEDGER = "path string, bytes long, modified timestamp, batch long, footer_rows long, read_rows long, kept_rows long, state string, reason string"
#: Numbers of batches that retries make: above those of any stream.
RETRIES = 1 << 40


def _footers(opener: Callable[[str], BinaryIO]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, reasons = [], []
            for path in batch.column("path").to_pylist():
                try:
                    with opener(path) as f:
                        rows.append(pq.read_metadata(f).num_rows)
                    reasons.append(None)
                except (pa.ArrowException, OSError) as e:
                    rows.append(None)
                    reasons.append(str(e).split("\n")[0][:200])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("path", "bytes", "modified")), pa.array(rows, pa.int64()), pa.array(reasons, pa.string())], names=["path", "bytes", "modified", "footer_rows", "why"])

    return run


class Ledger:
    """The files of ``folder`` that are ingested into ``target`` under ``root`` (table, counts, ledger, checkpoint)."""

    def __init__(self, spark: SparkSession, folder: str, root: str, schema: str, key: str, order: str, opener: Callable[[str], BinaryIO] = open_file):
        self.spark, self.folder, self.root, self.schema, self.key, self.order, self.opener = spark, folder, root.rstrip("/"), schema, key, order, opener
        self.table = MergeTable(spark, f"{self.root}/ledger", LEDGER, ["path"], 4)

    def _save(self, batch: DataFrame, number: int) -> None:
        """Counts of all rows that were read, then the last row of each key; both replace themselves when run again."""
        batch.groupBy("file").agg(F.count(F.lit(1)).alias("read_rows")).write.mode("overwrite").parquet(f"{self.root}/counts/batch={number}")
        last_by(batch, [self.key], [self.order]).write.mode("overwrite").parquet(f"{self.root}/table/batch={number}")

    def ingest(self, files_per_batch: int | None = None) -> None:
        """Take new files, then write down what all files gave."""
        stream = file_stream(self.spark, self.folder, self.schema, files_per_batch)
        stream.writeStream.foreachBatch(self._save).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        # A stream doesn't take a file of a known path again; ``retried`` does, if it was damaged.
        self._write_down(self._listed().join(self.table.read().select("path"), "path", "left_anti").select("path", "bytes", "modified"))

    def _listed(self) -> DataFrame:
        """Files of the folder that the ledger doesn't have as they are now."""
        now = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.folder).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        return now.join(self.table.read().select("path", "bytes", "modified"), ["path", "bytes", "modified"], "left_anti")

    def _rows(self, what: str, schema: str) -> DataFrame:
        path, files = Versions(self.spark, self.root, "x int").files(what)
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.root}/{what}") if files.exists(path) else self.spark.createDataFrame([], f"{schema}, batch long")

    def current(self) -> DataFrame:
        """The last version of each key."""
        return last_by(self._rows("table", f"{self.schema}, file string"), [self.key], ["batch"]).drop("batch")

    def _write_down(self, files: DataFrame) -> None:
        name = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
        footers = files.mapInArrow(_footers(self.opener), "path string, bytes long, modified timestamp, footer_rows long, why string").withColumn("file", name(F.col("path")))
        counts = last_by(self._rows("counts", "file string, read_rows long").withColumn("file", name(F.col("file"))), ["file"], ["batch"])
        kept = self.current().groupBy(name(F.col("file")).alias("file")).agg(F.count(F.lit(1)).alias("kept_rows"))
        all_ = footers.join(counts, "file", "left").join(kept, "file", "left").fillna(0, ["read_rows", "kept_rows"])
        footer, read = F.col("footer_rows"), F.col("read_rows")
        state = F.when(footer.isNull(), "corrupt").when(read < footer, "partial").when(footer == 0, "empty").when(F.col("kept_rows") == 0, "superseded").otherwise("read")
        lost = F.concat((footer - read).cast("string"), F.lit(" of "), footer.cast("string"), F.lit(" rows can't be read"))
        all_ = all_.withColumn("state", state).withColumn("reason", F.coalesce("why", F.when(F.col("state") == "partial", lost)))
        self.table.upsert(all_.select("path", "bytes", "modified", "batch", "footer_rows", "read_rows", "kept_rows", "state", "reason"))

    def retried(self) -> int:
        """Take mended files anew; returns how many there were."""
        failed = self.table.read().filter("state IN ('corrupt', 'partial')").select("path", F.col("bytes").alias("_b"), F.col("modified").alias("_m"))
        mended = self._listed().join(failed, "path").filter("bytes <> _b OR modified <> _m").select("path", "bytes", "modified")
        paths = [r.path for r in mended.select("path").collect()]  # files that a run found damaged: few
        if paths:
            number = RETRIES + self.table.versions.latest()
            rows = self.spark.read.schema(self.schema).option("ignoreCorruptFiles", "true").parquet(*paths)
            self._save(rows.withColumn("file", F.col("_metadata.file_path")), number)
            self._write_down(mended)
        return len(paths)

    def refresh(self) -> None:
        """Write down anew what all files gave: a later file may have superseded an earlier one."""
        self._write_down(self.table.read().select("path", "bytes", "modified"))

    def reset(self) -> None:
        """Forget what was taken; the next ``ingest`` reads all files."""
        for what in ("checkpoint", "ledger", "counts", "table"):
            path, files = Versions(self.spark, self.root, "x int").files(what)
            files.delete(path, True)


@query("""WITH c AS (SELECT user_id % 5 AS p, count(*) AS n FROM events GROUP BY 1) SELECT 'part' || p AS part, CASE WHEN p = 0 THEN 'superseded' ELSE 'read' END AS state, n AS footer_rows, n AS read_rows FROM c
  UNION ALL SELECT 'again0', 'read', n, n FROM c WHERE p = 0""")
def file_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Event files: all read, one superseded by a later copy, one found corrupt first and taken again when it was mended."""
    root = scratch_path(spark, "ledger")
    e = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("key"), "user_id", F.lit(1).alias("n"))

    def put(part: int, name: str, n: int = 1) -> None:
        e.filter(F.col("user_id") % 5 == part).withColumn("n", F.lit(n)).coalesce(1).write.parquet(f"{root}/made/{name}")
        _moved(spark, f"{root}/made/{name}", f"{root}/in/{name}.parquet")

    for part in (0, 2, 3, 4):
        put(part, f"part{part}")
    spark.range(1).select(F.lit("no table")).coalesce(1).write.text(f"{root}/made/broken")
    _moved(spark, f"{root}/made/broken", f"{root}/in/part1.parquet")
    ledger = Ledger(spark, f"{root}/in", f"{root}/out", "key string, user_id long, n int", "key", "n")
    ledger.ingest(2)
    put(0, "again0", 2)
    put(1, "part1")
    ledger.ingest()
    ledger.retried()
    ledger.refresh()
    part = F.regexp_extract("path", r"/(\w+)\.parquet$", 1)
    return ledger.table.read().filter("footer_rows > 0").select(part.alias("part"), "state", "footer_rows", "read_rows")


def _moved(spark: SparkSession, folder: str, to: str) -> None:
    """The single file that Spark wrote to ``folder``, under another name of the same store."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(to).getParent())
    files.delete(path(to), False)
    for f in files.globStatus(path(f"{folder}/part-*")):
        files.rename(f.getPath(), path(to))
