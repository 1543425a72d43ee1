"""Page archives as a data source of Spark, for batches and streams, with broken archives set apart.

``spark.read.format("page_archives").load(folder)`` and ``spark.readStream`` give a row for each OCR file: archive,
member, content, problem.  Each archive is a partition of its own, read as a stream.  An archive that can't be read to
its end gives a last row with what went wrong (``problem``), and the job goes on; ``whole`` leaves out such archives'
members altogether, ``quarantined`` names them.

A stream's offset is the time and name of the last archive taken, so it stays small however many there are; archives
must appear whole (written elsewhere and renamed), later ones with a later time of change or a greater name.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pagemill.operators.merging import MergeTable
from pagemill.operators.versions import small
from pagemill.sources import archives

NAME, SCHEMA = "page_archives", "archive string, member string, content string, problem string"
_ARROW = pa.schema([(c, pa.string()) for c in ("archive", "member", "content", "problem")])


@dataclass
class Archive(InputPartition):
    path: str


def _listed(folder: str) -> list[tuple[int, str]]:
    """Time of change and path of all archives, in this order (names and times only; one listing of the folder)."""
    system, name = archives.store_of(folder)
    found = system.get_file_info(fs.FileSelector(name, recursive=True, allow_not_found=True))
    scheme = folder.split("://")[0] + "://" if "://" in folder else "file://"
    return sorted((f.mtime_ns or 0, scheme + f.path) for f in found if f.type == fs.FileType.File and f.path.endswith(".tar.bz2"))


def _batches(path: str) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=_ARROW)

    try:
        with archives.open_uri(path) as stream:
            for name, content in archives.members(stream):
                held.append((path, name, content, None))
                size += len(content)
                if size >= archives.HELD:
                    yield out()
                    held, size = [], 0
    except (OSError, EOFError, ValueError, tarfile.TarError, pa.ArrowException) as e:
        held.append((path, None, None, f"{type(e).__name__}: {e}"[:300]))
    if held:
        yield out()


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Archive]:
        return [Archive(p) for _, p in _listed(self.folder)]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # what Spark gives for a folder without archives
            yield from _batches(partition.path)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        found = _listed(self.folder)
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Archive]:
        after, upto = ((o["time"], o["path"]) for o in (start, end))
        return [Archive(p) for t, p in _listed(self.folder) if after < (t, p) <= upto]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # what Spark gives for a folder without archives
            yield from _batches(partition.path)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(self.options["path"])


def whole(rows: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """archive, member, content of the archives that could be read to their end; ``bad``: the others, if they are known."""
    bad = quarantined(rows).select("archive") if bad is None else bad
    return rows.filter("member IS NOT NULL").join(bad, "archive", "left_anti").select("archive", "member", "content")


def quarantined(rows: DataFrame) -> DataFrame:
    """archive, problem: a row for each broken archive."""
    return rows.filter("problem IS NOT NULL").groupBy("archive").agg(F.first("problem").alias("problem"))


PAGE = "archive string, lccn string, date string, edition int, sequence int, reel string, txt string, xml string"


def run(spark: SparkSession, folder: str, root: str) -> None:
    """Take new archives of ``folder``: pages and quarantine are tables under ``root``, which a repeated batch leaves as they are."""
    spark.dataSource.register(ArchiveSource)

    def save(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        bad = small(quarantined(rows).select("archive"))  # few names, so that contents aren't shuffled by archive
        # Archives are read by a task each; as many tasks would cut a shuffle into too many pieces.
        pages = whole(rows.coalesce(4 * spark.sparkContext.defaultParallelism), bad)
        page_store(spark, root).upsert(archives.archive_pages(pages), order=["txt", "xml"], token=f"pages-{number}")
        quarantine(spark, root).upsert(quarantined(rows), order=["problem"], token=f"bad-{number}")
        rows.unpersist()

    stream = spark.readStream.format(NAME).load(folder)
    stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def page_store(spark: SparkSession, root: str) -> MergeTable:
    return MergeTable(spark, f"{root}/pages", PAGE, ["lccn", "date", "edition", "sequence"])


def quarantine(spark: SparkSession, root: str) -> MergeTable:
    return MergeTable(spark, f"{root}/quarantine", "archive string, problem string", ["archive"], 2)
