"""Page archives: bz2-compressed tar files of OCR text and layout XML.

Such a file can't be split, so an archive is one task's work.  It is read as a stream: a task holds the members of one
small batch, however large the archive is.  Spark groups the members into pages.
"""

from __future__ import annotations

import bz2
import tarfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.links import segments

#: Bytes of members that a task holds at a time.
HELD = 4 << 20
_SCHEMA = "archive string, member string, content string"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a local folder or of a store that Arrow knows (s3, gs, hdfs), and the path in it."""
    if path.startswith("file:"):
        path = "file://" + path.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(path)


def open_uri(path: str) -> BinaryIO:
    """A file as a stream."""
    system, name = store_of(path)
    return system.open_input_stream(name, compression=None)


def open_file(path: str) -> BinaryIO:
    """A file of which parts are read."""
    system, name = store_of(path)
    return system.open_input_file(name)


def members(stream: BinaryIO) -> Iterator[tuple[str, str]]:
    """Name and text of each OCR file, one at a time."""
    with tarfile.open(fileobj=bz2.BZ2File(stream), mode="r|") as tar:
        for m in tar:
            if m.isfile() and m.name.endswith(("/ocr.txt", "/ocr.xml")):
                yield m.name, tar.extractfile(m).read().decode("utf-8", "replace")


def _read(opener: Callable[[str], BinaryIO]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names=["archive", "member", "content"])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                with opener(path) as stream:
                    for name, content in members(stream):
                        held.append((path, name, content))
                        size += len(content)
                        if size >= HELD:
                            yield out()
                            held, size = [], 0
                if held:
                    yield out()

    return run


def read_members(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_uri) -> DataFrame:
    """archive, member, content of the OCR files in all archives under ``path``.

    Spark lists the files; a task opens each with ``opener`` (for a store that Arrow doesn't know, give your own).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.bz2").option("recursiveFileLookup", "true").load(path).select("path")
    return files.repartition(max(1, len(files.inputFiles()))).mapInArrow(_read(opener), _SCHEMA)


def archive_pages(rows: DataFrame) -> DataFrame:
    """One row for each page: its key, text (``txt``) and layout XML (``xml``), whichever there are.

    Members: ``<lccn>/[<reel>/]<yyyy>/<mm>/<dd>/ed-<n>/seq-<n>/ocr.<kind>``; a reel has seven digits or more.
    """
    after = lambda c, mark: F.when(F.startswith(c, F.lit(mark)), F.substring(c, len(mark) + 1, 9)).try_cast("int")

    def keys(p: Column) -> Column:
        part = lambda k: F.when(F.size(p) >= k, F.element_at(p, -k))
        reel = F.when(part(7).rlike("^[0-9]{7,}$") & (part(8) != "."), part(7))
        lccn, date = F.when(reel.isNotNull(), part(8)).otherwise(part(7)), F.concat_ws("-", part(6), part(5), part(4))
        return F.struct(lccn.alias("lccn"), reel.alias("reel"), date.alias("date"), after(part(3), "ed-").alias("edition"), after(part(2), "seq-").alias("sequence"), F.substring_index(part(1), ".", -1).alias("kind"))

    # A name is split once: as columns, its parts would be found anew for each use and each filter.
    rows = rows.select("archive", F.inline(F.transform(F.array(segments(F.col("member"))), keys)), "content")
    rows = rows.filter("lccn IS NOT NULL AND edition IS NOT NULL AND sequence IS NOT NULL AND kind IN ('txt', 'xml')").filter(F.col("date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))
    one = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("content"))).alias(kind)
    # Dealt by the page alone and sorted once: who settles pages of several archives needs no other shuffle of the contents.
    page = ["lccn", "date", "edition", "sequence"]
    out = rows.repartition(*page).groupBy(*page, "archive").agg(F.max("reel").alias("reel"), one("txt"), one("xml"))
    return out.select("archive", *page, "reel", "txt", "xml")
