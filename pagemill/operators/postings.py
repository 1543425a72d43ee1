"""An inverted index: postings in blocks with bounds, read instead of the texts.

A segment is what one batch of documents adds.  Its documents lie in cells: up to CELL documents of one namespace and
of like length.  A block holds the postings of one term in one cell (places in the cell, frequencies and, for unstemmed
terms, positions) with the greatest frequency and the smallest length in it, from which the greatest score that the
block can give follows, whatever the namespace's figures are by then.  Blocks lie in folders by their field (stems or
terms) and a hash of their term; merged segments are sorted by it.  Queries read the folders, and of merged segments the
row groups, of their terms.

Cells are made of the documents that a task holds together, so a batch is written without a shuffle: a data source takes
the documents, and each task writes its blocks as Parquet by Arrow's file systems (local, s3, gs, hdfs), under names that
readers pass over until the job's commit renames them.  Only ``merge`` shuffles blocks; a frequent term has many, dealt
over tasks by their cells.

Top-k search passes over cells: figures of the blocks alone bound every cell's scores; the k cells with the greatest
bounds hold k documents, whose k-th best score no other cell's bound must stay below.  The rest of the postings is not
decoded into rows.  Joins with small sides are left to adaptive execution, which broadcasts them by their measured size.

Segments add up: document and term figures are sums over segments.  ``merge`` writes the live segments as one.  Keys are
long and unique in a namespace over all batches (settle upserts before, see ``merging``).

Defined cases: null texts count as empty documents; a null namespace or key is left out; an empty batch adds nothing;
an empty index finds nothing; a term that no document holds adds nothing; ties go to the smaller key.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.window import Window as W

from pagemill.functions.text import stem_of
from pagemill.operators.ranking import top_per_group
from pagemill.operators.search import K1, B
from pagemill.operators.versions import Versions
from pagemill.scratch import written
from pagemill.sources.archives import store_of

#: Documents of a cell, and words of documents that a task holds together.
CELL, HELD_WORDS = 256, 1 << 20
SOURCE = "postings_segment"
#: Folders of blocks.
FOLDERS = 8
STEM, TERM, CELLS = "stem", "term", "cells"
_BLOCK = "ns string, cell long, term string, n_docs int, max_tf int, min_n int, docs array<int>, tfs array<int>, positions array<array<int>>"
_ROW = f"{_BLOCK}, keys array<long>"
_FIGURES = "ns string, docs long, words long"


_LISTS = pa.list_(pa.int32())
_STORED = pa.schema([("ns", pa.string()), ("cell", pa.int64()), ("term", pa.string()), ("n_docs", pa.int32()), ("max_tf", pa.int32()), ("min_n", pa.int32()), ("docs", _LISTS), ("tfs", _LISTS), ("positions", pa.list_(_LISTS)), ("keys", pa.list_(pa.int64())), ("h", pa.int64())])
#: What isn't part of a term, as a space (terms are ASCII, so bytes tell).
_TERM_BYTES = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(256))


def _blocks(field: str, ns: str, cell: int, dictionary: pa.Array, hashes: np.ndarray, codes: np.ndarray, lens: np.ndarray) -> pa.RecordBatch:
    """The blocks of one cell: ``codes`` are its documents' words, one document after the other."""
    doc = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
    place = (np.arange(len(codes)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
    order = np.argsort(codes, kind="stable")  # within a term by document and place, as they come
    codes, doc, place = codes[order], doc[order], place[order]
    posting = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1]))))
    of, docs, tfs = codes[posting], doc[posting], np.diff(np.append(posting, len(codes))).astype(np.int32)
    term = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    ends, n = pa.array(np.append(term, len(of)).astype(np.int32)), len(term)
    lists_of = lambda values: pa.ListArray.from_arrays(ends, values)
    positions = lists_of(pa.ListArray.from_arrays(pa.array(np.append(posting, len(codes)).astype(np.int32)), pa.array(place))) if field == TERM else pa.nulls(n, pa.list_(_LISTS))
    sizes = pa.array(np.diff(np.append(term, len(of))).astype(np.int32))
    columns = [pa.repeat(pa.scalar(ns, pa.string()), n), pa.array(np.full(n, cell, dtype=np.int64)), pc.take(dictionary, pa.array(of[term])), sizes, pa.array(np.maximum.reduceat(tfs, term)), pa.array(np.minimum.reduceat(lens[docs], term).astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, lists_of(pa.array(docs)), lists_of(pa.array(tfs)), positions, pa.nulls(n, pa.list_(pa.int64())), pa.array(hashes[of[term]])], schema=_STORED)


def _cells(held: list[tuple[str, int, list[bytes]]], size: int) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Blocks, by field, and cell rows of documents (ns, key, words)."""
    held.sort(key=lambda d: (d[0], len(d[2]), d[1]))
    lens = np.array([len(words) for _, _, words in held], dtype=np.int64)
    ends = np.concatenate(([0], np.cumsum(lens)))
    words = pc.dictionary_encode(pa.array([w for _, _, ws in held for w in ws], pa.binary()))
    told = pc.cast(words.dictionary, pa.string())
    # Words are stemmed and hashed once each.
    stems = pc.dictionary_encode(pa.array([stem_of(w) for w in told.to_pylist()], pa.string()))
    hashed = lambda terms: np.array([zlib.crc32(t.encode()) for t in terms.to_pylist()], dtype=np.int64)
    codes = words.indices.to_numpy()
    fields = {TERM: (told, hashed(told), codes), STEM: (stems.dictionary, hashed(stems.dictionary), stems.indices.to_numpy()[codes] if len(codes) else codes)}
    begin = 0
    while begin < len(held):
        ns, end = held[begin][0], begin + 1
        while end < min(begin + size, len(held)) and held[end][0] == ns:
            end += 1
        keys = [key for _, key, _ in held[begin:end]]
        if ends[end] > ends[begin]:
            for field, (dictionary, hashes, all_) in fields.items():
                yield field, _blocks(field, ns, min(keys), dictionary, hashes, all_[ends[begin] : ends[end]], lens[begin:end])
        row = [ns, min(keys), None, len(keys), None, None, lens[begin:end].tolist(), None, None, keys, None]
        yield CELLS, pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _STORED.types, strict=True)], schema=_STORED)
        begin = end


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, int, list[bytes]]]]:
    """Documents that a task holds together: ns, key, words."""
    held, n = [], 0
    for batch in batches:
        for ns, key, low in zip(batch.column("ns").to_pylist(), batch.column("key").to_pylist(), batch.column("low"), strict=True):
            words = low.as_buffer().to_pybytes().translate(_TERM_BYTES).split()
            held.append((ns, key, words))
            n += len(words)
            if n >= HELD_WORDS:
                yield held
                held, n = [], 0
    if held:
        yield held


def _in_folders(found: Iterator[tuple[str, pa.RecordBatch]], folders: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows by the folder that their field and their term's hash tell."""
    parts: dict[str, list[pa.RecordBatch]] = {TERM: [], STEM: [], CELLS: []}
    for field, rows in found:
        parts[field].append(rows)
    for field, first in ((STEM, 0), (TERM, folders)):
        if parts[field]:
            rows = pa.Table.from_batches(parts.pop(field)).combine_chunks()
            own = rows.column("h").to_numpy() % folders
            for f in range(folders):
                some = np.flatnonzero(own == f)
                if len(some):
                    yield first + f, rows.take(pa.array(some))
    yield 2 * folders, pa.Table.from_batches(parts[CELLS])


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class SegmentWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.folders, self.cell = options["path"], int(options["folders"]), int(options["cell"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        (system, root), own = store_of(self.path), uuid.uuid4().hex
        files: dict[int, pq.ParquetWriter] = {}
        try:
            for held in _held(iterator):
                for folder, rows in _in_folders(_cells(held, self.cell), self.folders):
                    if folder not in files:
                        system.create_dir(f"{root}/folder={folder}", recursive=True)
                        files[folder] = pq.ParquetWriter(f"{root}/folder={folder}/_{own}.parquet", _STORED, filesystem=system, compression="zstd")
                    files[folder].write_table(rows)
        finally:
            for file in files.values():
                file.close()
        return Written([f"folder={folder}/_{own}.parquet" for folder in files])

    def commit(self, messages: list[Written | None]) -> None:
        system, root = store_of(self.path)
        system.create_dir(root, recursive=True)
        for name in (n for m in messages if m for n in m.names):
            system.move(f"{root}/{name}", f"{root}/{name.replace('/_', '/')}")

    def abort(self, messages: list[Written | None]) -> None:
        """What a failed job wrote stays unread: no version names its segment, and its files' names are passed over."""


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "ns string, key long, low string"

    def writer(self, schema, overwrite: bool) -> SegmentWriter:
        return SegmentWriter(self.options)


class Index:
    """An index under ``root``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str, folders: int = FOLDERS, cell: int = CELL):
        self.spark, self.root, self.folders, self.cell = spark, root.rstrip("/"), folders, cell
        self.versions = Versions(spark, root, "segment string")

    def _path(self, what: str):
        return lambda segment: f"{self.root}/{what}/{segment}"

    def _segments(self) -> list[str]:
        return [r.segment for r in self.versions.parts()]

    def _placed(self, rows: DataFrame) -> DataFrame:
        """With ``h``, the term's hash, and the folder, which the field and the hash tell."""
        rows = rows.withColumn("h", F.crc32(F.col("term").cast("binary")))
        own = F.pmod("h", F.lit(self.folders))
        return rows.withColumn("folder", F.when(F.col("field") == STEM, own).otherwise(own + self.folders).cast("int")).drop("field")

    # Writing

    def add(self, docs: DataFrame) -> None:
        """Add a segment of ``docs``: ns, key, text.  Each task writes its own blocks, without a shuffle or a sort."""
        texts = docs.select(F.col("ns").cast("string").alias("ns"), F.col("key").cast("long").alias("key"), F.lower(F.coalesce("text", F.lit(""))).alias("low")).filter("ns IS NOT NULL AND key IS NOT NULL")
        self.spark.dataSource.register(SegmentSource)
        segment = self.versions.fresh()
        texts.write.format(SOURCE).mode("append").options(path=self._path("blocks")(segment), folders=self.folders, cell=self.cell).save()
        self._publish(segment, [])

    def merge(self) -> None:
        """One segment of all: the same blocks, sorted anew, in fewer files."""
        segments = self._segments()
        if len(segments) > 1:
            # A frequent term's blocks are dealt by their cells; a folder gets a file from each task that has blocks of it.
            dealt = self._rows().repartition("folder", F.pmod(F.xxhash64("cell"), F.lit(4)))
            segment = self.versions.fresh()
            dealt.sortWithinPartitions("folder", "h").write.option("compression", "zstd").partitionBy("folder").parquet(self._path("blocks")(segment))
            self._publish(segment, segments)

    def _publish(self, segment: str, instead_of: list[str]) -> None:
        cells = self._cells([segment])
        figures = cells.groupBy("ns").agg(F.sum(F.size("keys")).alias("docs"), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("words"))
        figures.write.parquet(self._path("figures")(segment))
        if self.versions.read([segment], self._path("figures"), _FIGURES).isEmpty():
            return
        self.versions.publish([(s,) for s in self._segments() if s not in instead_of] + [(segment,)])

    # Reading

    def _rows(self, segments: list[str] | None = None) -> DataFrame:
        return self.versions.read(self._segments() if segments is None else segments, self._path("blocks"), f"{_ROW}, h long, folder int")

    def _cells(self, segments: list[str] | None = None) -> DataFrame:
        return self._rows(segments).filter(F.col("folder") == 2 * self.folders).select("ns", "cell", "keys", F.col("docs").alias("lens"))

    def cells(self) -> DataFrame:
        """ns, cell, keys, lens: a row for each cell, with its documents' keys and lengths."""
        return self._cells()

    def figures(self) -> DataFrame:
        """ns, docs, words: of each namespace."""
        each = self.versions.read(self._segments(), self._path("figures"), _FIGURES)
        return each.groupBy("ns").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))

    def blocks(self, wanted: Sequence[str], field: str = STEM) -> DataFrame:
        """The blocks of some terms; only their folders are read."""
        told = self._placed(self.spark.createDataFrame([(field, w) for w in wanted], "field string, term string")).collect()
        folders, hashes = sorted({r.folder for r in told}), [r.h for r in told]
        return self._rows().drop("keys").filter(F.col("folder").isin(folders) & F.col("h").isin(hashes) & F.col("term").isin(list(wanted)))

    def terms(self) -> DataFrame:
        """All terms, unstemmed."""
        return self._rows().filter((F.col("folder") >= self.folders) & (F.col("folder") < 2 * self.folders)).select("term").distinct()

    def weights(self, blocks: DataFrame) -> DataFrame:
        """ns, term, idf, mean: a row for each namespace and term of ``blocks``."""
        df = blocks.groupBy("ns", "term").agg(F.sum("n_docs").alias("df"))
        f = self.figures()
        return df.join(f, "ns").select("ns", "term", F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), (F.col("words") / F.col("docs")).alias("mean"))

    def bm25(self, query: Mapping[str, float], k: int, digits: int = 5) -> DataFrame:
        """ns, key, score (rounded to ``digits``), rank: the ``k`` best of each namespace; ``query``: words or
        stems, and boosts (words of one stem add up)."""
        return self.bm25_counted(query, k, digits)[0]

    def bm25_counted(self, query: Mapping[str, float], k: int, digits: int = 5) -> tuple[DataFrame, DataFrame]:
        """The result of ``bm25``, and ns, cell, bound, scored: which cells were looked into."""
        stemmed: dict[str, float] = {}
        for word, boost in query.items():
            stemmed[stem_of(word)] = stemmed.get(stem_of(word), 0.0) + boost
        query = stemmed
        blocks = self.blocks(list(query))
        weights = written(self.weights(blocks), "weights")
        heads = blocks.select("ns", "cell", "term", "max_tf", "min_n").join(weights, ["ns", "term"])
        boost = F.coalesce(*(F.when(F.col("term") == t, float(b)) for t, b in query.items()))
        heads = heads.withColumn("most", F.greatest(boost, F.lit(0.0)) * score(F.col("idf"), F.col("max_tf"), F.col("min_n"), F.col("mean")))
        bounds = written(heads.groupBy("ns", "cell").agg(F.sum("most").alias("bound")), "bounds")
        first = top_per_group(bounds, ["ns"], [F.col("bound").desc(), F.col("cell")], k, "_n").select("ns", "cell")
        probed = written(self._scored(blocks, weights, first, query, digits), "probed")
        kth = top_per_group(probed, ["ns"], [F.col("score").desc(), F.col("key")], k).filter(F.col("rank") == k).select("ns", F.col("score").alias("_kth"))
        # A bound is rounded up: a score may have been.
        reach = bounds.join(kth, "ns", "left").filter(F.col("_kth").isNull() | (F.col("bound") + 10.0**-digits >= F.col("_kth")))
        second = reach.join(first, ["ns", "cell"], "left_anti").select("ns", "cell")
        both = probed.unionByName(self._scored(blocks, weights, second, query, digits))
        looked = second.unionByName(first).withColumn("scored", F.lit(True))
        return top_per_group(both, ["ns"], [F.col("score").desc(), F.col("key")], k), bounds.join(looked, ["ns", "cell"], "left").withColumn("scored", F.coalesce("scored", F.lit(False)))

    def _postings(self, blocks: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """A row for each posting: ns, cell, term, key, n, tf and, if asked for, positions."""
        lists = F.arrays_zip("docs", "tfs", *extra)
        rows = blocks.select("ns", "cell", "term", F.explode(lists).alias("p"))
        cells = self.cells().join(blocks.select("ns", "cell").distinct(), ["ns", "cell"], "left_semi")
        docs = cells.select("ns", "cell", F.posexplode(F.arrays_zip("keys", "lens")).alias("_at", "d"))
        docs = docs.select("ns", "cell", "_at", F.col("d.keys").alias("key"), F.col("d.lens").alias("n"))
        rows = rows.select("ns", "cell", "term", F.col("p.docs").alias("_at"), F.col("p.tfs").alias("tf"), *(F.col(f"p.{e}").alias(e) for e in extra))
        return rows.join(docs, ["ns", "cell", "_at"]).drop("_at")

    def _scored(self, blocks: DataFrame, weights: DataFrame, cells: DataFrame, query: Mapping[str, float], digits: int) -> DataFrame:
        """ns, key, score of the documents in ``cells`` that hold any of the terms."""
        light = blocks.drop("positions").join(cells, ["ns", "cell"], "left_semi")
        rows = self._postings(light).join(weights, ["ns", "term"]).withColumn("part", score(F.col("idf"), F.col("tf"), F.col("n"), F.col("mean")))
        parts = rows.groupBy("ns", "key").agg(*(F.sum(F.when(F.col("term") == t, F.col("part") * float(b))).alias(f"_{i}") for i, (t, b) in enumerate(query.items())))
        total = reduce(add, (F.coalesce(f"_{i}", F.lit(0.0)) for i in range(len(query))))
        return parts.select("ns", "key", F.round(total, digits).alias("score"))

    def phrase(self, words: Sequence[str], slop: int = 0) -> DataFrame:
        """ns, key, n, freq: documents that hold the words in order, moved by at most ``slop`` places against each other.

        A word at p that is the i-th of the phrase stands at the place p - i of it.  The phrase matches at m if its words
        can be found, each in a position of its own, at places from m to m + slop; freq counts the m.  So two words in
        reverse order are two moves apart.
        """
        blocks = self.blocks(sorted(set(words)), TERM)
        full = blocks.groupBy("ns", "cell").agg(F.count_distinct("term").alias("_t")).filter(F.col("_t") == len(set(words))).select("ns", "cell")
        rows = self._postings(blocks.join(full, ["ns", "cell"], "left_semi"), ["positions"])
        slots = F.array(*(F.struct(F.lit(w).alias("w"), F.lit(i).alias("slot")) for i, w in enumerate(words)))
        rows = rows.withColumn("_s", F.explode(F.filter(slots, lambda s: s["w"] == F.col("term"))))
        rows = rows.select("ns", "key", "n", F.col("_s.slot").alias("slot"), F.explode("positions").alias("p")).withColumn("place", F.col("p") - F.col("slot"))
        here = W.partitionBy("ns", "key").orderBy("place")
        fits = reduce(lambda a, b: a & b, (F.count_if(F.col("slot") == i).over(here.rangeBetween(0, reach)) >= least for i, reach, least in demands(words, slop)))
        return rows.withColumn("_fits", fits).filter("_fits").groupBy("ns", "key", "n").agg(F.count_distinct("place").alias("freq"))

    def scored_phrase(self, words: Sequence[str], slop: int = 0, digits: int = 5) -> DataFrame:
        """ns, key, freq, score: the phrase counts as a term of the frequency freq whose idf is the sum of its words'."""
        weights = self.weights(self.blocks(sorted(set(words)), TERM))
        times = F.create_map(*(x for w in sorted(set(words)) for x in (F.lit(w), F.lit(words.count(w)))))
        idf = weights.groupBy("ns").agg(F.sum(F.col("idf") * times[F.col("term")]).alias("idf"), F.max("mean").alias("mean"))
        hits = self.phrase(words, slop).join(idf, "ns")
        return hits.select("ns", "key", "freq", F.round(score(F.col("idf"), F.col("freq"), F.col("n"), F.col("mean")), digits).alias("score"))


def score(idf: Column, tf: Column, n: Column, mean: Column) -> Column:
    """BM25 of one term: greater for a greater tf, and for a smaller n."""
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean))


def demands(words: Sequence[str], slop: int) -> list[tuple[int, int, int]]:
    """(slot, reach, least): of a slot's word so many positions at places from m to m + reach, for a match at m.

    Each slot needs one within the slop; slots of one word need as many different positions as there are of them, for
    every row of neighbouring slots (their ranges of positions have one length, so that is enough).
    """
    out = [(i, slop, 1) for i in range(len(words))]
    for i, w in enumerate(words):
        out += [(i, slop + j - i, words[i : j + 1].count(w)) for j in range(i + 1, len(words)) if words[j] == w]
    return out
