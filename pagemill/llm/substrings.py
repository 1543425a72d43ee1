"""Substring dedup with a log-structured fingerprint index.

A word goes if a window of WINDOW words that covers it also starts earlier.  Indexing every window would cost many
times the input, so windows are held in groups: each window is represented by the smallest hash of its 8-word grams,
and consecutive windows with the same representative form one entry (m: that hash; c: hash of all words the entry
covers).  Equal windows have equal m.  Entries with equal (m, c) hold the same windows one by one, so that only the
first of them matters; entries that share m alone are verified window by window, by 128-bit hashes of the texts' words.

The index is a list of immutable runs: tables bucketed by m and sorted by (m, c), in a catalog, with a manifest beside
them from which another session goes on.  A batch of documents is judged by merge-joining its own run with the earlier
runs (equal buckets, already sorted: no shuffle).  When there are MAX_RUNS runs, they are compacted into one, of which
only the first entry of every (m, c) is kept, before the next batch comes.

Hot passages: of equal entries or windows of the documents that a task holds at a time only the first leaves it, the
others are repeats at once.  An m of very many different entries (a passage that ends differently everywhere) is kept
apart from the buckets, in plain tables, and its windows are verified one by one, dealt by their hashes.  Which m is hot
is told from a sample of the batch's entries of bounded size; it decides where rows are worked on, not what comes out.

Defined cases: null and short texts hold no window and stay whole; very long ones are hashed whole, in parts; rows that
are equal in doc_id and text are the same document (none is earlier); rows that share a doc_id but not the text are told
apart by the text's hash, and a null doc_id counts as the smallest; an empty table gives no rows; other columns are left
out, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.llm.common import BATCH_ROWS, BROADCAST_ROWS, settings, small, written
from pagemill.llm.hashing import Powers, mixed, repeated, windows, word_hashes

#: Words of a window, and of the grams whose smallest hash represents it.
WINDOW, GRAM = 20, 8
#: Batches that the query feeds, and runs of an index before they are compacted.
BATCHES, MAX_RUNS = 3, 2
#: An m is hot if it has more than 1 / HOT of a bucket's mean number of entries; sampled entries of such a one.
HOT, SEEN = 4, 64
#: Null doc_ids sort first.
NO_ID = -(1 << 63)
_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        h, span = np.minimum(h[:-span], h[span:]), span * 2
    rest = width - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _new_groups(columns: list[np.ndarray]) -> np.ndarray:
    """Which rows (sorted) differ from the one before."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _firsts_of(keys: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal keys: which is first in place, and which come later (rows of the first's own place do neither)."""
    order = np.lexsort([*place[::-1], *keys[::-1]])
    keys, place = [c[order] for c in keys], [c[order] for c in place]
    new = _new_groups(keys)
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    first, later = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    first[order] = new
    later[order] = np.logical_or.reduce([c != c[head] for c in place])
    return first, later


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up, down = Powers(_B), Powers(_B_INVERSE)
    for batch in batches:
        docs, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "k"))
        parts: list[tuple[np.ndarray, ...]] = []
        for d, k, h in zip(docs, keys, word_hashes(batch.column("text").to_pylist()), strict=True):
            n = len(h)
            if n < WINDOW:
                continue
            m = sliding_min(windows(h, GRAM), WINDOW - GRAM + 1)
            start = np.concatenate(([0], np.nonzero(m[1:] != m[:-1])[0] + 1))
            count = np.diff(np.append(start, len(m)))
            with np.errstate(over="ignore"):
                sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(h * up.upto(n))))
                c = mixed((sums[start + count + WINDOW - 1] - sums[start]) * down.upto(n)[start] + count.astype(np.uint64))
            twice = repeated(windows(h, WINDOW))
            again = np.zeros(len(start), dtype=bool) if twice is None else np.logical_or.reduceat(twice, start)
            parts.append((m[start].view(np.int64), c.view(np.int64), np.full(len(start), d), np.full(len(start), k, dtype=np.int32), start.astype(np.int32), count.astype(np.int32), again))
        if parts:
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            first, later = _firsts_of(columns[:2], columns[2:5])
            keep = first | later
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (*columns, later)], names=["m", "c", "doc_id", "k", "start", "n", "again", "later"])


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes (128 bits) of each window in the given ranges of a text."""
    for batch in batches:
        parts: list[tuple[np.ndarray, ...]] = []
        hashes = word_hashes(batch.column("text").to_pylist())
        for b, d, k, ranges, h in zip(*(batch.column(c).to_pylist() for c in ("b", "doc_id", "k", "ranges")), hashes, strict=True):
            one, two = windows(h, WINDOW).view(np.int64), windows(h, WINDOW, second=True).view(np.int64)
            at = np.unique(np.concatenate([np.arange(r["start"], r["start"] + r["n"], dtype=np.int32) for r in ranges]))
            parts.append((one[at], two[at], np.full(len(at), b, dtype=np.int32), np.full(len(at), d, dtype=np.int64), np.full(len(at), k, dtype=np.int32), at))
        if parts:
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            first, later = _firsts_of(columns[:2], columns[2:])
            keep = first | later
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (*columns, later)], names=["h1", "h2", "b", "doc_id", "k", "start", "later"])


def _strip(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            words, n = (text or b"").split(), 0
            total = len(words)
            if ranges:
                step = np.zeros(total + 1, dtype=np.int32)
                for r in ranges:
                    step[r["start"]] += 1
                    step[r["start"] + r["n"] + WINDOW - 1] -= 1
                keep = np.cumsum(step[:-1]) == 0
                n = total - int(keep.sum())
                words = [words[i] for i in np.nonzero(keep)[0]]
            kept = b" ".join(words)
            out.append((total, n, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def named(docs: DataFrame) -> DataFrame:
    """doc_id, k (hash of the text), text as bytes."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.hash("text").alias("k"), F.col("text").cast("binary").alias("text"))


def _among(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``texts`` with the columns of ``keys`` (one row for each doc_id, k of it), text rows of other documents gone first."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(keys.select("doc_id", "k")), ["doc_id", "k"], "left_semi")
    return texts.join(keys, ["doc_id", "k"])


_PLACE = ("b", "doc_id", "k", "start")


def _copartitioned(spark: SparkSession):
    """Tables bucketed by m meet on (m, c) as they lie, without a shuffle by both."""
    return settings(spark, requireAllClusterKeysForCoPartition="false")


_RUN = ("m", "c", *_PLACE, "n", "again")


@dataclass
class FingerprintIndex:
    """Runs of window fingerprints of all documents seen, for incremental dedup.

    ``name``: of the index; its tables start with it.  ``texts_too``: keep the documents as well (compressed), so that
    later batches can be verified without the tables that earlier ones came from.
    """

    spark: SparkSession
    name: str = ""
    texts_too: bool = False
    buckets: int = 0
    batches: int = 0
    runs: list[str] = field(default_factory=list)
    hot_parts: list[str] = field(default_factory=list)
    hot_lists: list[str] = field(default_factory=list)
    text_parts: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.name = self.name or f"fingerprints_{uuid.uuid4().hex}"
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def open(cls, spark: SparkSession, name: str) -> FingerprintIndex:
        """The index as its last batch left it."""
        last = spark.table(f"{name}_manifest").orderBy(F.col("version").desc()).head()
        return cls(spark, name, last.texts_too, last.buckets, last.batches, list(last.runs), list(last.hot_parts), list(last.hot_lists), list(last.text_parts))

    def _publish(self) -> None:
        """A new version of the manifest; the runs that it names are never changed."""
        strings = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
        lists = {k: strings(getattr(self, k)) for k in ("runs", "hot_parts", "hot_lists", "text_parts")}
        values = {"version": F.lit(self.batches), "buckets": F.lit(self.buckets), "batches": F.lit(self.batches), "texts_too": F.lit(self.texts_too), **lists}
        self.spark.range(1).select(*(v.alias(k) for k, v in values.items())).write.mode("append").saveAsTable(f"{self.name}_manifest")

    def _table(self, kind: str) -> str:
        return f"{self.name}_{kind}_{uuid.uuid4().hex[:12]}"

    def _save(self, df: DataFrame, kind: str) -> str:
        table = self._table(kind)
        with settings(self.spark, execution_arrow_maxRecordsPerBatch=BATCH_ROWS):
            df.write.saveAsTable(table)
        return table

    def _save_run(self, df: DataFrame) -> str:
        """``df`` must be partitioned by m in as many parts as there are buckets."""
        table = self._table("run")
        df.select(*_RUN).write.bucketBy(self.buckets, "m").sortBy("m", "c").saveAsTable(table)
        return table

    @staticmethod
    def _firsts(run: DataFrame) -> DataFrame:
        return run.groupBy("m", "c").agg(F.min(F.struct(*_PLACE)).alias("p"), F.first("n").alias("n"), F.max("again").alias("again"))

    def add(self, batch: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """Judge ``batch`` (doc_id, text) against all earlier batches and itself, then keep its run.

        ``texts`` must hold every document of this and earlier batches (as ``named`` gives them), unless the index keeps
        texts; only those whose entries are not settled by their hashes are read.  Returns (doc_id, k, start, n):
        windows start to start + n - 1 are repeats.
        """
        if len(self.runs) >= MAX_RUNS:
            self.compact()
        self.batches += 1
        if self.texts_too:
            self.text_parts.append(self._save(named(batch), "texts"))
        schema = "m long, c long, doc_id long, k int, start int, n int, again boolean, later boolean"
        found = self._save(named(batch).mapInArrow(_entries, schema), "found")
        entries = self.spark.table(found).withColumn("b", F.lit(self.batches))
        known = written(entries.filter("later").select("doc_id", "k", "start", "n"), "repeats")
        fresh, ranges = self._part_hot(entries.filter("NOT later").select(*_RUN))
        run = self._save_run(fresh.repartition(self.buckets, "m"))
        self.spark.sql(f"DROP TABLE {found}")
        with _copartitioned(self.spark):
            repeats, unsettled = self._judge(self.spark.table(run))
        self.runs.append(run)
        out = known.union(repeats).union(self._verify(unsettled.union(ranges) if ranges is not None else unsettled, texts))
        self._publish()
        return out

    def _hot(self) -> DataFrame | None:
        """All m that are or were hot: a few for each bucket and batch."""
        lists = [self.spark.table(t) for t in self.hot_lists]
        return reduce(DataFrame.union, lists).distinct() if lists else None

    def _part_hot(self, entries: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The entries for the buckets, and the ranges of all entries (of earlier runs, too) whose m is hot."""
        # A bucket has total / buckets entries, a hot m a HOT-th of that or more: SEEN of them are expected in the sample.
        share = min(1.0, SEEN * HOT * self.buckets / max(entries.count(), 1))
        seen = entries.filter(F.shiftrightunsigned(F.xxhash64("doc_id", "k", "start", "m"), 11) <= int(share * (1 << 53)))
        new = seen.groupBy("m").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > SEEN // 2).select("m")
        old = self._hot()
        new = written(new.join(small(old), "m", "left_anti") if old is not None else new, "hot")
        if not new.isEmpty():
            earlier = [self.spark.table(r).join(small(new), "m", "left_semi").select(*_RUN) for r in self.runs]
            if earlier:
                self.hot_parts.append(self._save(reduce(DataFrame.union, earlier), "hot"))
            self.hot_lists.append(self._save(new, "hots"))
        hot = self._hot()
        if hot is None:
            return entries, None
        hot = small(hot)
        self.hot_parts.append(self._save(entries.join(hot, "m", "left_semi").select(*_RUN), "hot"))
        ranges = reduce(DataFrame.union, [self.spark.table(t).select(*_PLACE, "n") for t in self.hot_parts])
        return entries.join(hot, "m", "left_anti").select(*_RUN), ranges

    def _judge(self, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Entries that repeat as a whole, and the ranges of windows that hashes don't settle.

        One pass over the batch's run, in the order of its buckets, merged with each earlier run by (m, c) and by m.
        """
        old = [self._firsts(self.spark.table(r)) for r in self.runs]
        place = F.struct(*_PLACE)
        rows = entries.withColumn("p", F.min(place).over(W.partitionBy("m", "c"))).withColumn("others", F.lit(0).cast("long"))
        for run in old:
            rows = rows.join(run.select("m", "c", F.col("p").alias("q")), ["m", "c"], "left").withColumn("p", F.coalesce(F.least("p", "q"), "p")).drop("q")
            rows = rows.join(run.groupBy("m").agg(F.count(F.lit(1)).alias("o")), "m", "left").withColumn("others", F.col("others") + F.coalesce("o", F.lit(0))).drop("o")
        # An entry is unsettled if it is the first of its (m, c) and another (m, c') exists, or it repeats within itself.
        held = W.partitionBy("m")
        rows = rows.withColumn("repeat", place > F.col("p"))
        rows = rows.withColumn("firsts", F.sum(F.when(F.col("repeat"), 0).otherwise(1)).over(held)).withColumn("loops", F.max("again").over(held))
        judged = rows.filter("repeat OR firsts + others > 1 OR loops").select("m", *_PLACE, "n", "repeat")
        judged = written(judged, "judged")
        ranges = judged.filter("NOT repeat").select(*_PLACE, "n")
        open_ = judged.filter("NOT repeat").select("m").distinct()
        for run in old:
            ranges = ranges.union(run.join(open_, "m", "left_semi").select("p.b", "p.doc_id", "p.k", "p.start", "n"))
        return judged.filter("repeat").select("doc_id", "k", "start", "n"), written(ranges, "unsettled")

    def _verify(self, ranges: DataFrame, texts: DataFrame | None) -> DataFrame:
        """Single windows of this batch that start earlier elsewhere, by 128-bit hashes of their words."""
        if texts is None:
            texts = reduce(DataFrame.union, [self.spark.table(t) for t in self.text_parts])
        by_doc = written(ranges.groupBy("b", "doc_id", "k").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), "unsettled-docs")
        checked = _among(texts, by_doc).select("b", "doc_id", "k", "text", "ranges")
        hashes = written(checked.mapInArrow(_window_hashes, "h1 long, h2 long, b int, doc_id long, k int, start int, later boolean"), "windows")
        first = hashes.filter("NOT later").groupBy("h1", "h2").agg(F.min(F.struct(*_PLACE)).alias("p"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
        # Written, so that a hot window's rows are joined by tables that Spark may split, not in the task that counted them.
        first = written(first, "window-firsts")
        fresh = hashes.filter(F.col("b") == self.batches)
        later = fresh.filter("NOT later").join(small(first), ["h1", "h2"]).filter(F.struct(*_PLACE) > F.col("p"))
        return written(fresh.filter("later").unionByName(later.drop("p")).select("doc_id", "k", "start", F.lit(1).alias("n")), "singles")

    def compact(self) -> None:
        """Merge all runs into one, bucket by bucket; of equal entries the first stays."""
        with _copartitioned(self.spark):
            rows = self._firsts(self.spark.table(self.runs[0]))
            for r in self.runs[1:]:
                more = self._firsts(self.spark.table(r)).select("m", "c", F.col("p").alias("q"), F.col("n").alias("o"), F.col("again").alias("a"))
                rows = rows.join(more, ["m", "c"], "full").select("m", "c", F.least("p", "q").alias("p"), F.coalesce("n", "o").alias("n"), F.coalesce(F.greatest("again", "a"), F.lit(False)).alias("again"))
            # The rows lie in the tasks of their buckets, although Spark doesn't know that after a full join.
            done = self._save_run(rows.select("m", "c", "p.*", "n", "again"))
        hot = self.hot_parts
        if hot:
            merged = self._firsts(reduce(DataFrame.union, [self.spark.table(t) for t in hot])).select("m", "c", "p.*", "n", "again")
            self.hot_parts = [self._save(merged.select(*_RUN), "hot")]
        gone, self.runs = [*self.runs, *hot], [done]
        for t in gone:
            self.spark.sql(f"DROP TABLE {t}")

    def drop(self) -> None:
        for t in (*self.runs, *self.hot_parts, *self.hot_lists, *self.text_parts, f"{self.name}_manifest"):
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.runs, self.hot_parts, self.hot_lists, self.text_parts = [], [], [], []


def strip(docs: DataFrame, repeats: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (if asked) kept, for each row of ``docs``."""
    texts = named(docs)
    ranges = written(repeats.groupBy("doc_id", "k").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), "removals")
    keys = ranges.select("doc_id", "k")
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        none = F.lit(None).cast("array<struct<start int, n int>>")
        whole = texts.join(F.broadcast(keys), ["doc_id", "k"], "left_anti").withColumn("ranges", none)
        both = whole.union(_among(texts, ranges).select("doc_id", "k", "text", "ranges"))
    else:
        both = texts.join(ranges, ["doc_id", "k"], "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    out = both.select("doc_id", "text", "ranges").mapInArrow(lambda it: _strip(it, with_text), schema)
    out = out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
    return out if with_text else out.drop("kept")


def dedup_substrings(docs: DataFrame, batches: int = BATCHES, with_text: bool = False) -> DataFrame:
    """Feed ``docs`` to an index in ``batches`` of ascending doc_id, then strip what repeats."""
    spark, texts = docs.sparkSession, named(docs)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(docs.select(F.percentile_approx(ids, shares, 1000)).head()[0] or [])) if shares else []
    index, found = FingerprintIndex(spark), []
    try:
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            part = docs if low is None else docs.filter(ids > low)
            part = part if high is None else part.filter(ids <= high)
            found.append(index.add(part.select("doc_id", "text"), texts))
    finally:
        index.drop()
    return strip(docs, reduce(DataFrame.union, found), with_text)
