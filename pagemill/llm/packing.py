"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Pieces go, largest first, into the tightest bin that takes them without conflict: no bin holds two pieces of one
source (unless ``distinct_sources`` is off) or two documents of one duplicate cluster.  Open bins are ordered by what
room they have left and carry a bitmap of their sources and one of their clusters; bins alike in room and bitmaps
form one class.  The search starts at the least sufficient room and goes on to its successors until a class without
conflict is found.  Counts of how many bins of a room hold a source or cluster let it pass over rooms in which
every bin would conflict.

Documents are packed in groups of about GROUP pieces, dealt by a hash of the row: a hot source or cluster is spread
over all groups, and a group's work and memory are bounded.

Defined cases: a document longer than the capacity is cut into pieces of the capacity and a rest, none of it lost;
pieces of one document may not share a bin (they are one cluster), however long it is; a document without words has
piece 0 of 0 tokens and no bin (null); a null doc_id is kept, a null source is a source, a null cluster is none;
repeated rows are packed as often as they come; other columns are left out, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import small, word_count
from pagemill.llm.neardup import near_duplicates
from pagemill.scratch import written

CAPACITY = 2048
#: Pieces that a group holds on average.
GROUP = 4096
_SCHEMA = "doc_id long, piece int, n_tokens long, bin_id long, bin_offset long"


class BestFit:
    """Bins of one group."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms = 0  # bit r: a bin with room r is open
        self.total = [0] * (capacity + 1)
        self.classes: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
        self.source_at: dict[int, dict[int, int]] = {}  # source: room: bins with that room that hold it
        self.cluster_at: dict[int, dict[int, int]] = {}
        self.masks: list[tuple[int, int]] = []
        self.held: list[list[tuple[int, int]]] = []

    def _count(self, b: int, room: int, by: int) -> None:
        for s, c in self.held[b]:
            for at, key in ((self.source_at, s), (self.cluster_at, c)):
                if key >= 0:
                    rooms = at.setdefault(key, {})
                    rooms[room] = rooms.get(room, 0) + by

    def _open(self, b: int, room: int) -> None:
        if room:
            self.rooms |= 1 << room
            self.total[room] += 1
            self.classes[room].setdefault(self.masks[b], []).append(b)
            self._count(b, room, 1)

    def find(self, size: int, source: int, cluster: int) -> tuple[int, tuple[int, int]] | None:
        """The least room of a compatible bin, and its class."""
        sources, clusters = self.source_at.get(source, {}), self.cluster_at.get(cluster, {})
        sbit, cbit = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        left, room = self.rooms >> size, size
        while left:
            step = (left & -left).bit_length() - 1
            room, left = room + step, left >> step
            if self.total[room] > sources.get(room, 0) and self.total[room] > clusters.get(room, 0):
                for masks in self.classes[room]:
                    if not masks[0] & sbit and not masks[1] & cbit:
                        return room, masks
            room, left = room + 1, left >> 1
        return None

    def place(self, size: int, source: int = -1, cluster: int = -1) -> tuple[int, int]:
        """Bin and offset for a piece; -1: no source or no cluster that matters."""
        found = self.find(size, source, cluster)
        if found is None:
            b, room = len(self.masks), self.capacity
            self.masks.append((0, 0))
            self.held.append([])
        else:
            room, masks = found
            bins = self.classes[room][masks]
            b = bins.pop()
            if not bins:
                del self.classes[room][masks]
            self.total[room] -= 1
            if not self.total[room]:
                self.rooms ^= 1 << room
            self._count(b, room, -1)
        s, c = self.masks[b]
        self.masks[b] = (s | (1 << source if source >= 0 else 0), c | (1 << cluster if cluster >= 0 else 0))
        self.held[b].append((source, cluster))
        self._open(b, room - size)
        return b, self.capacity - room


def pack_group(sizes: Sequence[int], sources: Sequence[int], clusters: Sequence[int], capacity: int) -> list[tuple[int, int]]:
    bins = BestFit(capacity)
    return [bins.place(int(n), int(s), int(c)) for n, s, c in zip(sizes, sources, clusters, strict=True)]


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A small number for each distinct value, null included."""
    return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _pack_table(capacity: int, distinct_sources: bool):
    def run(g: pa.Table) -> pa.Table:
        keys = (("n_tokens", "descending"), ("cluster", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("source", "ascending"))
        g = g.take(pc.sort_indices(g, sort_keys=list(keys)))
        sizes = g.column("n_tokens").to_numpy()
        # Small numbers for what can conflict in this group: -1 for what can't.
        known = ~g.column("cluster").is_null().to_numpy()
        numbers, times = np.unique(g.column("cluster").fill_null(0).to_numpy()[known], return_inverse=True, return_counts=True)[1:]
        clusters = np.full(len(sizes), -1)
        clusters[known] = np.where(times[numbers] > 1, numbers, -1)
        sources = _numbers(g.column("source")) if distinct_sources else np.full(len(sizes), -1)
        full = sizes == capacity
        placed = pack_group(sizes[~full].tolist(), sources[~full].tolist(), clusters[~full].tolist(), capacity)
        bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        bins[~full], offsets[~full] = [b for b, _ in placed], [o for _, o in placed]
        top = max((b for b, _ in placed), default=-1) + 1
        bins[full] = np.arange(top, top + int(full.sum()))
        first = g.column("grp")[0].as_py() << 32
        return pa.Table.from_arrays([*(g.column(c) for c in ("doc_id", "piece", "n_tokens")), pa.array(bins + first), pa.array(offsets)], names=["doc_id", "piece", "n_tokens", "bin_id", "bin_offset"])

    return run


def _name() -> Column:
    """A row's name, whatever ids are null or shared; equal rows are alike."""
    return F.xxhash64("doc_id", "text")


def near_clusters(docs: DataFrame) -> DataFrame:
    """h, near: the cluster of each row that is a near copy, and not the first one, of another (h: its name)."""
    found = near_duplicates(docs.select(_name().alias("doc_id"), "text")).filter("component_id != doc_id")
    return written(found.select(F.col("doc_id").alias("h"), F.col("component_id").alias("near")).distinct(), "pack-near")


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None, tokens: Column | None = None, distinct_sources: bool = True, group: int = GROUP, near: DataFrame | None = None) -> DataFrame:
    """``docs``: doc_id, text, source. Returns doc_id, piece, n_tokens, bin_id, bin_offset; each token is in one piece.

    ``cluster``: the duplicate cluster (a long; by default equal texts); ``tokens``: the length (by default words);
    ``near``: instead of ``cluster``, what ``near_clusters`` finds.
    """
    if near is not None:
        cluster = _name()
    cluster = F.xxhash64("text") if cluster is None else cluster
    tokens = word_count(F.col("text")) if tokens is None else tokens
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.when(F.col("text").isNotNull(), cluster).cast("long").alias("cluster"), tokens.cast("long").alias("n"), _name().alias("h"))
    rows = written(rows, "pack-rows")
    if near is not None:  # a cluster has the name of its first row
        rows = rows.join(small(near), "h", "left").withColumn("cluster", F.when(F.col("cluster").isNotNull(), F.coalesce("near", "cluster"))).drop("near")
    pieces = F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)).cast("int")
    groups = max(1, -(-(rows.agg(F.sum(F.when(F.col("n") > 0, pieces))).head()[0] or 0) // group))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    size = F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("long") * capacity)
    rows = rows.withColumn("n_tokens", size).withColumn("grp", F.pmod(F.xxhash64("h", "piece"), F.lit(groups)))
    packed = rows.filter("n > 0").select("grp", "doc_id", "piece", "n_tokens", "source", "cluster").groupBy("grp").applyInArrow(_pack_table(capacity, distinct_sources), _SCHEMA)
    none = rows.filter("n <= 0").select("doc_id", "piece", F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"))
    return packed.unionByName(none)
