"""Sharding by minimax contiguous partition over atomic groups of equal texts.

Groups are ordered by the 64-bit hash of their text, so that a range of hashes is a contiguous run of groups.
The smallest shard capacity C for which a greedy fill needs at most K shards is found by binary search over
exact prefix sums of hash cells.  Only cells in which a cut may fall are split further (a radix search), so the
driver sees at most ``max_cells`` sums at a time, however many groups there are; the search ends when the bounds
on C meet.  The cuts are hash values, so rows find their shard without a sort or join.

Defined cases: a null text counts as empty; equal texts never part, even when one group outgrows a shard (C is
then that group's size and the others are balanced around it); an empty table gives no rows; repeated rows are
rows of their own; the columns named in ``keep`` are kept whatever their names, but new ones named ``size``,
``text_crc32``, ``shard``, ``slot`` replace columns of that name; a null doc_id is one like any other; of a very long
text only its size and hashes leave the scan.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.llm.common import quoted, small, whole_row
from pagemill.scratch import written

#: Bytes that a row costs besides its text.
ROW_BYTES = 8
#: Sums that the driver may hold in one round of the capacity search.
MAX_CELLS = 1 << 17
#: Hash bits of the first round.
FIRST_BITS = 12
#: Blocks in which the rows of a shard are numbered independently.
SLOT_BLOCKS = 1024
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Cuts:
    """Hashes at which a new shard starts, ascending (None: no group is left for it), and the capacity found."""

    starts: list[int | None]
    capacity: int


class _Cells:
    """Sums of consecutive hash cells, in order."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows = sorted(rows)
        self.low = [r[0] for r in rows]
        self.many = [r[2] > 1 for r in rows]
        self.largest = max((r[3] for r in rows), default=0)
        self.prefix = [0]
        for r in rows:
            self.prefix.append(self.prefix[-1] + r[1])
        self.total = self.prefix[-1]

    def fill(self, capacity: int, shards: int, fluid: bool) -> list[int]:
        """Positions reached by a greedy fill; a cell of several groups is indivisible, or (fluid) divisible anywhere."""
        at, out = 0, []
        for _ in range(shards):
            to = at + capacity
            if to >= self.total:
                to = self.total
            else:
                i = bisect_right(self.prefix, to) - 1
                if not (fluid and self.many[i]):
                    to = self.prefix[i]
            at = max(at, to)
            out.append(at)
        return out

    def least(self, shards: int, fluid: bool) -> int:
        """Smallest capacity for which the fill reaches the end."""
        low, high = max(self.largest, -(-self.total // shards)), max(self.total, 1)
        while low < high:
            mid = (low + high) // 2
            if self.fill(mid, shards, fluid)[-1] == self.total:
                high = mid
            else:
                low = mid + 1
        return low


def find_cuts(groups: DataFrame, shards: int, max_cells: int = MAX_CELLS) -> Cuts:
    """``groups``: one row for each atomic group, its hash ``h`` (distinct) and ``size``."""

    def sums(bits: int, where=None) -> list[tuple[int, int, int, int]]:
        df = groups if where is None else groups.filter(where)
        cell = F.shiftright("h", 64 - bits).alias("cell") if bits < 64 else F.col("h").alias("cell")
        got = df.groupBy(cell).agg(F.sum("size"), F.count(F.lit(1)), F.max("size")).collect()
        return [(r[0] << (64 - bits), r[1], r[2], r[3]) for r in got]

    bits = min(FIRST_BITS, max(1, max_cells.bit_length() - 1))
    rows = sums(bits)
    while True:
        cells = _Cells(rows)
        low, high = cells.least(shards, True), cells.least(shards, False)
        windows: list[list[int]] = []
        for a, b in zip(cells.fill(low, shards, False), cells.fill(high, shards, True), strict=True):
            i, j = bisect_right(cells.prefix, a) - 1, min(bisect_left(cells.prefix, b), len(cells.low)) - 1
            if windows and i <= windows[-1][1] + 1:
                windows[-1][1] = max(windows[-1][1], j)
            elif i <= j:
                windows.append([i, j])
        windows = [w for w in windows if any(cells.many[w[0] : w[1] + 1])]
        if low == high or not windows or bits == 64:
            return _cut(cells, high, shards)
        inside = sum(j - i + 1 for i, j in windows)
        more = min(64, bits + max(1, (max_cells // inside).bit_length() - 1))
        where, taken = F.lit(False), set()
        for i, j in windows:
            top = cells.low[j + 1] - 1 if j + 1 < len(cells.low) else (1 << 63) - 1
            where = where | F.col("h").between(F.lit(cells.low[i]), F.lit(top))
            taken.update(range(i, j + 1))
        kept = [r for k, r in enumerate(sorted(rows)) if k not in taken]
        rows, bits = kept + sums(more, where), more


def _cut(cells: _Cells, capacity: int, shards: int) -> Cuts:
    """Cuts that respect the capacity and, within it, leave the rest as even as they can."""
    p, n = cells.prefix, len(cells.low)
    last = [n]
    for _ in range(shards - 1):  # the first boundary from which the later shards can still take all
        last.append(bisect_left(p, p[last[-1]] - capacity))
    last = last[::-1]
    at, starts = 0, []
    for j in range(1, shards):
        ideal = p[at] + (cells.total - p[at]) / (shards - j + 1)
        i = bisect_left(p, ideal)
        if i > 0 and (i > n or ideal - p[i - 1] < p[i] - ideal):
            i -= 1
        i = min(max(i, at, last[j - 1]), bisect_right(p, p[at] + capacity) - 1)
        starts.append(cells.low[i] if i < n else None)
        at = i
    return Cuts(starts, capacity)


def shard(docs: DataFrame, shards: int = 24, keep: list[str] | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """Rows of ``docs`` (``doc_id``, ``text``; ``keep`` names further columns) with size, text_crc32, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    keep = [c for c in keep or [] if c not in ("doc_id", "size", "text_crc32", "shard", "slot")]
    kept = [whole_row(docs, keep).alias("kept")] if keep else []
    rows = written(
        docs.select("doc_id", *kept, (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")),
        "shard-rows",
    )
    groups = written(rows.groupBy("h").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = find_cuts(groups, shards, max_cells)
    number = sum((F.when(F.col("h") >= F.lit(s), 1).otherwise(0) for s in cuts.starts if s is not None), F.lit(0))
    # Numbered in blocks by a hash of the row, so that neither a shard nor a group of copies is one task's work.
    rows = rows.withColumn("shard", number.cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SLOT_BLOCKS)).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(F.col("shard").alias("s"), F.col("block").alias("b"), (F.sum("n").over(W.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    numbered = rows.withColumn("k", F.row_number().over(W.partitionBy("shard", "block").orderBy("doc_id", "h")))
    # At most shards * SLOT_BLOCKS rows of three numbers: broadcast if these are few.
    out = numbered.join(small(offsets), (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
    return out.select("doc_id", *[F.col("kept." + quoted(c)) for c in keep], "size", "text_crc32", "shard", (F.col("before") + F.col("k") - 1).cast("long").alias("slot"))
