"""Periodic runs of words, found in tiles for each octave of periods and stitched across tiles.

A run is a stretch of words in which words q apart are identical, of at least max(LEAST, 2 q) words, that can't be
extended; q is its smallest period.  Periods are taken by octaves, q in [P, 2 P).  For an octave a text is cut into
tiles that overlap by more than two of its longest periods, so that every stretch of 2 q words lies within a tile.  In a
tile, boundaries stand P words apart, and every run of the octave holds one, c, such that the words from c on and from
c + q on agree for f words, those before c and before c + q for b words (the Z-functions at c, forwards and backwards),
and f + b >= q.  One of the two is at least q / 2: hashes of P / 2 words, at c against all c + q at once, leave the
shifts for which the Z-functions are worked out, and the fragment from c - b to c + q + f is confirmed word by word.

Texts of up to SHORT words are a single tile for all octaves, solved where they are read.  The tiles of longer ones are
dealt over all tasks: one kind for all short periods, and one for each octave above.  Fragments are shuffled by document
and period and stitched where they share a period's length of words (they then have that period together).  A stretch
that several periods fit has the smallest of them; the others are its multiples.

Words are numbered exactly in each batch; 64-bit hashes of stretches only tell where to look (unequal stretches with
equal hashes are found out; a mix that isn't a polynomial has no short colliding texts).  In memory at a time: a batch
of texts, or a few tiles; a tile of the highest octave is about as long as its text.

Defined cases: null and empty texts have no words and no runs; rows equal in doc_id and text are one document, and each
gets its runs; rows that share a doc_id (null ones too) are told apart by the text's hash; an empty table gives no rows;
other columns stay out of the way, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.llm.common import written
from pagemill.llm.hashing import mixed

#: Words that a run has at least.
LEAST = 12
#: Periods below 2 ** FEW share a tile; a tile's own words are four times the longest period, so many in a short text.
FEW = 10
SHORT = 4 << FEW
#: Words that are worked on together.
TOGETHER = 1 << 18
KEYS = ("doc_id", "text_key")
_B = np.uint64(0x9E3779B97F4A7C15)
Fragments = tuple[np.ndarray, np.ndarray, np.ndarray]


def least_agreeing(q: np.ndarray) -> np.ndarray:
    """Words that must agree with those ``q`` later in a run of the period ``q``."""
    return np.maximum(q, LEAST - q)


class Stretches:
    """Hashes of all stretches of 1, 2, 4, ... words."""

    def __init__(self, words: np.ndarray, longest: int):
        with np.errstate(over="ignore"):
            self.n, self.of = len(words), [mixed(words.astype(np.uint64) + _B)]
            while 2 << (len(self.of) - 1) <= min(longest, self.n):
                last, half = self.of[-1], 1 << (len(self.of) - 1)
                self.of.append(mixed(last[:-half] * _B + last[half:]))

    def agree(self, c: np.ndarray, q: np.ndarray, back: bool) -> np.ndarray:
        """Z-function values: how many words from ``c`` on (``back``: before it) equal those ``q`` later."""
        out = np.zeros(len(c), dtype=np.int64)
        for j in range(len(self.of) - 1, -1, -1):
            h = self.of[j]
            at = c - out - (1 << j) if back else c + out
            fits = (at >= 0) if back else (at + q < len(h))
            at = np.where(fits, at, 0)
            out += (fits & (h[at] == h[np.where(fits, at + q, 0)])).astype(np.int64) << j
        return out


def _equal_ahead(h: np.ndarray, first: int, period: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places first, first + step, ... of ``h`` and shifts in [period, 2 period) whose values are equal."""
    h = h[first:]
    if len(h) <= period:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if step > period:
        found = [(np.flatnonzero(h[: len(h) - q : step] == h[q::step]), q) for q in range(period, min(2 * period, len(h)))]
        return first + step * np.concatenate([m for m, _ in found]), np.concatenate([np.full(len(m), q) for m, q in found])
    blocks = -(-(len(h) - period) // period)
    ahead = np.zeros(blocks * period, dtype=h.dtype)
    ahead[: len(h) - period] = h[period:]
    hit = np.flatnonzero(ahead.reshape(blocks, period) == h[: blocks * period : period, None])
    hit = hit[hit < len(h) - period]
    return first + hit // period * period, period + hit % period


def octave(words: np.ndarray, stretches: Stretches, k: int) -> Fragments:
    """Start, end and period of the maximal stretches of ``words`` with periods in [2 ** k, 2 ** (k + 1)); of the
    periods of one stretch the smallest."""
    period = 1 << k
    step = max(period, 4)
    level = {0: 2, 1: 2, 2: 1}.get(k, k - 1)  # words that agree on one side at least, for LEAST = 12
    if level >= len(stretches.of):
        return (np.empty(0, dtype=np.int64),) * 3
    h, width = stretches.of[level][: max(len(words) - (1 << level) + 1, 0)], 1 << level
    ahead, behind = _equal_ahead(h, 0, period, step), _equal_ahead(h, step - width, period, step)
    c, q = np.concatenate([ahead[0], behind[0] + width]), np.concatenate([ahead[1], behind[1]])
    if not len(c):
        return (np.empty(0, dtype=np.int64),) * 3
    f, b = stretches.agree(c, q, False), stretches.agree(c, q, True)
    good = f + b >= least_agreeing(q)
    start, end, q = (c - b)[good], (c + q + f)[good], q[good]
    order = np.lexsort((q, end, start))
    return confirmed(words, start[order], end[order], q[order])


def confirmed(words: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> Fragments:
    """The fragments as the words themselves have them; of those with one start and end the first."""
    out, whole = [], (-1, -1)
    for s, e, p in zip(start.tolist(), np.minimum(end, len(words)).tolist(), q.tolist(), strict=True):
        if whole == (s, e):
            continue
        same = words[s : e - p] == words[s + p : e]
        if same.all():
            out.append((s, e, p))
            whole = s, e
        else:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], same, [0]))))
            out += [(s + x, s + y + p, p) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if y - x >= max(p, LEAST - p)]
    rows = np.array(out, dtype=np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def solve(parts: Sequence[np.ndarray], first: int = 0, end: int | None = None) -> tuple[np.ndarray, ...]:
    """Part, start, end and period of the fragments in ``parts`` with periods in [2 ** first, 2 ** end)."""
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    lengths = np.array([len(parts[i]) for i in order], dtype=np.int64)
    if not len(order) or lengths[0] < LEAST:
        return (np.empty(0, dtype=np.int64),) * 4
    # A number of its own after each part: nothing repeats across it.
    words = np.concatenate([np.append(parts[i].astype(np.int64), (1 << 40) + n) for n, i in enumerate(order)])
    starts = np.cumsum(lengths + 1) - lengths - 1
    longest, out = int(lengths[0]), []
    stretches = Stretches(words, longest)
    for k in range(first, min(end or 64, longest.bit_length())):
        held = int((lengths >= max(LEAST, 2 << k)).sum())
        if not held:
            break
        out.append(octave(words[: starts[held - 1] + lengths[held - 1]], stretches, k))
    if not out:
        return (np.empty(0, dtype=np.int64),) * 4
    s, e, q = (np.concatenate(x) for x in zip(*out, strict=True))
    at = np.searchsorted(starts, s, side="right") - 1
    return np.array(order, dtype=np.int64)[at], s - starts[at], e - starts[at], q


def tiles(n: int) -> Iterator[tuple[int, int, int, int]]:
    """For a text of ``n`` words: its tiles' octaves (first, end), first and end word."""
    first, end = 0, FEW
    while first == 0 or 2 << first <= n:
        own, more = 4 << end, (2 << end) + LEAST
        for at in range(0, n, own):
            if at == 0 or n - at >= max(LEAST, 2 << first):
                yield first, end, at, min(n, at + own + more)
        first, end = end, end + 1


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """The words of all texts as numbers (equal for equal words), where each text's begin and end, and the words."""
    bare = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.if_else(pc.equal(bare, ""), pa.scalar([], pa.list_(pa.string())), pc.ascii_split_whitespace(bare))
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return pc.dictionary_encode(lists.flatten()).indices.to_numpy(), ends, lists


_FRAGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("period", pa.int64())])
_SCANNED = "n_words long, fragments array<struct<start: bigint, end: bigint, period: bigint>>, words string, words_sha256 string, first int, last int, at long, tile binary"


def _groups(lengths: list[int]) -> Iterator[range]:
    """Neighbours whose lengths come to TOGETHER at most (or one that is longer)."""
    begin = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > TOGETHER:
            yield range(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield range(begin, len(lengths))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: its fragments if it is short, its words if there may be any run; and the tiles of long ones."""
    for batch in batches:
        codes, ends, lists = numbered(batch.column("text"))
        lengths = np.diff(ends)
        long = lengths > SHORT
        own = np.flatnonzero(~long)
        found: list[tuple[np.ndarray, ...]] = []
        for group in _groups(lengths[own].tolist()):
            at = own[group.start : group.stop]
            part, s, e, q = solve([codes[ends[i] : ends[i + 1]] for i in at])
            found.append((at[part], s, e, q))
        rows, s, e, q = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, dtype=np.int64),) * 4
        order = np.argsort(rows, kind="stable")
        offsets = np.searchsorted(rows[order], np.arange(batch.num_rows + 1)).astype(np.int32)
        fragments = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x[order]) for x in (s, e, q)], fields=list(_FRAGMENT)))
        joined = pc.binary_join(lists, " ")
        kept = long | (np.diff(offsets) > 0)
        digests = [None if k else hashlib.sha256(t.as_buffer()).hexdigest() for k, t in zip(kept.tolist(), joined, strict=True)]
        held = pc.if_else(pa.array(kept), joined, pa.scalar(None, pa.string()))
        keys = [batch.column(c) for c in KEYS]
        nothing = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary())]
        names = [*KEYS, "n_words", "fragments", "words", "words_sha256", "first", "last", "at", "tile"]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(lengths), fragments, held, pa.array(digests, pa.string()), *nothing], names=names)
        for i in np.flatnonzero(long).tolist():
            # Numbers of its own text alone: small, and the same in whatever batch it comes.
            mine = np.unique(codes[ends[i] : ends[i + 1]], return_inverse=True)[1].astype(np.int32)
            for first, last, a, z in tiles(len(mine)):
                row = [k.slice(i, 1) for k in keys]
                rest = [pa.nulls(1, t) for t in (pa.int64(), pa.list_(_FRAGMENT), pa.string(), pa.string())]
                tile = [pa.array([v], t) for v, t in ((first, pa.int32()), (last, pa.int32()), (a, pa.int64()), (mine[a:z].tobytes(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*row, *rest, *tile], names=names)


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        firsts, lasts, ats = (batch.column(c).to_pylist() for c in ("first", "last", "at"))
        for i, tile in enumerate(batch.column("tile")):
            _, s, e, q = solve([np.frombuffer(tile.as_buffer(), dtype=np.int32)], firsts[i], lasts[i])
            keys = [pc.take(batch.column(c), pa.array(np.full(len(s), i))) for c in KEYS]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x) for x in (s + ats[i], e + ats[i], q))], names=[*KEYS, "start", "end", "period"])


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs (KEYS, start, length, period) from fragments (KEYS, start, end, period)."""
    w = W.partitionBy(*KEYS, "period").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    apart = fragments.withColumn("opens", F.coalesce(before - F.col("start") < F.col("period"), F.lit(True)))
    islands = apart.withColumn("island", F.sum(F.col("opens").cast("int")).over(w))
    whole = islands.groupBy(*KEYS, "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # All periods of one stretch are multiples of its smallest.
    smallest = whole.repartition(*KEYS).groupBy(*KEYS, "start", "end").agg(F.min("period").alias("period"))
    return smallest.select(*KEYS, "start", (F.col("end") - F.col("start")).alias("length"), "period")


def scanned(docs: DataFrame) -> DataFrame:
    """One pass over ``docs`` (doc_id, text): for each row n_words, fragments, words where they may be needed again,
    else their digest; and the tiles of long texts as rows of their own."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    return written(keyed.mapInArrow(_scan, f"doc_id {id_type}, text_key long, {_SCANNED}"), "period-scan")


def runs_of(scan: DataFrame) -> DataFrame:
    """Runs (KEYS, start, length, period) of the texts that ``scanned`` went over."""
    id_type = scan.schema["doc_id"].dataType.simpleString()
    own = scan.filter(F.col("tile").isNull() & (F.size("fragments") > 0)).select(*KEYS, F.explode("fragments").alias("f")).select(*KEYS, "f.*")
    dealt = scan.filter(F.col("tile").isNotNull()).select(*KEYS, "first", "last", "at", "tile").repartition(*KEYS, "first", "at")
    solved = dealt.mapInArrow(_solve_tiles, f"doc_id {id_type}, text_key long, start long, end long, period long")
    return stitched(own.unionByName(solved))


def runs(docs: DataFrame) -> DataFrame:
    """All periodic runs of the texts of ``docs``: doc_id, text_key, start (word number), length, period."""
    return runs_of(scanned(docs))


def _without(words: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
    out = []
    for text, low, high in zip(words, lows, highs, strict=True):
        parts = np.array(text.split(" "), dtype=object)
        step = np.zeros(len(parts) + 1, dtype=np.int32)
        np.add.at(step, low, 1)
        np.add.at(step, high, -1)
        out.append(" ".join(parts[np.cumsum(step[:-1]) == 0].tolist()))
    return pd.Series(out, dtype=object)


def collapsed(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, ``runs`` (start, length, period; by start, then period), ``collapsed``
    (the words without those that any run repeats, joined by spaces; null where there is no run: the text stays as it
    is) and ``collapsed_sha256`` (of the words that stay, in either case)."""
    scan = scanned(docs)
    each = runs_of(scan).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    texts = scan.filter(F.col("tile").isNull())
    columns = ["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"]
    none = texts.filter("words IS NULL").select("doc_id", "n_words", F.array().cast(each.schema["runs"].dataType).alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("words_sha256").alias("collapsed_sha256"))
    some = texts.filter("words IS NOT NULL").select(*KEYS, "n_words", "words")
    some = some.join(each, _same_document(some, each), "left").select(some["doc_id"], "n_words", "words", F.coalesce("runs", F.array().cast(each.schema["runs"].dataType)).alias("runs"))
    lows, highs = F.transform("runs", lambda r: r["start"] + r["period"]), F.transform("runs", lambda r: r["start"] + r["length"])
    some = some.withColumn("collapsed", F.when(F.size("runs") > 0, F.pandas_udf(_without, "string")("words", lows, highs)))
    some = some.withColumn("collapsed_sha256", F.sha2(F.coalesce("collapsed", "words").cast("binary"), 256))
    return some.select(*columns).unionByName(none)


def period_digest(docs: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: smallest start, then period; else nulls), and digests of all runs and of the words
    that stay."""
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    top = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    out = collapsed(docs).withColumn("top", top).withColumn("said", F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.n")).alias("length"), F.col("top.period").alias("period"),
        F.floor(-1000 * F.col("top.n") / F.col("top.period")).cast("long").alias("exponent_milli"), F.sha2(F.col("said").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256",
    )


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) of which one in ten (by the CRC of its id) gets a periodic tail made of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    chosen = chosen.withColumns({"n": n, "g": g}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", at(i).cast("int"))), " ")
    return chosen.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), tail).otherwise(F.col("text")).alias("text"))
