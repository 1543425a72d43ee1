"""Near-duplicate detection with HyperMinHash sketches.

1. Each text becomes its set of 5-word shingles and a sketch: in each of 128 buckets the smallest hash, compressed
   to its count of leading zeros (6 bits) and the 10 bits after the first one.
2. Equal sets collapse to one representative, so that copies cost nothing from here on.
3. Bands of 4 compressed registers (empty ones filled from a fixed order of other buckets) put representatives in
   common buckets; 32 bands find a pair of similarity 0.75 with probability 1 - 5e-6.
4. Within a bucket the smallest document is compared with each other one; what the collision-corrected Jaccard
   estimate leaves is verified on full sets: first one partner for each document, then the rest between different
   components.
5. Buckets that still hold several components compare their documents in blocks, across components only: first by
   sketches alone, which leaves the documents that have a likely partner, then those on full sets and by falling
   estimate, until a link has joined two components or every pair has been tried.  So no link that a bucket can show is
   lost, and no group of copies is expanded into rows for its pairs.
6. Components come from min-label propagation with pointer jumping over the verified links, in Spark.

Defined cases: null, empty and wordless texts have an empty set and link with nothing; a text of fewer than 5 words
is one shingle; very long texts are hashed whole, in parts; rows that share a doc_id are one document: what any of
their texts links with is in one component with all of them, n_shingles is each row's own; a null doc_id takes no part
(component null, kept); an empty table gives no rows; other columns stay out of the way, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import BROADCAST_ROWS, small, whole_row, written
from pagemill.llm.hashing import shingles, word_hashes

#: Buckets of a sketch (a power of two), and bits kept after the leading one.
BUCKET_BITS, MANTISSA = 7, 10
BUCKETS = 1 << BUCKET_BITS
EMPTY = np.uint16(0xFFFF)
#: Registers in a band.
ROWS = 4
BANDS = BUCKETS // ROWS
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Estimates this many standard errors below the threshold are dropped unverified.
SIGMAS = 4.5
#: Documents in a block when a bucket is compared across components, by sketches and by full sets.
WIDE, BLOCK = 768, 256
#: Pairs with one document that are worked on together at most; more are dealt out.
PART = 4096


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of compressed registers for each ascending array of 64-bit hashes; bucket: the top bits."""
    bounds = np.arange(BUCKETS + 1, dtype=object) << (64 - BUCKET_BITS)
    bounds = np.array([int(b) for b in bounds[:-1]], dtype=np.uint64)
    low = np.zeros((len(sets), BUCKETS), dtype=np.uint64)
    full = np.zeros((len(sets), BUCKETS), dtype=bool)
    for k, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, bounds)
            end = np.append(at[1:], len(s))
            has = at < end
            full[k] = has
            low[k, has] = s[at[has]]
    low = (low << np.uint64(BUCKET_BITS)) >> np.uint64(12)  # the next 52 bits, exact as doubles
    mantissa, exponent = np.frexp(low.astype(np.float64))
    zeros = np.where(low > 0, 52 - exponent, 53)
    bits = np.where(low > 0, np.floor((2 * mantissa - 1) * (1 << MANTISSA)), 0)
    return np.where(full, (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | bits.astype(np.uint16), EMPTY).astype(np.uint16)


def _orders() -> np.ndarray:
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(BUCKETS) for _ in range(BUCKETS)])


def filled(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the first filled bucket in their own fixed order."""
    out, orders = regs.copy(), _orders()
    rows = np.nonzero((regs == EMPTY).any(axis=1) & (regs != EMPTY).any(axis=1))[0]
    for step in range(BUCKETS):
        if not len(rows):
            break
        now = out[rows]
        now = np.where(now == EMPTY, regs[rows][:, orders[:, step]], now)
        out[rows] = now
        rows = rows[(now == EMPTY).any(axis=1)]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys for each row of filled registers."""
    wide = filled(regs).reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = (key ^ wide[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def accidents(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Chance that the registers of a bucket that both sets fill are equal although their smallest hashes differ."""
    la, lb = np.maximum(na / BUCKETS, 1), np.maximum(nb / BUCKETS, 1)  # a filled bucket has one hash at least
    s, chance = la + lb - 1, np.zeros(len(la))
    for i in range(40):  # cells of one leading-zero count are equally wide
        low, high = 2.0 ** -(i + 1), 2.0**-i
        chance += low / (1 << MANTISSA) * la * lb * ((1 - low) ** s - (1 - high) ** s) / s
    return np.minimum(chance, 1)


def estimates(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of pairs of sketches, corrected for accidental equality of registers, and their cutoffs."""
    full_a, full_b = a != EMPTY, b != EMPTY
    both = (full_a & full_b).sum(axis=1)
    equal = ((a == b) & full_a).sum(axis=1)
    either = np.maximum((full_a | full_b).sum(axis=1), 1)
    t = PERCENT / 100
    cutoff = t - SIGMAS * np.sqrt(t * (1 - t) / either)
    est = equal / either
    near = np.nonzero(est >= cutoff)[0]  # the correction only lowers an estimate
    if len(near):
        wrong = accidents(na[near], nb[near]) * both[near]
        est[near] = np.clip((equal[near] - wrong) / np.maximum(either[near] - wrong, 1), 0, 1)
    return est, cutoff


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches: what is worked out for one is held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sketch_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        sets = [shingles(h) for h in word_hashes(batch.column(1).to_pylist(), lower=True)]
        ids = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64) for s in sets], dtype=np.int64).reshape(-1, 2)
        regs = registers(sets)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids[:, 0].copy()), pa.array(ids[:, 1].copy()), pa.array([r.tobytes() for r in regs], pa.binary())],
            names=["doc_id", "n", "s1", "s2", "sketch"],
        )


def _explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column("sketch")))
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(docs))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(docs, BANDS)), pa.array(band)], names=["key", "doc", "band"])


def _matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            n = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
            est, cutoff = estimates(_matrix(batch.column("ska")), _matrix(batch.column("skb")), n("na"), n("nb"))
            keep = pa.array(est >= cutoff)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(est).filter(keep)], names=["a", "b", "est"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        sets = [shingles(h).tobytes() for h in word_hashes(batch.column(1).to_pylist(), lower=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc", "hashes"])


def _link(p: np.ndarray, q: np.ndarray) -> bool:
    """Do two ascending sets link?"""
    if len(p) > len(q):
        p, q = q, p
    if not len(p):
        return False
    at = np.searchsorted(q, p)
    at[at == len(q)] = 0
    common = int((q[at] == p).sum())
    return 100 * common >= PERCENT * (len(p) + len(q) - common)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = ([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(c)] for c in ("x", "y"))
        keep = pa.array([_link(p, q) for p, q in zip(*sets, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _candidates(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Likely pairs between components of a block pair: their rows and estimates. Pairs that share an earlier band are met there."""
    col = {c: rows.column(c).to_numpy() for c in ("label", "n", "block", "i", "j", "band")}
    regs = _matrix(rows.column("sketch").combine_chunks())
    keys, band = band_keys(regs), int(col["band"][0])
    first = np.nonzero(col["block"] == col["i"])[0]
    second = first if col["i"][0] == col["j"][0] else np.nonzero(col["block"] == col["j"])[0]
    n, label = col["n"].astype(np.float64), col["label"]
    may = label[first][:, None] != label[second][None, :]
    if second is first:
        may &= np.triu(np.ones(may.shape, dtype=bool), 1)
    few, many = np.minimum(n[first][:, None], n[second][None, :]), np.maximum(n[first][:, None], n[second][None, :])
    may &= 100 * few >= PERCENT * many
    for k in range(band):
        may &= keys[first, k][:, None] != keys[second, k][None, :]
    ps, qs = (side[at] for side, at in zip((first, second), np.nonzero(may), strict=True))
    parts = [np.empty(0)]
    for at in range(0, len(ps), 8192):
        p, q = ps[at : at + 8192], qs[at : at + 8192]
        est, cutoff = estimates(regs[p], regs[q], n[p], n[q])
        parts.append(np.where(est >= cutoff, est, -1.0))
    est = np.concatenate(parts)
    return ps[est >= 0], qs[est >= 0], est[est >= 0]


def _block_live(rows: pa.Table) -> pa.RecordBatch | None:
    """The documents of a block pair that have a likely partner."""
    ps, qs, _ = _candidates(rows)
    at = np.unique(np.concatenate((ps, qs)))
    return pa.RecordBatch.from_arrays([pa.array(rows.column(c).to_numpy()[at]) for c in ("key", "doc")], names=["key", "doc"]) if len(at) else None


def _block_links(rows: pa.Table) -> pa.RecordBatch | None:
    """Links between documents of a block pair, as many as join what can be joined.

    Pairs in different components come by falling estimate; a pair whose components a link has joined meanwhile has
    nothing to add.
    """
    ps, qs, est = _candidates(rows)
    if not len(ps):
        return None
    doc, label = rows.column("doc").to_numpy(), rows.column("label").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("hashes")]
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while x in top:
            x = top[x]
        return x

    a, b = [], []
    for k in np.argsort(-est, kind="stable"):
        p, q = ps[k], qs[k]
        x, y = root(int(label[p])), root(int(label[q]))
        if x != y and _link(sets[p], sets[q]):
            top[max(x, y)] = min(x, y)
            a.append(min(doc[p], doc[q]))
            b.append(max(doc[p], doc[q]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]) if a else None


def _by_block_pair(work: Callable[[pa.Table], pa.RecordBatch | None]):
    """Rows sorted by (key, i, j), a block pair after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = work(pa.concat_tables(held))
                held.clear()
                if out is not None:
                    yield out

        last = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            ids = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], axis=1)
            starts = np.nonzero((ids[1:] != ids[:-1]).any(axis=1))[0] + 1
            for s, e in zip([0, *starts], [*starts, len(ids)], strict=True):
                if s < e:
                    if last is not None and tuple(ids[s]) != last:
                        yield from flush()
                    held.append(rows.slice(s, e - s))
                    last = tuple(ids[s])
        yield from flush()

    return run


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), s1, s2 (128-bit hash of the set), sketch; one row for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_sketch_texts, "doc_id long, n long, s1 long, s2 long, sketch binary")


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b. Returns doc, label: the smallest document reachable. Only linked documents appear."""
    both = written(links.select("a", "b").union(links.select("b", "a")), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("doc")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc")
    few = labels.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # as many rows in every round
    side = F.broadcast if few else lambda df: df
    while True:
        near = both.join(side(labels.withColumnRenamed("doc", "b")), "b").groupBy(F.col("a").alias("doc")).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("doc").alias("label"), F.col("label").alias("far"))
        step = near.join(side(labels), "doc").join(side(jump), "label", "left")
        step = written(step.select("doc", F.least("near", "label", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")), "cc")
        labels = step.select("doc", "label")
        if step.filter("moved").isEmpty():
            return labels


def _dealt(pairs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``pairs`` (a, b) with ``part``, so that one ``a`` of very many pairs is several tasks' work, and a function that
    gives rows named by ``a`` a copy for each of its parts."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).filter("parts > 1")
    many = small(written(many, "dup-parts"))
    of = F.coalesce("parts", F.lit(1))
    dealt = pairs.join(many, "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), of).cast("int")).drop("parts")
    return dealt, lambda rows: rows.join(many, "a", "left").withColumn("part", F.explode(F.sequence(F.lit(0), of - 1))).drop("parts")


def _with_sketches(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    a = reps.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ska"))
    b = reps.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("skb"))
    close = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    pairs, copied = _dealt(pairs)
    return pairs.join(copied(a), ["a", "part"]).join(b, "b").filter(close).select("a", "b", "na", "nb", "ska", "skb")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, hashes: the full shingle sets of the documents in ``wanted`` (doc)."""
    wanted = written(wanted.distinct(), "dup-wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("binary").alias("text")).join(small(wanted), "doc")
    return written(texts.mapInArrow(_full_sets, "doc long, hashes binary"), "dup-sets")


def _verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link by their full shingle sets."""
    sets = _sets(docs, pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))))
    one, two = sets.select(F.col("doc").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("doc").alias("b"), F.col("hashes").alias("y"))
    dealt, copied = _dealt(pairs.select("a", "b"))
    checked = copied(one).join(small(dealt), ["a", "part"]).join(two, "b").select("a", "b", "x", "y").mapInArrow(_verified, "a long, b long")
    return written(checked.distinct(), "dup-links")


def link(docs: DataFrame, rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Labels (doc, label) of the representatives of equal sets that link with another one, or that ``known`` (a, b) links."""
    reps = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = written(reps.select("doc_id", "n", "sketch"), "dup-reps")
    bands = written(reps.select("doc_id", "sketch").mapInArrow(_explode_bands, "key long, doc long, band int"), "dup-bands")
    buckets = bands.groupBy("key").agg(F.min("doc").alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(bands.join(buckets, "key"), "dup-shared")

    stars = written(shared.filter("doc != pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct(), "dup-stars")
    likely = written(_with_sketches(stars, reps).mapInArrow(_likely, "a long, b long, est double"), "dup-likely")
    best = written(likely.groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a")).select("a", "b"), "dup-best")
    links = _verify(docs, best)
    labels = components(links.union(known) if known is not None else links)

    rest = written(_labelled(likely.join(best, ["a", "b"], "left_anti"), labels).select("a", "b"), "dup-rest")
    if not rest.isEmpty():
        labels = _joined(labels, _verify(docs, rest))
    # Buckets of three or more in several components: all but the pivot's pairs are still to be compared.
    return _joined(labels, _cross(docs, shared, labels, reps))


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` whose documents lie in different components, with these (la below lb)."""
    la, lb = (labels.select(F.col("doc").alias(x), F.col("label").alias(f"l{x}")) for x in ("a", "b"))
    out = pairs.join(small(la), "a", "left").join(small(lb), "b", "left")
    out = out.withColumn("x", F.coalesce("la", "a")).withColumn("y", F.coalesce("lb", "b")).filter("x != y")
    return out.drop("la", "lb").withColumn("la", F.least("x", "y")).withColumn("lb", F.greatest("x", "y")).drop("x", "y")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after components that ``links`` connect are one; a component counts as one node, however large."""
    if links.isEmpty():
        return labels
    between = _labelled(links, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    merged = components(between).select(F.col("doc").alias("old"), F.col("label").alias("new"))
    moved = labels.join(small(merged), F.col("label") == F.col("old"), "left").select("doc", F.coalesce("new", "label").alias("label"))
    # Documents that were alone so far are their own labels.
    fresh = merged.join(small(labels.select(F.col("doc").alias("known"))), F.col("old") == F.col("known"), "left_anti").select(F.col("old").alias("doc"), F.col("new").alias("label"))
    return written(moved.union(fresh), "dup-labels")


def _in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (key, doc, label, ...) once for each pair of blocks of their key that they belong to.

    The component with most documents of a key has blocks of its own, which are not paired with each other: a large
    group of copies that link is dealt once for each block of other documents, not for each block of itself.
    """
    counts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    most = F.max_by(F.struct("label", "n"), F.struct("n", -F.col("label")))
    sizes = counts.groupBy("key").agg(most.alias("most"), F.sum("n").alias("all"))
    in_blocks = lambda n: F.ceil(n / size).cast("int")
    sizes = sizes.select("key", F.col("most.label").alias("_most"), in_blocks(F.col("most.n")).alias("_own"), in_blocks(F.col("all") - F.col("most.n")).alias("_rest")).filter("_rest > 0")
    at, h = rows.join(small(written(sizes, "dup-sizes")), "key"), F.xxhash64("doc")
    own = F.col("label") == F.col("_most")
    at = at.withColumn("block", F.when(own, F.col("_rest") + F.pmod(h, F.col("_own"))).otherwise(F.pmod(h, F.col("_rest"))).cast("int"))
    blocks = F.when(own, F.col("_rest")).otherwise(F.col("_rest") + F.col("_own"))
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    at = at.withColumn("p", F.explode(others)).select(*rows.columns, "block", "p.i", "p.j")
    return at.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _cross(docs: DataFrame, shared: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between components within buckets, found block by block."""
    at = shared.filter("members > 2").join(small(labels), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    at = written(at.select("key", "doc", "band", "label"), "dup-at")
    mixed_ = at.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("key")
    open_ = at.join(small(mixed_), "key").join(reps.select(F.col("doc_id").alias("doc"), "n", "sketch"), "doc")
    open_ = written(open_.select("key", "doc", "band", "label", "n", "sketch"), "dup-open")
    live = written(_in_blocks(open_, WIDE).mapInArrow(_by_block_pair(_block_live), "key long, doc long").distinct(), "dup-live")
    if live.isEmpty():
        return live.select(F.col("doc").alias("a"), F.col("doc").alias("b"))
    rows = open_.join(small(live), ["key", "doc"]).join(_sets(docs, live.select("doc")), "doc")
    return written(_in_blocks(rows, BLOCK).mapInArrow(_by_block_pair(_block_links), "a long, b long"), "dup-cross")


def _shared_ids(rows: DataFrame) -> DataFrame:
    """doc_id, n, s1, s2 of the rows whose doc_id has several different sets."""
    differ = [f"{f}({c})" for c in ("s1", "s2") for f in ("min", "max")]
    ids = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*map(F.expr, differ)).filter(f"`{differ[0]}` != `{differ[1]}` OR `{differ[2]}` != `{differ[3]}`")
    return written(rows.join(small(written(ids.select("doc_id"), "dup-ids")), "doc_id").select("doc_id", "n", "s1", "s2"), "dup-shared-ids")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for each row of ``docs`` (doc_id, text)."""
    rows = written(sketches(docs), "dup-sketches")
    sets = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    several = _shared_ids(rows)
    alone = several.isEmpty()
    known = None if alone else several.filter("n > 0").join(sets, ["s1", "s2"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    labels = link(docs, rows, known).withColumnRenamed("doc", "rep")
    named = sets.join(labels, "rep", "left").filter("copies > 1 OR label IS NOT NULL")
    named = written(named.select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.coalesce("label", "rep").alias("component")), "dup-components")

    def with_component(some: DataFrame) -> DataFrame:
        return some.join(small(named), (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")) & (F.col("n") > 0), "left")

    out = with_component(rows).withColumn("component", F.coalesce("component", "doc_id"))
    if not alone:  # all rows of such an id, those without words too
        ids = with_component(several).groupBy(F.col("doc_id").alias("id")).agg(F.min(F.coalesce("component", "doc_id")).alias("common"))
        out = out.join(small(written(ids, "dup-common")), F.col("doc_id") == F.col("id"), "left").withColumn("component", F.coalesce("common", "component"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the one with the smallest doc_id.

    Rows with a null doc_id stay; of rows that share a doc_id and stay, one does.  The columns stay, whatever their names.
    """
    found = written(near_duplicates(docs), "dup-found")
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    rows = docs.select(whole_row(docs).alias("row"), docs["doc_id"].cast("long").alias("doc_id"))
    out = rows.join(small(gone), "doc_id", "left_anti")
    twice = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    twice = written(twice, "dup-twice")
    if not twice.isEmpty():
        # Rows that share an id are rare; only they are gathered by it.
        several = out.join(small(twice), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("row", F.struct("row.text", F.xxhash64("row"))).alias("row"))
        out = out.join(small(twice), "doc_id", "left_anti").unionByName(several)
    return out.select("row.*")
