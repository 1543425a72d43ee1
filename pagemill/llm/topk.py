"""Exact top-k search by three-phase uniform thresholds.

A score is the sum of the inner products over SLICES ranges of the dimensions: SLICES score lists.
Phase 1 gathers score lists from every block: the best totals among every GATHER-th of its rows.  The k-th best of them
for a query, t, is a safe cutoff: k candidates reach it.  Phase 2 sends each query's t back to all blocks.  By the
uniform threshold, what reaches t in sum must reach t / SLICES in some list, so a query passes over the blocks whose
norms keep every list below that.  Elsewhere lists are added up, and a pair is collected only if its sum and the most that its other lists can add (the
product of the norms) reach t.  As soon as a query's collected pairs are few, phase 3 resolves them alone, list by
list, dropping them when their bound falls below t; each block returns its k best that reach t, with exact scores.

Queries and candidates meet in blocks of bounded size, as matrices; no list is longer than a block.  Blocks hold rows of
similar norms, so that whole blocks can be passed over.

Defined cases: null vectors and those with null or non-finite components take no part; vectors of different lengths
are not compared; of rows with one vec_id the one whose vector is smallest (by its components in order) counts; a vec_id
may be of any integer type; a null one takes no part; a component or a score that 64 bits can't hold makes the job fail; ties go to the smaller vec_id, and no tie is lost; a vector is whole in one row of a block,
however long; an empty table gives no rows; other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.scratch import written

SLICES = 8
#: Phase 1 looks at one row in so many.
GATHER = 8
#: Share of a block up to which a query's collected pairs are resolved alone, and not with the whole block.
DENSE = 0.02
#: Rows of a block of candidates, and of queries.
BLOCK, QUERY_BLOCK = 4096, 512
#: Components are floor(SCALE * x); neither they nor scores may reach MOST, a little less than what a long holds.
SCALE, MOST = 256, 2.0**62.999
_BLOCKS = "dim int, ids binary, rows binary"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id (long), v (array of long): the vectors that take part."""
    # NaN and infinities are what x - x = 0 leaves out.
    named = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    finite = named.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(x - x == F.lit(0), F.lit(False))))
    scaled = lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")
    fits = F.forall("embedding", lambda x: F.abs(x.cast("double")) * SCALE < MOST)
    refuse = F.raise_error(F.lit("a vector's components exceed 64 bits")).cast("array<bigint>")
    return finite.select("vec_id", F.when(fits, F.transform("embedding", scaled)).otherwise(refuse).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _to_blocks(size: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = held.pop(dim)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([np.concatenate(rows).tobytes()], pa.binary())], names=["dim", "ids", "rows"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(lengths)))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                mine = np.nonzero(lengths == dim)[0]
                for part in np.array_split(mine, -(-len(mine) // size)):
                    one, many = held.setdefault(int(dim), ([], []))
                    one.append(ids[part])
                    many.append(flat[(starts[part][:, None] + np.arange(dim)).ravel()])
                    if sum(map(len, one)) >= size:
                        yield block(int(dim))
        for dim in list(held):
            yield block(dim)

    return blocks


@dataclass
class Scored:
    """Pairs of a block with their exact scores, and how many of its (pair, list) products were computed."""

    i: np.ndarray
    j: np.ndarray
    score: np.ndarray
    products: int


def _kind(q: np.ndarray, c: np.ndarray) -> type:
    """Doubles where they are exact."""
    return np.float64 if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2.0**53 else np.int64


def _norms(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.sqrt((x[:, s].astype(np.float64) ** 2).sum(axis=1)) for s in cuts], axis=1)


def reaching(q: np.ndarray, c: np.ndarray, cut: np.ndarray) -> Scored:
    """All pairs of a query and a candidate that reach the query's cutoff; pairs that cannot are dropped on the way."""
    cuts = np.array_split(np.arange(q.shape[1]), min(SLICES, max(q.shape[1], 1)))
    kind, m = _kind(q, c), len(cuts)
    qn, cn = _norms(q, cuts), _norms(c, cuts)
    # Norms are rounded, and so are sums beyond 2 ** 53.
    slack = 1 + 1e-9 * float((qn.max(axis=0, initial=0) * cn.max(axis=0, initial=0)).sum())
    least = cut - slack
    rows = np.nonzero((qn * cn.max(axis=0, initial=0) >= least[:, None] / m).any(axis=1))[0]
    q, c, least, qn = q.astype(kind)[rows], c.astype(kind), least[rows], qn[rows]
    rest = lambda n, at: np.sqrt((n[:, at:] ** 2).sum(axis=1))
    at = -(-m // 2)
    head = np.concatenate(cuts[:at])
    total = q[:, head] @ c[:, head].T
    products = total.size * at
    live, out = np.arange(len(rows)), []
    while len(live):
        collected = total + np.outer(rest(qn[live], at), rest(cn, at)) >= least[live, None]
        few = collected.sum(axis=1) <= (DENSE * len(c) if at < m else len(c))
        i, j = np.nonzero(collected & few[:, None])
        i, score = live[i], total[i, j]
        live, total = live[~few], total[~few]
        for late in range(at, m):
            step = cuts[late]
            for lo in range(0, len(i), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                score[part] += np.einsum("ij,ij->i", q[i[part]][:, step], c[j[part]][:, step])
            products += len(i)
            keep = score + rest(qn, late + 1)[i] * rest(cn, late + 1)[j] >= least[i]
            i, j, score = i[keep], j[keep], score[keep]
        out.append((rows[i], j, score.astype(np.int64)))
        if len(live):
            total += q[live][:, cuts[at]] @ c[:, cuts[at]].T
            products, at = products + total.size, at + 1
    i, j, score = (np.concatenate([o[k] for o in out] or [np.empty(0, dtype=np.int64)]) for k in range(3))
    keep = score >= cut[i]
    return Scored(i[keep], j[keep], score[keep], products)


def _pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    array = lambda b: np.frombuffer(b, dtype=np.int64)
    q, c = array(row["q_ids"]), array(row["ids"])
    return q, c, array(row["q_rows"]).reshape(len(q), row["dim"]), array(row["rows"]).reshape(len(c), row["dim"])


def _refuse_overflow(q: np.ndarray, c: np.ndarray, qm: np.ndarray, cm: np.ndarray) -> None:
    """Sums of longs would wrap unsaid."""
    q_all, c_all = _norms(qm, [np.arange(qm.shape[1])]), _norms(cm, [np.arange(cm.shape[1])])
    if q_all.max(initial=0) * c_all.max(initial=0) >= MOST:
        over = np.abs(qm.astype(np.float64) @ cm.astype(np.float64).T) >= MOST
        if (over & (q[:, None] != c)).any():
            raise OverflowError("a score exceeds 64 bits")


def _alike(batch: pa.RecordBatch) -> list[dict]:
    return [row for row in batch.to_pylist() if row["dim"] == row["q_dim"]]


#: No cutoff; far enough from the least long to be reckoned with.
_LEAST = -(1 << 62)


def _gather(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _alike(batch):
                q, c, qm, cm = _pair(row)
                step = GATHER if len(c) >= GATHER * (k + 1) else 1
                kind = _kind(qm, cm)
                total = (qm.astype(kind) @ cm[::step].astype(kind).T).astype(np.int64)
                total[q[:, None] == c[None, ::step]] = _LEAST
                most = min(k, total.shape[1])
                top = np.partition(total, -most, axis=1)[:, -most:]
                i, j = np.nonzero(top > _LEAST)
                yield pa.RecordBatch.from_arrays([pa.array(q[i]), pa.array(top[i, j])], names=["query_id", "score"])

    return run


def _resolve(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _alike(batch):
                q, c, qm, cm = _pair(row)
                _refuse_overflow(q, c, qm, cm)
                known = dict(zip(row["cut_ids"] or [], row["cuts"] or [], strict=True))
                found = reaching(qm, cm, np.array([known.get(x, _LEAST) for x in q.tolist()], dtype=np.int64))
                other = q[found.i] != c[found.j]
                i, j, score = found.i[other], found.j[other], found.score[other]
                order = np.lexsort((c[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                first = np.searchsorted(i, i)  # where the query's entries begin
                keep = np.arange(len(i)) - first < k
                yield pa.RecordBatch.from_arrays([pa.array(q[i[keep]]), pa.array(c[j[keep]]), pa.array(score[keep])], names=["query_id", "vec_id", "score"])

    return run


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score of its k best."""
    vectors = written(integer_vectors(embeddings), "topk-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    by_norm = vectors.withColumn("norm", norm).sortWithinPartitions("norm").select("vec_id", "v")
    blocks = written(by_norm.mapInArrow(_to_blocks(BLOCK), _BLOCKS), "topk-blocks")
    queries = vectors.filter(F.col("vec_id") % every == 0)
    parts = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.repartition(parts, "vec_id").mapInArrow(_to_blocks(QUERY_BLOCK), _BLOCKS)
    queries = written(queries.select("dim", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.xxhash64("ids", "dim").alias("block")), "topk-queries")

    def meet(q: DataFrame) -> DataFrame:
        # Tasks pass over pairs of different dimensions: as a join key, one dimension would make one task of it all.
        return blocks.crossJoin(q.withColumnRenamed("dim", "q_dim"))

    local = meet(queries).select("dim", "q_dim", "ids", "rows", "q_ids", "q_rows").mapInArrow(_gather(k), "query_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc())
    cutoffs = local.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).filter(F.col("at") == k)
    cutoffs = written(cutoffs.select("query_id", "score"), "topk-cutoffs")
    # Which block a query is in: from its rows, not through the driver.
    members = queries.select("block", "q_ids").mapInArrow(_members, "block long, query_id long")
    cuts = members.join(cutoffs, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "score")).alias("c"))
    ready = written(queries.join(cuts, "block", "left").select("dim", "q_ids", "q_rows", F.col("c.query_id").alias("cut_ids"), F.col("c.score").alias("cuts")), "topk-ready")
    found = meet(ready).select("dim", "q_dim", "ids", "rows", "q_ids", "q_rows", "cut_ids", "cuts").mapInArrow(_resolve(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["q_ids"], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["block"])), pa.array(ids)], names=["block", "query_id"])
