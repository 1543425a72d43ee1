"""Positional operators: numbering, first and last rows, samples, tiers, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.scratch import written


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark limits each task's groups before the shuffle."""
    return numbered(df, by, order, name).filter(F.col(name) <= k)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the one that is last in order (partial aggregation, no sort of groups)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *(c for c in rest if c not in order))).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` replace those of ``current`` with their keys."""
    return current.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)


def insert_missing(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose keys are not there yet are added."""
    return current.unionByName(new.join(current.select(*keys), list(keys), "left_anti"))


def numbered_spread(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """``numbered``, for groups too large for a task: rows are sorted by ranges, numbered in each range, and moved on by
    what the group's earlier ranges hold."""
    keys = [*by, *order]
    part = written(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = part.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_count"))  # a row for each group and range at most
    before = counts.withColumn("_before", F.sum("_count").over(W.partitionBy(*by).orderBy("_part")) - F.col("_count")).drop("_count")
    local = part.withColumn(name, F.row_number().over(W.partitionBy(*by, "_part").orderBy(*order)))
    return local.join(before, [*by, "_part"]).withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)


def first_middle_last(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows 0, n // 2 and n - 1 of each group."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    at = numbered_spread(df, by, order, "_n").join(sizes, list(by)).withColumn("_at", F.col("_n") - 1)
    picked = (F.col("_at") == 0) | (F.col("_at") == F.floor(F.col("_size") / 2)) | (F.col("_at") == F.col("_size") - 1)
    return at.filter(picked).select(*df.columns)


def in_shards(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``df`` with ``shard``: rows in order, ``size`` to a shard."""
    all_ = df.withColumn("_all", F.lit(0))
    return numbered_spread(all_, ["_all"], order, "_n").withColumn("shard", F.floor((F.col("_n") - 1) / size).cast("int")).drop("_all", "_n")


def tiered(df: DataFrame, by: Sequence[str], tiers: Sequence[Column], order: Sequence[Column], k: int) -> DataFrame:
    """At most ``k`` rows of each group, by the first tier whose condition holds, then in order; the last tier is the rest."""
    tier = F.coalesce(*(F.when(t, i) for i, t in enumerate(tiers)), F.lit(len(tiers)))
    return top_per_group(df.withColumn("tier", tier), by, [F.col("tier"), *order], k)


def fused(lists: Sequence[DataFrame], by: Sequence[str], key: str, k: int, damping: int = 60) -> DataFrame:
    """Reciprocal rank fusion of ranked lists (by, key, rank): the ``k`` best sums of 1 / (damping + rank).

    Ties go to the better rank in the first list, then in the next, then to the smaller key.
    """
    far = 1 << 30
    parts = [df.select(*by, key, F.lit(i).alias("_list"), F.col("rank").alias("_rank")) for i, df in enumerate(lists)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    ranks = [F.min(F.when(F.col("_list") == i, F.col("_rank"))).alias(f"_r{i}") for i in range(len(lists))]
    sums = both.groupBy(*by, key).agg(*ranks)
    score = sum((F.coalesce(F.lit(1.0) / (F.lit(damping) + F.col(f"_r{i}")), F.lit(0.0)) for i in range(len(lists))), F.lit(0.0))
    order = [F.col("score").desc(), *(F.coalesce(f"_r{i}", F.lit(far)) for i in range(len(lists))), F.col(key)]
    out = top_per_group(sums.withColumn("score", score), by, order, k)
    return out.select(*by, key, "score", "rank")
