"""Patches of a partitioned table: only partitions that change are written again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ranking import last_by
from pagemill.operators.versions import small
from pagemill.scratch import written


#: Rows of a partition that one task writes, about.
TASK_ROWS = 1_000_000


def settled(news: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row of ``news`` for each of the keys: the last in ``order``.  Without an order, a key with different values is refused."""
    if order:
        return last_by(news.select(*keys, *order, *(c for c in columns if c not in order)), keys, order).select(*keys, *columns)
    each = news.groupBy(*keys).agg(F.count_distinct(F.struct(*columns)).alias("_n"), F.first(F.struct(*columns)).alias("_r"))
    refuse = F.raise_error(F.concat(F.lit("several values for the key "), F.to_json(F.struct(*keys)))).cast(each.schema["_r"].dataType)
    one = F.when(F.col("_n") > 1, refuse).otherwise(F.col("_r"))
    return each.withColumn("_r", one).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in columns))


def changed(rows: DataFrame, news: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the values of ``news`` (keys, columns) where it has any that aren't blank, and ``changed``; ``order``:
    what tells which of several rows of a key in ``news`` counts."""
    news = settled(news, keys, columns, order)
    new = news.select(*keys, *(F.nullif(F.col(c).cast("string"), F.lit("")).cast(rows.schema[c].dataType).alias(f"_{c}") for c in columns))
    out = rows.join(new, list(keys), "left").withColumns({c: F.coalesce(f"_{c}", F.col(c)) for c in columns} | {f"_was_{c}": F.col(c) for c in columns})
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    return out.withColumn("changed", differs).select(*rows.columns, "changed")


def patch(spark: SparkSession, path: str, news: DataFrame, keys: Sequence[str], columns: Sequence[str], partition: str, dry_run: bool = False, order: Sequence[str] = (), task_rows: int = TASK_ROWS, schema: str | None = None) -> int:
    """Patch the table at ``path`` in place; returns how many rows change (only counted if ``dry_run``).

    A table can't be written while it is read: changed partitions are written beside it first, then put in place of the
    old ones, each as a whole.  A run that is repeated after a failure finds the rest.  A large partition is written by
    many tasks, about ``task_rows`` rows each.  ``schema``: the table's, where it may hold no files yet.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    rows = changed(reader.parquet(path), news, keys, columns, order)
    touched = rows.groupBy(partition).agg(F.count_if("changed").alias("n"), F.ceil(F.count(F.lit(1)) / task_rows).alias("_tasks"))
    touched = written(touched.filter("n > 0"), "touched")
    n = touched.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    if n and not dry_run:
        of = touched.select(F.col(partition).alias("_of"), "_tasks")
        beside = written(rows.join(small(of), rows[partition].eqNullSafe(of["_of"])).drop("changed", "_of"), "patched")
        dealt = beside.withColumn("_task", F.pmod(F.xxhash64(*keys), F.col("_tasks")))
        dealt.repartition(partition, "_task").drop("_task", "_tasks").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return n
