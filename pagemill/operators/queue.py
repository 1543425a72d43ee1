"""A work queue as a table: each change is a function from the queue to its next state.

Columns: name, status (pending, processing, completed, failed), pages, error, attempts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.ranking import first_middle_last, insert_missing

STATUSES = ("pending", "processing", "completed", "failed")


def enqueue(queue: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches that the queue doesn't hold yet, as pending."""
    none = lambda t: F.lit(None).cast(t)
    fresh = batches.select("name", F.lit("pending").alias("status"), none("long").alias("pages"), none("string").alias("error"), F.lit(0).alias("attempts"))
    return insert_missing(queue, fresh.distinct(), ["name"])


def _set(queue: DataFrame, which: Column, **to) -> DataFrame:
    return queue.withColumns({c: F.when(which, v).otherwise(F.col(c)) for c, v in to.items()})


def start(queue: DataFrame, which: Column) -> DataFrame:
    return _set(queue, which, status=F.lit("processing"), attempts=F.coalesce("attempts", F.lit(0)) + 1, error=F.lit(None).cast("string"))


def complete(queue: DataFrame, which: Column, pages: Column) -> DataFrame:
    return _set(queue, which, status=F.lit("completed"), pages=pages)


def fail(queue: DataFrame, which: Column, error: Column) -> DataFrame:
    return _set(queue, which, status=F.lit("failed"), error=error)


def recover(queue: DataFrame, most_attempts: int) -> DataFrame:
    """After a crash: what was processing fails if its attempts are used up, else it is pending again."""
    was = F.col("status") == "processing"
    used = F.coalesce("attempts", F.lit(0)) >= most_attempts
    return queue.withColumn("status", F.when(was & used, "failed").when(was, "pending").otherwise(F.col("status")))


def retry(queue: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Failed entries, of ``among`` if given, are pending with no attempts."""
    if among is not None:
        queue = queue.join(among.select("name", F.lit(True).alias("_in")).distinct(), "name", "left")
    which = (F.col("status") == "failed") & (F.coalesce("_in", F.lit(False)) if among is not None else F.lit(True))
    return _set(queue, which, attempts=F.lit(0), status=F.lit("pending")).drop("_in")


def reset(queue: DataFrame, among: DataFrame | None = None, attempts: bool = True) -> DataFrame:
    """Every entry, of ``among`` if given, starts anew: pending, without pages or error; ``attempts``: with none made."""
    if among is not None:
        queue = queue.join(among.select("name", F.lit(True).alias("_in")).distinct(), "name", "left")
    which = F.coalesce("_in", F.lit(False)) if among is not None else F.lit(True)
    to = {"status": F.lit("pending"), "pages": F.lit(0).cast("long"), "error": F.lit(None).cast("string")} | ({"attempts": F.lit(0)} if attempts else {})
    return _set(queue, which, **to).drop("_in")


def pending(queue: DataFrame, batches: DataFrame, limit: int | None = None) -> DataFrame:
    """What is to be done, the smallest first, batches of unknown size before all; ``batches``: name, size_bytes."""
    todo = queue.filter(F.col("status") == "pending").join(batches, "name").orderBy(F.col("size_bytes").asc_nulls_first(), "name")
    return todo.limit(limit) if limit else todo


def already_done(issues: DataFrame, present: DataFrame, batch: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each batch whether its first, middle and last issue are present (``keys``: what names an issue)."""
    sample = first_middle_last(issues, [batch], order)
    there = sample.join(present.select(*keys, F.lit(True).alias("_there")).distinct(), list(keys), "left")
    return there.groupBy(batch).agg(F.bool_and(F.coalesce("_there", F.lit(False))).alias("done"))


def summary(queue: DataFrame) -> DataFrame:
    """One row: entries of each status, of all, and the pages extracted."""
    count = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return queue.agg(*count, F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages_extracted"))
