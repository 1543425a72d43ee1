"""Mixing sources to target weights by hash-threshold histograms.

Tokens are summed by source and hash bucket; in each source the bucket in which the budget runs out is found from
the running sums, and only that bucket is summed again by the next hash digit.  A document is in if its hash is
below its source's threshold: nothing is sorted, thresholds for smaller budgets nest in those for larger ones, and
reruns agree.  Each source's total is met to within one document (the nearer side of the last one).

Defined cases: a null text has size 0; null is a source of its own, last in order; documents of size 0 are taken
where their hash is below the threshold, at 0 words; rows equal in doc_id and text go in or out together; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.llm.common import small, whole_row, word_count
from pagemill.scratch import written

#: Bits of each histogram's hash digit, and the number of digits.
DIGIT, DIGITS = 12, 3
#: Weights of the sources by code point, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: A document is taken so often at most.
MOST = 3


def hash_key(*columns: str | Column) -> Column:
    """The leading DIGIT * DIGITS hash bits, as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - DIGIT * DIGITS)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes``: source, source_size, one row for each source. Adds ``target``.

    The total is shared by weight; what exceeds ``most`` times a source's size is reshared among the others until
    none is above.  That is a level L with target = min(most * size, L * weight) and targets adding up to the total;
    L follows from running sums in the order of most * size / weight.  The rows are per source, not per document.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * most)
    order, all_ = W.orderBy(F.col("cap") / F.col("weight"), "rank"), W.partitionBy()
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    level = (F.sum("source_size").over(all_) - (F.sum("cap").over(upto) - F.col("cap"))) / (F.sum("weight").over(all_) - (F.sum("weight").over(upto) - F.col("weight")))
    ranked = ranked.withColumn("level", level)
    final = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(all_)["level"]
    return ranked.select("source", "source_size", F.coalesce(F.least("cap", final * F.col("weight")), "cap").alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``rows``: source, size, u (hash key); ``budgets``: source, budget. Returns source, below: take what has u < below."""
    at = budgets.select(F.col("source").alias("s"), "budget", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("prefix"))
    for level in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - level)
        inside = rows.join(small(at), F.col("source").eqNullSafe(F.col("s")))
        if level:
            inside = inside.filter(F.shiftright("u", shift + DIGIT) == F.col("prefix"))
        sums = inside.groupBy("s", F.shiftright("u", shift).alias("cell")).agg(F.sum("size").alias("n"), F.first("budget").alias("budget"), F.first("before").alias("start"))
        run = F.col("start") + F.sum("n").over(W.partitionBy("s").orderBy("cell"))  # 2 ** DIGIT rows of a source at most
        sums = sums.withColumn("after", run).filter(F.col("after") > F.col("budget"))
        first = sums.groupBy("s").agg(F.min(F.struct("cell", "n", "after", "budget")).alias("x"))
        at = written(first.select("s", "x.budget", (F.col("x.after") - F.col("x.n")).alias("before"), F.col("x.cell").alias("prefix"), F.col("x.after").alias("after")), "mix-level")
        if level < DIGITS - 1:
            at = at.drop("after")
    nearer = (F.col("after") - F.col("budget")) < (F.col("budget") - F.col("before"))
    return at.select(F.col("s").alias("source"), (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("below"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """A narrow table (doc_id, source, size, u) and, for each source, source_size, target, times, below."""
    rows = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash_key("doc_id", "text").alias("u")), "mix-rows")
    want = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    want = want.withColumn("times", whole.cast("long"))
    below = thresholds(rows, want.select("source", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget")))
    below = below.select(F.col("source").alias("b"), "below")
    want = want.join(below, F.col("source").eqNullSafe(F.col("b")), "left").drop("b")
    return rows, want.withColumn("below", F.coalesce("below", F.lit(0)))


def copies(u: Column) -> Column:
    """How often the mix takes a document, given its source's plan."""
    return (F.col("times") + F.when(u < F.col("below"), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; the columns stay."""
    _, want = plan(docs, weights, most)
    want = want.select(F.col("source").alias("_s"), "times", "below")
    # Each text is hashed again here, rather than joined by doc_id, so that repeated ids can't multiply rows.
    named = docs.select(whole_row(docs).alias("_row"), F.col("source").alias("_source"), hash_key("doc_id", "text").alias("_u"))
    taken = named.join(small(want), F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_n", copies(F.col("_u"))).filter("_n > 0")
    return taken.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")


def mix_digest(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    rows, want = plan(docs, weights, most)
    want = want.select(F.col("source").alias("s"), "source_size", "target", "times", "below")
    out = rows.join(small(want), F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies(F.col("u"))).cast("long").alias("taken"))
