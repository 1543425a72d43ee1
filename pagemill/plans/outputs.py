"""Queries that write: JSON lines, appended registries, patched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.operators.export import write_jsonl
from pagemill.operators.patching import changed, patch
from pagemill.operators.ranking import last_by
from pagemill.plans import query, table
from pagemill.plans.views import PAGES_SQL, pages
from pagemill.scratch import scratch_path


@query("SELECT vec_id, label, 'v' || vec_id AS text FROM embeddings UNION ALL SELECT vec_id, label, 'more' FROM embeddings WHERE vec_id % 3 = 0")
def jsonl_by_namespace(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines in a folder for each namespace and files of 50 lines at most: overwritten, then appended to."""
    out = scratch_path(spark, "jsonl")
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("text"))
    for df, mode in ((e.limit(3), "overwrite"), (e, "overwrite"), (e.filter("vec_id % 3 = 0").withColumn("text", F.lit("more")), "append")):
        write_jsonl(df, out, rows_per_file=50, by="label", mode=mode)
    rows = spark.read.schema("vec_id long, text string, label int").json(out)
    # A row of a file with too many has no counterpart in the SQL.
    in_file = F.count(F.lit(1)).over(W.partitionBy("file"))
    sized = rows.withColumn("file", F.col("_metadata.file_path")).withColumn("n", in_file)
    return sized.select("vec_id", "label", F.when(F.col("n") <= 50, F.col("text")).alias("text"))


@query("SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2 ORDER BY 3 DESC LIMIT 100")
def downloads_appended(spark: SparkSession, sf: str) -> DataFrame:
    """A registry that only grows, in three runs; the latest entry of each item and kind, newest first."""
    out = scratch_path(spark, "downloads")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    for k in range(3):
        o.filter(F.col("o_orderkey") % 3 == k).withColumn("at", F.date_format(F.timestamp_seconds(F.col("o_orderkey")), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("append").parquet(out)
    last = last_by(spark.read.parquet(out), ["o_custkey", "o_orderpriority"], ["at", "o_orderkey"])
    return last.orderBy(F.col("at").desc(), F.col("o_orderkey").desc()).limit(100).select("o_custkey", "o_orderpriority", "o_orderkey")


_NEWS_SQL = f"{PAGES_SQL}, n AS (SELECT doc_id, state, slug, CASE WHEN doc_id % 4 = 0 AND state <> 'en' THEN 'batch_' || doc_id % 5 ELSE slug END AS batch, CASE WHEN doc_id % 4 = 0 AND state <> 'en' AND doc_id % 8 = 0 THEN 'r' || doc_id END AS reel FROM pages_v)"


_PATCHED = "doc_id long, slug string, batch string, reel string, state string"


def _patched(spark: SparkSession, sf: str, dry_run: bool = False) -> tuple[str, int]:
    out, k = scratch_path(spark, "patched"), F.col("doc_id")
    p = pages(spark, sf).select("doc_id", "state", "slug", F.col("slug").alias("batch"), F.lit(None).cast("string").alias("reel"))
    p.repartition("state").write.partitionBy("state").parquet(out)
    news = p.filter((k % 4 == 0) & (F.col("state") != "en")).select("doc_id", F.concat(F.lit("batch_"), (k % 5).cast("string")).alias("batch"), F.when(k % 8 == 0, F.concat(F.lit("r"), k.cast("string"))).otherwise("").alias("reel"))
    # Rows that say the same twice, and older news under a key: the later count.
    news = news.withColumn("at", F.lit(2)).unionByName(news.withColumn("at", F.lit(2))).unionByName(news.withColumns({"batch": F.lit("old"), "at": F.lit(1)}))
    return out, patch(spark, out, news, ["doc_id"], ["batch", "reel"], "state", dry_run, order=["at"], task_rows=100, schema=_PATCHED)


@query(f"WITH {_NEWS_SQL} SELECT doc_id, state, batch, reel FROM n")
def patched_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose changed partitions were written beside it and put in their place."""
    out, _ = _patched(spark, sf)
    return spark.read.schema(_PATCHED).parquet(out).select("doc_id", "state", "batch", "reel")


@query(f"WITH {_NEWS_SQL} SELECT state, count(*) FILTER (batch <> slug) AS n, false AS written FROM n GROUP BY 1")
def patch_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """What a patch would change, by partition; the table stays as it is."""
    out, _ = _patched(spark, sf, dry_run=True)
    k = F.col("doc_id")
    rows = spark.read.schema(_PATCHED).parquet(out)
    news = rows.filter((k % 4 == 0) & (F.col("state") != "en")).select("doc_id", F.concat(F.lit("batch_"), (k % 5).cast("string")).alias("batch"))
    return changed(rows, news, ["doc_id"], ["batch"]).groupBy("state").agg(F.count_if("changed").alias("n"), F.bool_or(F.col("batch").isNull()).alias("written"))
