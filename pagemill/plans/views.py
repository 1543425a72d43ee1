"""The tables seen as a page collection, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.links import page_id
from pagemill.plans import table

#: ``documents`` as pages: a publication for each source, issues by date, and a page sequence.
PAGES_SQL = """
pages_v AS (
  SELECT doc_id, text, lang AS state, source AS slug, n_chars,
         CAST(1890 + doc_id % 21 AS INTEGER) AS year, CAST(1 + doc_id % 12 AS INTEGER) AS month,
         CAST(1 + doc_id % 28 AS INTEGER) AS day, CAST(1 + doc_id % 8 AS INTEGER) AS sequence, 1 AS edition,
         'sn' || lpad(regexp_extract(source, '[0-9]+'), 8, '0') AS lccn,
         CAST(1890 + doc_id % 21 AS VARCHAR) || '-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS date
  FROM documents)
"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    part = lambda first, n: (F.lit(first) + F.col("doc_id") % n).cast("int")
    d = d.select("doc_id", "text", F.col("lang").alias("state"), F.col("source").alias("slug"), "n_chars", part(1890, 21).alias("year"), part(1, 12).alias("month"), part(1, 28).alias("day"), part(1, 8).alias("sequence"), F.lit(1).alias("edition"))
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    d = d.withColumn("lccn", F.concat(F.lit("sn"), F.lpad(F.regexp_extract("slug", "[0-9]+", 0), 8, "0")))
    return d.withColumn("date", F.concat_ws("-", F.col("year").cast("string"), two("month"), two("day")))


#: Publications, a row for each source.
PUBS_SQL = """
pubs AS (SELECT slug, 'The Daily ' || slug AS title, CASE n % 3 WHEN 0 THEN 'west' WHEN 1 THEN 'east' ELSE 'plains' END AS region, 'City ' || n AS city, 'State ' || n % 4 AS state_name, 'sn' || lpad(CAST(n AS VARCHAR), 8, '0') AS lccn
  FROM (SELECT DISTINCT source AS slug, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS n FROM documents))
"""


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("slug"), F.regexp_extract("source", "[0-9]+", 0).try_cast("int").alias("n")).distinct()
    n = F.col("n").cast("string")
    region = F.when(F.col("n") % 3 == 0, "west").when(F.col("n") % 3 == 1, "east").otherwise("plains")
    return d.select("slug", F.concat(F.lit("The Daily "), "slug").alias("title"), region.alias("region"), F.concat(F.lit("City "), n).alias("city"), F.concat(F.lit("State "), (F.col("n") % 4).cast("string")).alias("state_name"), F.concat(F.lit("sn"), F.lpad(n, 8, "0")).alias("lccn"))


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("page_id", page_id(F.col("lccn"), F.col("date"), F.col("edition"), F.col("sequence")))


#: Terms and stems by the same rules as ``functions.text``.
TERMS_SQL = "list_filter(string_split_regex(lower(coalesce({0}, '')), '[^a-z0-9]+'), lambda w: w <> '')"
STEM_SQL = """CASE WHEN {0} LIKE '%ies' AND length({0}) > 4 THEN left({0}, length({0}) - 3) || 'y'
  WHEN {0} LIKE '%es' AND length({0}) > 3 THEN left({0}, length({0}) - 2)
  WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' AND length({0}) > 3 THEN left({0}, length({0}) - 1)
  WHEN {0} LIKE '%ing' AND length({0}) > 5 THEN left({0}, length({0}) - 3)
  WHEN {0} LIKE '%ed' AND length({0}) > 4 THEN left({0}, length({0}) - 2) ELSE {0} END"""
