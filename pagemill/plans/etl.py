"""From archives to the partitioned page table and its catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import links
from pagemill.functions import text as tx
from pagemill.plans import query, table
from pagemill.sources import layout as lay
from pagemill.sources.listings import OWNERS, lookup

PARTITIONS = ("state_slug", "newspaper_slug", "year", "source_batch")
#: Pages that go to a layout reader at a time; Spark's own number (10,000) is hundreds of MB of XML in each task.
PAGES_AT_A_TIME = 64
_AT_A_TIME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def page_table(pages: DataFrame, titles: DataFrame, assets: DataFrame, batch: str, viewer: str, storage: str) -> DataFrame:
    """Rows of the page table.

    ``pages``: archive_pages(); ``titles``: lccn, name, city, state and, if known, ethnicity; ``assets``: manifest_assets().  Text is the OCR
    text, or what the layout says if that is empty; pages without text are left out.  Where the manifest has no
    image, asset URLs follow from the page's own key.
    """
    awardee = batch.split("_")[0].lower()
    t = titles.select("lccn", F.col("name").alias("_name"), F.col("city").alias("_city"), F.col("state").alias("_state"), (F.col("ethnicity") if "ethnicity" in titles.columns else F.lit(None).cast("string")).alias("_ethnicity"))
    p = pages.join(F.broadcast(t) if t.limit(10_001).count() <= 10_000 else t, "lccn", "left").join(assets, ["lccn", "date", "edition", "sequence"], "left")
    unknown = awardee.upper() if len(awardee) == 2 else "Unknown"
    name = tx.blank_to(F.col("_name"), None)
    title = F.coalesce(name, F.concat(F.lit("Newspaper "), "lccn"))
    state = tx.blank_to(F.col("_state"), unknown)
    part = F.split("date", "-")
    issue_dir = F.concat(F.translate("date", "-", ""), F.lpad(F.col("edition").cast("string"), 2, "0"))
    folder = lambda reel: F.concat_ws("/", F.lit(f"{storage.rstrip('/')}/batches/{batch}/data"), "lccn", reel, issue_dir)
    file = F.lpad(F.col("sequence").cast("string"), 4, "0")
    # A manifest entry without a PDF leaves the reel out of the path.
    own = F.when(F.col("image_url").isNull(), F.col("reel"))
    p = p.withColumns({"pdf_url": F.coalesce("pdf_url", F.concat(folder(own), F.lit("/"), file, F.lit(".pdf"))), "image_url": F.coalesce("image_url", F.concat(folder(F.col("reel")), F.lit("/"), file, F.lit(".jp2")))})
    # Layouts are several times as large when they are read: rows are joined and dealt before. Those of a publication's
    # year go to a few tasks, so that partitions have few files and no task has them all.
    p = p.withColumns({"year": tx.int_or(part[0], 0), "state_slug": tx.slug(state), "newspaper_slug": tx.slug(tx.clean_title(title)), "source_batch": F.lit(batch)})
    p = p.repartition(*PARTITIONS, F.pmod(F.xxhash64("date"), F.lit(8)))
    p = p.withColumn("lay", lay.layout("xml"))
    p = p.withColumn("raw", F.coalesce(F.nullif("txt", F.lit("")), lay.full_text(F.col("lay.blocks"))))
    p = p.withColumn("clean", F.trim("raw", F.lit(" \t\r\n"))).filter(F.length("clean") > 0)
    flat = lay.flattened(F.col("lay"))
    empty = {k: F.coalesce(v, F.array()) for k, v in flat.items()}
    return p.select(
        links.page_id(F.col("lccn"), F.col("date"), F.col("edition"), F.col("sequence")).alias("_id"),
        F.col("clean").alias("text"), tx.clean_title(title).alias("newspaper_title"), title.alias("title"), "lccn", "date",
        "year", tx.int_or(part[1], 0).alias("month"), tx.int_or(part[2], 0).alias("day"), "edition", "sequence",
        tx.blank_to(F.col("_city"), "Unknown").alias("city"), state.alias("state"), F.coalesce("reel_id", "reel").alias("reel_id"),
        "source_batch", F.coalesce(lookup(F.lit(awardee), OWNERS), F.lit(awardee)).alias("awardee"), F.lit(awardee).alias("awardee_code"),
        tx.blank_to(F.col("_ethnicity"), "").alias("ethnicity"), F.concat(F.lit(viewer.rstrip("/") + "/item/"), "lccn", F.lit("/"), "date", F.lit("/ed-"), F.col("edition").cast("string"), F.lit("/")).alias("item_url"),
        F.length("raw").alias("char_count"), F.size(tx.words(F.col("raw"))).alias("word_count"),
        F.coalesce("lay.width", F.lit(0)).alias("page_width"), F.coalesce("lay.height", F.lit(0)).alias("page_height"), tx.blank_to(F.col("lay.unit"), "inch1200").alias("page_unit"), tx.blank_to(F.col("lay.engine"), "Unknown").alias("ocr_engine"),
        "pdf_url", "image_url", F.concat(F.lit(viewer.rstrip("/") + "/resource/"), "lccn", F.lit("/"), "date", F.lit("/ed-"), F.col("edition").cast("string"), F.lit("/?sp="), F.col("sequence").cast("string")).alias("page_url"),
        *(v.alias(k) for k, v in empty.items()),
        "state_slug", "newspaper_slug",
    )


def write_pages(rows: DataFrame, path: str) -> None:
    """Add a batch to the page table; a re-run of the batch replaces its own rows, and those of other batches stay.

    ``rows`` are those of ``page_table``, which deals them to tasks.
    """
    conf = rows.sparkSession.conf
    before = conf.get(_AT_A_TIME)
    conf.set(_AT_A_TIME, str(PAGES_AT_A_TIME))
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*PARTITIONS).parquet(path)
    finally:
        conf.set(_AT_A_TIME, before)


def write_catalog(rows: DataFrame, path: str) -> None:
    """A catalog both as JSON lines and as Parquet."""
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/jsonl")  # a row for each publication
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/parquet")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Publications of a page table: files, pages, megabytes and years. Only the columns needed are read."""
    rows = spark.read.parquet(path).select("lccn", "title", "city", "state", "year", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    files = rows.groupBy("lccn", "file").agg(F.min(F.struct("file", "title", "city", "state")).alias("first"), F.count(F.lit(1)).alias("pages"), F.max("bytes").alias("bytes"), F.min("year").alias("y0"), F.max("year").alias("y1"))
    c = files.groupBy("lccn").agg(F.min("first").alias("f"), F.count(F.lit(1)).alias("file_count"), F.sum("pages").alias("total_pages"), F.round(F.sum("bytes") / 1048576, 2).alias("size_mb"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    span = F.when(F.col("y0") > 0, F.concat_ws("-", F.col("y0").cast("string"), F.col("y1").cast("string"))).otherwise("Unknown")
    return c.select("lccn", "f.title", "f.city", "f.state", "file_count", "total_pages", "size_mb", span.alias("years"))


_WORDS = r"[ \t\n\r]+"


def layout_xml(text: Column) -> Column:
    """A text as layout XML, with a line for each line."""
    safe = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    xml = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    word = lambda w, i: F.concat(F.lit('<String CONTENT="'), xml(w), F.lit('" HPOS="'), (i * 10).cast("string"), F.lit('" VPOS="10" WIDTH="8.6" HEIGHT="12"/>'))
    line = lambda t: F.concat(F.lit("<TextLine>"), F.array_join(F.transform(F.filter(F.split(t, _WORDS), lambda w: w != ""), word), "<SP/>"), F.lit("</TextLine>"))
    body = F.array_join(F.transform(F.split(safe, "\n"), line), "")
    return F.concat(F.lit('<alto xmlns="urn:x"><Layout><Page WIDTH="15000" HEIGHT="15000"><TextBlock ID="b">'), body, F.lit("</TextBlock></Page></Layout></alto>"))


@query("""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), chr(10)), lambda x: array_to_string(list_filter(string_split_regex(x, '[ \\t\\n\\r]+'), lambda w: w <> ''), ' ')), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, array_to_string(ls, chr(10)) AS full_text, CAST(len(ls) AS INTEGER) AS n_lines, CAST(coalesce(list_sum(list_transform(ls, lambda x: len(string_split(x, ' ')))), 0) AS INTEGER) AS n_words,
  [CAST(0 AS SMALLINT), CAST(round_even(10 / 15000 * 1000, 0) AS SMALLINT)] AS first_corner FROM l WHERE len(ls) > 0""")
def layout_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written as layout XML (a line for each line), read back by the layout reader."""
    read = table(spark, sf, "documents").select("doc_id", lay.layout(layout_xml(F.col("text"))).alias("p"))
    flat = lay.flattened(F.col("p"))
    out = read.select("doc_id", lay.full_text(F.col("p.blocks")).alias("full_text"), F.size(flat["lines"]).alias("n_lines"), F.size(flat["words"]).alias("n_words"), F.slice(flat["boxes"][0], 1, 2).alias("first_corner"))
    return out.filter("n_lines > 0")
