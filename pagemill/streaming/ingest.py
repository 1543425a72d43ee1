"""Incremental ingest with Structured Streaming.

A checkpoint remembers which files are done; a batch that is run again after a failure writes the same rows to the
same place.  Keys are settled when the table is read: of equal keys the last one written counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ranking import last_by
from pagemill.plans import query, table
from pagemill.scratch import scratch_path


def file_stream(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None, limit: int | None = None) -> DataFrame:
    """Parquet files of ``folder`` as a stream: so many files a batch, corrupt ones passed over (see ``unread``).

    ``limit``: no more than about so many bytes a batch.
    """
    reader = spark.readStream.schema(schema).option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet")
    for name, value in (("maxFilesPerTrigger", files_per_batch), ("maxBytesPerTrigger", limit)):
        reader = reader.option(name, value) if value else reader
    return reader.parquet(folder).withColumn("file", F.col("_metadata.file_path"))


def unread(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Files of ``folder`` (path, bytes) that have no row in ``target``: unreadable, empty, or superseded by later ones.
    ``ledger.Ledger`` tells these apart, finds half-read files, and takes mended ones again."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select(F.col("path"), F.col("length").alias("bytes"))
    name = lambda c: F.substring_index(c, "/", -1)
    done = spark.read.parquet(target).select(name(F.col("file")).alias("name")).distinct()
    return files.withColumn("name", name(F.col("path"))).join(done, "name", "left_anti").select("path", "bytes")


def ingest(stream: DataFrame, target: str, checkpoint: str, key: str, order: str, by: str | None = None) -> None:
    """Append what is new in ``stream`` to ``target``, at most one row of each key for each batch; returns when done.

    ``by``: a column that the target is partitioned by, as an index is by namespace.
    """

    def save(batch: DataFrame, number: int) -> None:
        # Its own folder for each batch makes a repeated one replace itself.
        w = last_by(batch, [key], [order]).write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The last version of each key."""
    return last_by(spark.read.parquet(target), [key], ["batch"]).drop("batch")


def windowed_counts(stream: DataFrame, time: str, by: str, length: str, late: str, summed: str) -> DataFrame:
    """Counts, and sums of a column, in tumbling windows of event time. Rows later than ``late`` behind the newest are
    left out, and a window's state is dropped as soon as it can't change any more."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(summed).alias("total"))


def save_windows(counts: DataFrame, target: str, checkpoint: str) -> None:
    """Write the windows that changed, batch by batch; ``latest_windows`` reads them."""
    save = lambda batch, number: batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
    counts.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_windows(spark: SparkSession, target: str, by: str) -> DataFrame:
    """Each window as its last batch left it: start, by, n, total."""
    rows = spark.read.parquet(target).select(F.col("w.start").alias("start"), by, "n", "total", "batch")
    return last_by(rows, ["start", by], ["batch"]).drop("batch")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    # As a pattern the path may be a file or a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")


@query("SELECT event_type, user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user and type, from a stream of event files."""
    target = scratch_path(spark, "stream")
    keyed = _events(spark, sf).select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), "event_type", "user_id", "event_id", "value")
    ingest(keyed, f"{target}/table", f"{target}/checkpoint", "key", "event_id")
    return current(spark, f"{target}/table", "key").select("event_type", "user_id", "event_id", "value")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts of each event type, from a stream."""
    target = scratch_path(spark, "windows")
    events = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    save_windows(windowed_counts(events, "ts", "event_type", "1 hour", "31 days", "event_id"), f"{target}/table", f"{target}/checkpoint")
    return latest_windows(spark, f"{target}/table", "event_type")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events as many files, taken two at a time into an index by namespace; a second run finds nothing new."""
    root = scratch_path(spark, "files")
    events = table(spark, sf, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), "event_type", "user_id", "event_id", "value")
    events.repartition(5, "user_id").write.parquet(f"{root}/in")
    for _ in range(2):
        ingest(file_stream(spark, f"{root}/in", events.schema, 2), f"{root}/out", f"{root}/checkpoint", "key", "event_id", "event_type")
    return current(spark, f"{root}/out", "key").select("user_id", "event_type", "event_id", "value")
