"""The work queue as a stream of events: keyed state that moves by events, and by time alone.

Events (name, kind, at, seq, pages, error) arrive in files.  The queue is a merge table with an entry's state for each
name; a batch folds the events of each name, in order, into its entry (one join and one grouping, all expressions).  A
start sets the time when it is due, and an entry that is neither completed nor failed when event time (the newest event
of the batches so far, less ``late``) passes it has stalled: it is pending again, or failed once its attempts are used
up.  So nothing has to look for stalled work.

Kinds: enqueue (unless it is there), start (one more attempt, error cleared; enters what isn't there), complete and fail
(of what is there), retry (of what failed: pending, no attempts).  Others, such as a tick that lets time pass, change
nothing.  A batch that is run again after a failure has its token in the table already.

Defined cases: events of one batch apply in the order of (at, seq), null last, then by their values; events later than
``late`` behind the newest of earlier batches are left out; a null name or time is left out; repeated events apply
again, but for enqueue.  A stream with a new checkpoint goes on from what the table holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.merging import MergeTable
from pagemill.plans import query, table
from pagemill.plans.catalog import _QUEUE_SQL
from pagemill.scratch import scratch_path, written

EVENT = "name string, kind string, at timestamp, seq long, pages long, error string"
_STATE = {"status": "string", "pages": "long", "error": "string", "attempts": "int", "due": "long", "version": "long"}
ENTRY = "name string, " + ", ".join(f"{k} {t}" for k, t in _STATE.items())


def _entry(**fields: Column) -> Column:
    return F.struct(*(fields[k].cast(t).alias(k) for k, t in _STATE.items()))


def _stalled(entry: dict[str, Column], most: int) -> dict[str, Column]:
    """What becomes of an entry whose start took too long."""
    used = entry["attempts"] >= most
    return {**entry, "status": F.when(used, "failed").otherwise("pending"), "error": F.when(used, "stalled").otherwise(entry["error"]), "due": F.lit(None), "version": entry["version"] + 1}


def _after(limit: int, most: int):
    """An entry after an event (times in milliseconds); the version of what isn't there is 0."""

    def step(entry: Column, e: Column) -> Column:
        old = {k: entry[k] for k in _STATE}
        # Event time hasn't passed what is due, but this event comes after it.
        over = old["due"] < e["millis"]
        s = {k: F.when(over, v).otherwise(old[k]) for k, v in _stalled(old, most).items()}
        is_, there = lambda kind: F.coalesce(e["kind"] == kind, F.lit(False)), old["version"] > 0
        enqueue, start, complete, fail, retry = is_("enqueue") & ~there, is_("start"), is_("complete") & there, is_("fail") & there, is_("retry") & F.coalesce(s["status"] == "failed", F.lit(False))
        moved = enqueue | start | complete | fail | retry
        return _entry(
            status=F.when(enqueue | retry, "pending").when(start, "processing").when(complete, "completed").when(fail, "failed").otherwise(s["status"]),
            pages=F.when(complete, e["pages"]).otherwise(s["pages"]),
            error=F.when(start, None).when(fail, e["error"]).otherwise(s["error"]),
            attempts=F.when(start, s["attempts"] + 1).when(retry, 0).otherwise(s["attempts"]),
            due=F.when(start, e["millis"] + limit).when(moved, None).otherwise(s["due"]),
            version=s["version"] + moved.cast("long"),
        )

    return step


def queue_table(spark: SparkSession, root: str) -> MergeTable:
    return MergeTable(spark, root, ENTRY, ["name"])


def _clock(spark: SparkSession, root: str) -> MergeTable:
    """The time of each stream's newest event, in microseconds."""
    return MergeTable(spark, f"{root}/clock", "stream string, newest long", ["stream"], 1)


def folded(queue: DataFrame, events: DataFrame, limit: int, most: int) -> DataFrame:
    """The entries of ``queue`` that ``events`` change, and new ones."""
    what = F.struct(F.unix_micros("at").alias("micros"), F.col("seq").isNull().alias("last"), "seq", F.unix_millis("at").alias("millis"), "kind", "pages", "error")
    each = events.groupBy("name").agg(F.array_sort(F.collect_list(what)).alias("events"))
    rows = each.join(queue.select("name", F.struct(*_STATE).alias("old")), "name", "left")
    none = {"attempts": F.lit(0), "version": F.lit(0)}
    old = _entry(**{k: F.coalesce(F.col(f"old.{k}"), none.get(k, F.lit(None))) for k in _STATE})
    rows = rows.select("name", old.alias("old"), F.aggregate("events", old, _after(limit, most)).alias("new"))
    return rows.filter("new.version > old.version").select("name", "new.*")


def _milliseconds(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).head()[0]


def run(events: DataFrame, root: str, checkpoint: str, limit: str, most: int, late: str = "0 seconds") -> None:
    """Fold what is new in the stream ``events`` into the queue at ``root``; ``limit``: how long a start may take, such as
    "30 minutes"."""
    spark = events.sparkSession
    may_take, behind = _milliseconds(spark, limit), 1000 * _milliseconds(spark, late)

    def save(batch: DataFrame, number: int) -> None:
        queue, clock, token = queue_table(spark, root), _clock(spark, root), f"{checkpoint}/{number}"
        rows = written(batch.filter("name IS NOT NULL AND at IS NOT NULL"), "queue-events")
        told = rows.agg(F.max(F.unix_micros("at")).alias("newest")).head().newest
        if told is None:
            return
        before = clock.read().filter(F.col("stream") == checkpoint).head()
        in_time = rows.filter(F.unix_micros("at") >= before.newest - behind) if before else rows
        queue.upsert(folded(queue.read(), in_time, may_take, most), order=["version"], token=token)
        newest = max(told, before.newest) if before else told
        clock.upsert(spark.createDataFrame([(checkpoint, newest)], "stream string, newest long"), order=["newest"], token=token)
        now = {k: F.col(k) for k in _STATE}
        over = queue.read().filter((F.col("status") == "processing") & (F.col("due") < (newest - behind) // 1000))
        over = over.select("name", _entry(**_stalled(now, most)).alias("new")).select("name", "new.*")
        queue.upsert(over, order=["version"], token=f"{token}/due")

    events.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """What happened to the orders as batches: as many starts as attempts, then what their status says."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    kinds = F.concat(F.array(F.lit("enqueue")), F.array_repeat(F.lit("start"), (k % 4).cast("int")), F.when(F.col("o_orderstatus") == "P", F.array(F.lit("complete"))).when(F.col("o_orderstatus") == "F", F.array(F.lit("fail"))).otherwise(F.array().cast("array<string>")))
    rows = o.select(k.cast("string").alias("name"), F.floor("o_totalprice").alias("price"), F.posexplode(kinds).alias("seq", "kind"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 60)
    return rows.select("name", "kind", at.alias("at"), F.col("seq").cast("long").alias("seq"), F.when(F.col("kind") == "complete", F.col("price")).alias("pages"), F.when(F.col("kind") == "fail", "broken").alias("error"))


@query(f"""WITH {_QUEUE_SQL} SELECT name, CASE WHEN status = 'processing' AND attempts >= 2 THEN 'failed' WHEN status = 'processing' THEN 'pending' ELSE status END AS status, pages,
  CASE WHEN status = 'failed' THEN 'broken' WHEN status = 'processing' AND attempts >= 2 THEN 'stalled' END AS error, attempts FROM queue""")
def queue_events(spark: SparkSession, sf: str) -> DataFrame:
    """The orders' events in two lots, the stream restarted between; then time passes, and what stalled settles by itself."""
    root = scratch_path(spark, "queue-stream")
    events = order_events(spark, sf)
    tick = spark.range(1).select(F.lit("").alias("name"), F.lit("tick").alias("kind"), F.timestamp_seconds(F.lit(1_700_100_000)).alias("at"), F.lit(0).cast("long").alias("seq"), F.lit(None).cast("long").alias("pages"), F.lit(None).cast("string").alias("error"))
    for lot in (events.filter("seq < 2"), events.filter("seq >= 2"), tick):
        lot.write.mode("append").parquet(f"{root}/events")
        run(spark.readStream.schema(EVENT).parquet(f"{root}/events"), f"{root}/queue", f"{root}/checkpoint", "30 minutes", 2)
    return queue_table(spark, f"{root}/queue").read().select("name", "status", "pages", "error", "attempts")
