"""Catalog and queue queries: orders stand for batches, parts for titles, customers for owners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.operators import filters as flt
from pagemill.operators import queue as q
from pagemill.operators.ranking import first_by, last_by, top_per_group, upsert
from pagemill.plans import query, table


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE (p_name ILIKE '%a%' OR p_brand ILIKE '%a%') AND p_size >= 10 AND p_type ILIKE '%e%'")
def title_search(spark: SparkSession, sf: str) -> DataFrame:
    hits = flt.where(table(spark, sf, "part"), flt.contains(["p_name", "p_brand"], "a"), flt.at_least("p_size", 10), flt.contains(["p_type"], "e"), flt.equals("p_brand", ""))
    return hits.select("p_partkey", "p_name", "p_brand", "p_size")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE (o_orderpriority ILIKE '%high%' OR o_orderstatus ILIKE '%high%') AND o_totalprice >= 1000 AND o_totalprice <= 200000 AND upper(o_orderstatus) = upper('o')")
def batch_search(spark: SparkSession, sf: str) -> DataFrame:
    hits = flt.where(table(spark, sf, "orders"), flt.contains(["o_orderpriority", "o_orderstatus"], "high"), flt.at_least("o_totalprice", 1000), flt.at_most("o_totalprice", 200000), flt.equals_folded("o_orderstatus", "o"))
    return hits.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""WITH spans AS (SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
  CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN CAST(max(year(o_orderdate)) AS INTEGER) END AS last_year FROM orders GROUP BY 1)
SELECT * FROM spans WHERE first_year <= 1997 AND (last_year >= 1997 OR last_year IS NULL)""")
def active_interval(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    spans = o.groupBy("o_custkey").agg(F.min("y").alias("first_year"), F.when(F.count_if(F.col("o_orderstatus") == "O") == 0, F.max("y")).alias("last_year"))
    return flt.where(spans, flt.active_in("first_year", "last_year", 1997))


@query("""SELECT o_orderkey, c_name, c_nationkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'O' AND upper(c_mktsegment) = 'BUILDING'""")
def queue_pending_join(spark: SparkSession, sf: str) -> DataFrame:
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'O'")
    owners = flt.where(table(spark, sf, "customer"), flt.equals_folded("c_mktsegment", "building"))
    return pending.join(owners, pending["o_custkey"] == owners["c_custkey"]).select("o_orderkey", "c_name", "c_nationkey", "o_totalprice")


#: Orders as a queue: open ones are processing, the rest by their status; attempts from the key.
_QUEUE_SQL = """queue AS (SELECT CAST(o_orderkey AS VARCHAR) AS name,
  CASE o_orderstatus WHEN 'O' THEN 'processing' WHEN 'F' THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS pages, CAST(NULL AS VARCHAR) AS error,
  CAST(o_orderkey % 4 AS INTEGER) AS attempts, o_custkey FROM orders)"""


def _queue(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "processing").when(F.col("o_orderstatus") == "F", "failed").otherwise("completed")
    pages = F.when(F.col("o_orderstatus") == "P", F.floor("o_totalprice"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("name"), status.alias("status"), pages.alias("pages"), F.lit(None).cast("string").alias("error"), (F.col("o_orderkey") % 4).cast("int").alias("attempts"), "o_custkey")


@query(f"""WITH {_QUEUE_SQL} SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing,
  count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) AS total,
  CAST(coalesce(sum(pages), 0) AS BIGINT) AS pages_extracted FROM queue""")
def queue_summary(spark: SparkSession, sf: str) -> DataFrame:
    return q.summary(_queue(spark, sf))


@query(f"""WITH {_QUEUE_SQL} SELECT name, CASE WHEN status = 'processing' AND attempts >= 2 THEN 'failed' WHEN status = 'processing' THEN 'pending' ELSE status END AS status, attempts FROM queue""")
def queue_recovery(spark: SparkSession, sf: str) -> DataFrame:
    return q.recover(_queue(spark, sf), 2).select("name", "status", "attempts")


@query(f"""WITH {_QUEUE_SQL}, among AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT name, CASE WHEN f THEN 'pending' ELSE status END AS status, CASE WHEN f THEN 0 ELSE attempts END AS attempts
FROM (SELECT *, status = 'failed' AND o_custkey IN (FROM among) AS f FROM queue)""")
def queue_retry_semi(spark: SparkSession, sf: str) -> DataFrame:
    owners = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'")
    queue = _queue(spark, sf)
    return q.retry(queue, queue.join(owners, queue["o_custkey"] == owners["c_custkey"], "left_semi")).select("name", "status", "attempts")


@query(f"""WITH {_QUEUE_SQL} SELECT name, status, attempts FROM queue UNION ALL
SELECT DISTINCT CAST(l_partkey AS VARCHAR), 'pending', 0 FROM lineitem WHERE CAST(l_partkey AS VARCHAR) NOT IN (SELECT name FROM queue)""")
def queue_init_anti(spark: SparkSession, sf: str) -> DataFrame:
    batches = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("name"))
    return q.enqueue(_queue(spark, sf).drop("o_custkey"), batches).select("name", "status", "attempts")


@query(f"""WITH {_QUEUE_SQL} SELECT name, CASE WHEN attempts = 3 THEN 'completed' ELSE status END AS status,
  CASE WHEN attempts = 3 THEN 7 ELSE pages END AS pages, CASE WHEN status = 'processing' THEN attempts + 1 ELSE attempts END AS attempts
FROM queue""")
def queue_start_complete(spark: SparkSession, sf: str) -> DataFrame:
    started = q.start(_queue(spark, sf).withColumn("was", F.col("attempts")), F.col("status") == "processing")
    return q.complete(started, F.col("was") == 3, F.lit(7).cast("long")).select("name", "status", "pages", "attempts")


@query("SELECT event_id, user_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return last_by(table(spark, sf, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "ts", "value")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1")
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return first_by(table(spark, sf, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query("""SELECT c_custkey, c_name, CASE WHEN n IS NULL THEN c_acctbal ELSE n END AS c_acctbal FROM customer
LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    now = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    best = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("n"))
    changes = now.join(best, now["c_custkey"] == best["k"]).select("c_custkey", "c_name", F.col("n").alias("c_acctbal"))
    return upsert(now, changes, ["c_custkey"])


@query("SELECT c_nationkey, count(*) AS n, max(c_name) AS last_name FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10")
def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.max("c_name").alias("last_name")).orderBy(F.col("n").desc(), "c_nationkey").limit(10)


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL")
def distinct_states(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand").filter("p_brand IS NOT NULL").distinct()


@query("SELECT (SELECT count(*) FROM orders) AS batches, (SELECT count(*) FROM part) AS titles, (SELECT count(*) FROM lineitem) AS downloads")
def catalog_status(spark: SparkSession, sf: str) -> DataFrame:
    count = lambda t, name: table(spark, sf, t).agg(F.count(F.lit(1)).alias(name))  # noqa: E731  one row each
    return count("orders", "batches").crossJoin(count("part", "titles")).crossJoin(count("lineitem", "downloads"))


@query("SELECT o_orderkey, o_custkey, o_orderdate, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rank FROM orders) WHERE rank <= 3")
def latest_downloads(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return top_per_group(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 3)


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE CAST(trunc(CAST(p_size || '.5' AS DOUBLE) * CASE p_size % 4 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 WHEN 2 THEN 1073741824 ELSE 1 END) AS BIGINT) END AS size_bytes FROM part""")
def size_parse(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.functions.text import size_bytes

    unit = F.get(F.array(*map(F.lit, ("KB", "mb", "GB", "Bytes"))), F.col("p_size") % 4)
    text = F.when(F.col("p_size") % 5 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5 "), unit))
    return table(spark, sf, "part").select("p_partkey", size_bytes(text).alias("size_bytes"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) <= 5 THEN 'Spring' WHEN month(ts) <= 8 THEN 'Summer' ELSE 'Fall' END AS season FROM events""")
def json_coerce(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.functions.text import season

    props = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf, "events").select("event_id", props.alias("k"), season(F.month("ts")).alias("season"))


@query("""SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) <= 5 THEN 'Spring' WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
  count(*) AS n, min(o_orderdate) AS first_date FROM orders GROUP BY 1""")
def season_counts(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.functions.text import season

    return table(spark, sf, "orders").groupBy(season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_date"))


@query("""SELECT l_orderkey, l_linenumber, [x0, y0, x1, y1] AS box FROM (SELECT l_orderkey, l_linenumber,
  CAST(least(greatest(round_even(l_quantity / 60 * 1000, 0), 0), 1000) AS SMALLINT) AS x0,
  CAST(least(greatest(round_even(l_linenumber / 9 * 1000, 0), 0), 1000) AS SMALLINT) AS y0,
  CAST(least(greatest(round_even((l_quantity + l_tax * 100) / 60 * 1000, 0), 0), 1000) AS SMALLINT) AS x1,
  CAST(least(greatest(round_even((l_linenumber + l_discount * 10) / 9 * 1000, 0), 0), 1000) AS SMALLINT) AS y1 FROM lineitem)""")
def box_normalize(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.functions.text import normalized_box

    box = normalized_box(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax") * 100, F.col("l_discount") * 10, F.lit(60), F.lit(9))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", box.alias("box"))


@query("""WITH h AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, day, n, n / max(n) OVER (PARTITION BY event_type) AS scaled FROM h""")
def timeline_scaled(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return h.withColumn("scaled", F.col("n") / F.max("n").over(W.partitionBy("event_type")))


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE (p_name ILIKE '%e%' OR p_brand ILIKE '%e%') AND p_size >= 5 ORDER BY p_name, p_partkey LIMIT 50")
def ordered_search(spark: SparkSession, sf: str) -> DataFrame:
    hits = flt.where(table(spark, sf, "part"), flt.contains(["p_name", "p_brand"], "e"), flt.at_least("p_size", 5))
    return hits.orderBy("p_name", "p_partkey").limit(50).select("p_partkey", "p_name", "p_brand")


_PENDING_SQL = f"""{_QUEUE_SQL}, b AS (SELECT CAST(o_orderkey AS VARCHAR) AS name, o_custkey AS owner, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS size_bytes FROM orders)"""


@query(f"WITH {_PENDING_SQL} SELECT q.name, size_bytes FROM queue q JOIN b ON q.name = b.name JOIN customer ON owner = c_custkey WHERE status = 'failed' AND upper(c_mktsegment) = 'BUILDING' ORDER BY size_bytes NULLS FIRST, q.name LIMIT 60")
def pending_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """What is to be done after a retry, the smallest first."""
    o = table(spark, sf, "orders")
    owners = flt.where(table(spark, sf, "customer"), flt.equals_folded("c_mktsegment", "building")).select(F.col("c_custkey").alias("o_custkey"))
    batches = o.join(owners, "o_custkey", "left_semi").select(F.col("o_orderkey").cast("string").alias("name"), F.when(F.col("o_orderkey") % 17 != 0, F.floor("o_totalprice")).alias("size_bytes"))
    return q.pending(q.retry(_queue(spark, sf)), batches, 60).select("name", "size_bytes")


@query(f"""WITH {_QUEUE_SQL}, f AS (SELECT name, CASE WHEN attempts = 1 THEN 'failed' ELSE status END AS status, pages, CASE WHEN attempts = 1 THEN 'broken' END AS error, attempts, c_mktsegment AS seg FROM queue LEFT JOIN customer ON o_custkey = c_custkey)
SELECT name, CASE WHEN seg IN ('MACHINERY', 'BUILDING') THEN 'pending' ELSE status END AS status, CASE WHEN seg IN ('MACHINERY', 'BUILDING') THEN 0 ELSE pages END AS pages,
  CASE WHEN seg IN ('MACHINERY', 'BUILDING') THEN NULL ELSE error END AS error, CASE WHEN seg = 'MACHINERY' THEN 0 ELSE attempts END AS attempts FROM f""")
def queue_resets(spark: SparkSession, sf: str) -> DataFrame:
    """Failures, then resets of some owners' batches: with their attempts made anew, or kept."""
    queue, c = _queue(spark, sf), table(spark, sf, "customer")
    of = lambda segment: queue.join(c.filter(F.col("c_mktsegment") == segment).select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("name")
    failed = q.fail(queue.drop("o_custkey"), F.col("attempts") == 1, F.lit("broken"))
    return q.reset(q.reset(failed, of("MACHINERY")), of("BUILDING"), attempts=False).select("name", "status", "pages", "error", "attempts")


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS k, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders)
SELECT o_custkey, bool_and(o_orderkey % 3 > 0) AS done FROM n WHERE k = 0 OR k = c // 2 OR k = c - 1 GROUP BY 1""")
def queue_done_check(spark: SparkSession, sf: str) -> DataFrame:
    """Is a batch there already? Three of its issues tell."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return q.already_done(o, o.filter("o_orderkey % 3 > 0"), "o_custkey", ["o_orderkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT DISTINCT o_orderdate, o_orderpriority FROM orders WHERE o_custkey % 10 = 3 ORDER BY o_orderdate DESC, o_orderpriority LIMIT 25")
def issue_list(spark: SparkSession, sf: str) -> DataFrame:
    """The issues of a publication, newest first."""
    issues = table(spark, sf, "orders").filter("o_custkey % 10 = 3").select("o_orderdate", "o_orderpriority").distinct()
    return issues.orderBy(F.col("o_orderdate").desc(), "o_orderpriority").limit(25)


@query("""WITH l AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS xs FROM orders GROUP BY 1)
SELECT o_custkey, '["' || array_to_string(xs, '","') || '"]' AS listed, contains(lower(array_to_string(xs, ',')), 'urg') AS loose, list_contains(xs, '2-HIGH') AS exact FROM l""")
def json_membership(spark: SparkSession, sf: str) -> DataFrame:
    lists = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_set("o_orderpriority"))).alias("listed"))
    return lists.withColumns({"loose": flt.in_json_list("listed", "urg"), "exact": flt.in_json_list("listed", "2-HIGH", exact=True)})


@query("SELECT lang AS state FROM documents UNION SELECT n_name FROM nation")
def state_union(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("lang").alias("state")).union(table(spark, sf, "nation").select("n_name")).distinct()


@query(f"""WITH {_QUEUE_SQL} SELECT c_mktsegment AS state, count(*) FILTER (status = 'completed') AS success, count(*) FILTER (status = 'failed') AS failed, CAST(coalesce(sum(pages) FILTER (status = 'completed'), 0) AS BIGINT) AS pages, CAST(grouping(c_mktsegment) AS INTEGER) AS overall
FROM queue JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment)""")
def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a run, by state and overall."""
    rows = _queue(spark, sf).join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("state")), "o_custkey")
    done = F.col("status") == "completed"
    return rows.rollup("state").agg(F.count_if(done).alias("success"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum(F.when(done, F.col("pages"))), F.lit(0)).cast("long").alias("pages"), F.grouping("state").cast("int").alias("overall"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 7")
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter("c_custkey = 7").select("c_custkey", "c_name", "c_acctbal")
