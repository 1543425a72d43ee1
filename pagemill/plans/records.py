"""Queries that build records: chunks, hit cards, exports, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import links
from pagemill.functions import text as tx
from pagemill.operators import filters as flt
from pagemill.operators import records as rec
from pagemill.operators.chunks import recursive_chunks, word_chunks
from pagemill.operators.export import acceptable, export_documents
from pagemill.operators.highlight import query_marks
from pagemill.operators.ranking import in_shards, tiered
from pagemill.plans import query, table
from pagemill.plans.views import PAGES_SQL, PUBS_SQL, pages, publications

_IMAGES = "https://i.test"
_SCAN_SQL = "'https://x.test/data/batches/nbu_a_ver01/data/' || lccn || '/' || CASE WHEN doc_id % 2 = 0 THEN '00175/' ELSE '' END || replace(date, '-', '') || '01/' || lpad(CAST(sequence AS VARCHAR), 4, '0') || '.jp2'"
_ID_SQL = "'service:ndnp:nbu:batch_nbu_a_ver01:data:' || lccn || ':' || CASE WHEN doc_id % 2 = 0 THEN '00175' ELSE '00000000000' END || ':' || replace(date, '-', '') || '01:' || lpad(CAST(sequence AS VARCHAR), 4, '0')"


def _scan() -> F.Column:
    return F.concat(F.lit("https://x.test/data/batches/nbu_a_ver01/data/"), "lccn", F.lit("/"), F.when(F.col("doc_id") % 2 == 0, "00175/").otherwise(""), F.translate("date", "-", ""), F.lit("01/"), F.lpad(F.col("sequence").cast("string"), 4, "0"), F.lit(".jp2"))


_TRIMMED = "trim(text, chr(32) || chr(9) || chr(10) || chr(13))"
_CHUNKS_SQL = f"""{PAGES_SQL}, {PUBS_SQL},
w AS (SELECT *, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '') AS ws FROM pages_v WHERE length({_TRIMMED}) >= 30),
c AS (SELECT *, unnest(range(0, CAST(ceil(len(ws) / 100) AS BIGINT))) AS i FROM w),
r AS (SELECT doc_id, c.slug || '#' || date || '#ed-' || edition || '#p' || lpad(CAST(sequence AS VARCHAR), 2, '0') AS page, c.slug, p.title, p.region, p.city, p.state_name, lccn, date, year, month, day,
  CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month <= 5 THEN 'Spring' WHEN month <= 8 THEN 'Summer' ELSE 'Fall' END AS season, sequence, CAST(i AS INTEGER) AS chunk_index, CAST(ceil(len(ws) / 100) AS INTEGER) AS chunk_count,
  CAST(least(100, len(ws) - i * 100) AS INTEGER) AS token_count, array_to_string(ws[i * 100 + 1 : (i + 1) * 100], ' ') AS text, {_SCAN_SQL} AS image_url, '{_IMAGES}/' || {_ID_SQL} AS image FROM c LEFT JOIN (SELECT slug, title, region, city, state_name FROM pubs) p ON c.slug = p.slug)"""


def _chunked(spark: SparkSession, sf: str, streamed: bool = False) -> DataFrame:
    p = pages(spark, sf).withColumn("image_url", _scan())
    return rec.chunk_records(p.drop("state"), publications(spark, sf), _IMAGES, lambda df: word_chunks(df, 100), streamed)


@query(f"""WITH {_CHUNKS_SQL} SELECT page || '#c' || CASE WHEN chunk_index < 10 THEN '0' ELSE '' END || chunk_index AS _id, text, page AS parent_page_id, title AS newspaper_title, slug AS newspaper_slug, region, city, state_name AS state, lccn, date, year, month, day, season,
  1 AS edition, sequence, chunk_index, chunk_count, token_count, '' AS loc_page_url, '' AS pdf_url, image_url, image || '/full/600,/0/default.jpg' AS iiif_thumb_url FROM r""")
def chunk_records(spark: SparkSession, sf: str) -> DataFrame:
    return _chunked(spark, sf)


@query(f"""WITH {_CHUNKS_SQL} SELECT page AS parent_page_id, slug AS newspaper_slug, season, chunk_index, chunk_count, image_url AS file_path FROM r""")
def chunk_records_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The variant that incremental ingest writes, without token counts."""
    out = _chunked(spark, sf, streamed=True)
    assert "token_count" not in out.columns
    return out.select("parent_page_id", "newspaper_slug", "season", "chunk_index", "chunk_count", "file_path")


_ESCAPED = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"


@query(f"""WITH {_CHUNKS_SQL} SELECT page || '#c' || CASE WHEN chunk_index < 10 THEN '0' ELSE '' END || chunk_index AS id, date, 1 AS edition, sequence, season, chunk_index + 1 AS chunk_number, chunk_count, length(text) AS char_count,
  {_ESCAPED.format('substring(text, 1, 450)')} || CASE WHEN length(text) > 450 THEN '...' ELSE '' END AS excerpt, coalesce(title, 'Historical Broadsheet') AS newspaper_title, coalesce(city, 'Unknown') AS newspaper_city, coalesce(state_name, 'Unknown') AS newspaper_state,
  image || '/full/600,/0/default.jpg' AS thumb_url, image || '/full/1600,/0/default.jpg' AS high_res_url FROM r""")
def hit_cards(spark: SparkSession, sf: str) -> DataFrame:
    hits = _chunked(spark, sf).select("_id", *rec.HIT_FIELDS)
    return rec.hit_cards(hits, publications(spark, sf), _IMAGES)


@query(f"""WITH {PAGES_SQL}, {PUBS_SQL}, chosen AS (SELECT 'region' AS choice, slug FROM pubs WHERE region = 'west' UNION ALL SELECT 'title', slug FROM pubs WHERE slug = 'src1'
  UNION ALL SELECT 'state', slug FROM pubs WHERE state_name = 'State 2' UNION ALL SELECT 'list', slug FROM pubs WHERE slug IN ('src3', 'src4') UNION ALL SELECT 'all', slug FROM pubs)
SELECT choice, p.slug, doc_id FROM pages_v p JOIN chosen c ON p.slug = c.slug WHERE month = 5 AND sequence = 1 AND (choice <> 'all' OR day = 5)""")
def filter_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Choices of a search form: a region over a state, a newspaper over both, months as they are shown."""
    dim, p = publications(spark, sf), pages(spark, sf)
    choices = {
        "region": {"region": "West", "state": "State 2"}, "title": {"newspaper": "news of The Daily src1.", "region": "west"},
        "state": {"state": " state 2 "}, "list": {"newspaper": ["src3", "src4"]}, "all": {"newspaper": "(all)", "state": "All States"},
    }
    parts = [flt.chosen(p, flt.publications(dim, **c), "05 - May", "05" if name == "all" else "(any)", front_page=True).select(F.lit(name).alias("choice"), "slug", "doc_id") for name, c in choices.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("""SELECT p_partkey, coalesce(CAST(nullif(p_size % 5, 0) + 1890 AS VARCHAR), '?') || '-' || coalesce(CAST(nullif(p_size % 3, 0) + 1910 AS VARCHAR), '?') AS years,
  coalesce(round(s / 1048576.0, 2), 0.0) AS size_mb, coalesce(round(s / 1073741824.0, 2), 0.0) AS size_gb FROM (SELECT *, CASE WHEN p_size % 7 <> 0 THEN CAST(p_partkey * 7777777 AS BIGINT) END AS s FROM part)""")
def formatted_dims(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("s", F.when(F.col("p_size") % 7 != 0, F.col("p_partkey") * 7777777))
    year = lambda n, base: F.when(F.col("p_size") % n != 0, F.col("p_size") % n + base)
    return p.select("p_partkey", rec.active_years(year(5, 1890), year(3, 1910)).alias("years"), rec.in_units(F.col("s"), 2).alias("size_mb"), rec.in_units(F.col("s"), 3).alias("size_gb"))


@query("""WITH n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'nbu_' END || 'b' || c_custkey AS name FROM customer)
SELECT name, CASE WHEN k % 5 = 0 AND k > 0 THEN k WHEN k % 3 = 0 AND k % 2 = 1 THEN k * 10 WHEN k % 7 = 0 THEN k * 100 END AS size_bytes,
  CASE WHEN k % 5 = 0 AND k > 0 THEN 'given' WHEN k % 3 = 0 AND k % 2 = 1 THEN 'catalog' WHEN k % 7 = 0 THEN 'remote' WHEN k % 3 = 0 THEN 'catalog' ELSE 'name' END AS origin, CASE WHEN k % 4 <> 0 THEN 'nbu' END AS awardee FROM n""")
def batch_info(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    n = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.when(F.col("c_custkey") % 4 == 0, "").otherwise("nbu_"), F.lit("b"), F.col("c_custkey").cast("string")).alias("name"))
    sized = lambda n, size: n.select("name", size.cast("long").alias("size_bytes"))
    return rec.batch_info(n, sized(n.filter(k % 5 == 0), k), sized(n.filter(k % 3 == 0), F.when(k % 2 == 1, k * 10)), sized(n.filter(k % 7 == 0), k * 100))


@query("""SELECT doc_id, list_transform(range(0, 16), lambda b: CAST(len(list_filter(ts, lambda t: ascii(t) % 16 = b)) AS DOUBLE)) AS embedding
FROM (SELECT doc_id, list_filter(string_split_regex(lower(CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE text END), '[^a-z0-9]+'), lambda w: w <> '') AS ts FROM documents)""")
def embedded_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A pluggable embedder over texts, some of them blank."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("text"))
    return rec.embedded(d).select("doc_id", "embedding")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN 'missing' WHEN p_partkey % 7 = 0 THEN 'unlisted' WHEN p_partkey % 5 = 0 THEN 'changed' ELSE 'ok' END AS state FROM part WHERE NOT (p_partkey % 11 = 0 AND p_partkey % 7 = 0)""")
def checksum_states(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("data/"), k.cast("string")).alias("path"), F.concat_ws(" ", "p_name", "p_brand", k.cast("string")).cast("binary").alias("content"))
    listed = p.filter(k % 7 != 0).select("path", F.when(k % 5 == 0, F.md5(F.lit(b"x"))).otherwise(F.upper(F.md5("content"))).alias("checksum"))
    return rec.verified(p.filter(k % 11 != 0).select("path", "content"), listed).select(F.substring_index("path", "/", -1).cast("long").alias("id"), "state")


@query("SELECT doc_id, source FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 50) ORDER BY md5(CAST(doc_id AS VARCHAR) || ':7'), doc_id LIMIT 3")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return rec.seeded_pick(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 7, k=3)


@query(f"WITH {PAGES_SQL} SELECT doc_id, slug, sequence FROM pages_v WHERE sequence = 3 AND doc_id IN (SELECT vec_id FROM embeddings WHERE label = 1)")
def page_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by their number, fetched by the ids of an index."""
    ids = table(spark, sf, "embeddings").filter("label = 1").select(F.col("vec_id").alias("doc_id"))
    return pages(spark, sf).filter("sequence = 3").join(ids, "doc_id", "left_semi").select("doc_id", "slug", "sequence")


@query(f"""WITH {PAGES_SQL}, t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'old' WHEN doc_id % 3 = 1 THEN 'https://i.test/' || {_ID_SQL} || '/full/600,/0/default.jpg' ELSE replace('https://i.test/' || {_ID_SQL} || '/full/600,/0/default.jpg', '00175', '00000000000') END AS old,
  'https://i.test/' || {_ID_SQL} || '/full/600,/0/default.jpg' AS new FROM pages_v)
SELECT doc_id, new AS thumb, old = new AS same FROM t WHERE old <> new OR contains(old, '00000000000')""")
def repaired_images(spark: SparkSession, sf: str) -> DataFrame:
    """Stored image links worked out anew from the scans: rows that change, or hold the placeholder reel."""
    p = pages(spark, sf).withColumn("new", links.image_url(_scan(), _IMAGES))
    old = F.when(F.col("doc_id") % 3 == 0, "old").when(F.col("doc_id") % 3 == 1, F.col("new")).otherwise(F.replace("new", F.lit("00175"), F.lit("00000000000")))
    p = p.withColumn("old", old).filter(~F.col("old").eqNullSafe(F.col("new")) | F.col("old").contains("00000000000"))
    return p.select("doc_id", F.col("new").alias("thumb"), F.col("old").eqNullSafe(F.col("new")).alias("same"))


@query(f"""WITH {PAGES_SQL} SELECT doc_id, 'https://i.test/' || {_ID_SQL} || '/info.json' AS info, 'https://i.test/' || {_ID_SQL} || '/10,20,300,400/800,/0/default.jpg' AS cropped, 'a/' || doc_id || '/full/pct:50/0/default.jpg' AS half,
  CASE WHEN doc_id % 5 = 0 THEN 'service:ndnp:dlc:batch_dlc_b_ver02:data:' || lccn || ':001:1910120101:0' || (doc_id % 9) ELSE 'service:ndnp:nn:batch_nn_hardin_ver01:data:sn83030193:0028076582A:1910120201:' || lpad(CAST(27 + sequence AS VARCHAR), 4, '0') END AS other FROM pages_v""")
def image_links(spark: SparkSession, sf: str) -> DataFrame:
    number = F.concat(F.lit("0"), (F.col("doc_id") % 9).cast("string"))
    stored = F.concat(F.lit("https://x.test/service/ndnp/dlc/batch_dlc_b_ver02/data/"), "lccn", F.lit("/001/1910120101/"), number, F.lit(".jp2"))
    page = F.lpad(F.col("sequence").cast("string"), 4, "0")
    lacking = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://x.test/batches/nn_hardin_ver01/data/sn83030193/1910120201/"), page, F.lit(".jp2"))).otherwise(F.concat(F.lit("https://x.test/iiif/service:ndnp:nn:batch_nn_hardin_ver01:data:sn83030193:00000000000:1910120201:"), page, F.lit("/full/1,/0/default.jpg")))
    half = links.rescaled(F.concat(F.lit("a/"), F.col("doc_id").cast("string"), F.lit("/full/pct:12.5/0/default.jpg")), 50)
    other = links.image_id(F.when(F.col("doc_id") % 5 == 0, stored).otherwise(lacking))
    return pages(spark, sf).select("doc_id", links.image_info(_scan(), _IMAGES).alias("info"), links.image_url(_scan(), _IMAGES, "800,", "10,20,300,400").alias("cropped"), half.alias("half"), other.alias("other"))


@query(f"""WITH {PAGES_SQL} SELECT lccn || '_' || date || '_' || sequence || '_' || doc_id AS _id, text, 'The ' || slug AS title, lccn, date, edition, sequence, year, month, day, length(text) AS char_count,
  CAST(len(list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '')) AS INTEGER) AS word_count FROM pages_v WHERE length({_TRIMMED}) > 0 ORDER BY date, edition, sequence, doc_id LIMIT 200""")
def export_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for an index, in export order; what it can't take (lists of numbers, reserved names) is left out."""
    p = pages(spark, sf).filter(F.length(F.trim("text", F.lit(" \t\n\r"))) > 0)
    key = F.concat_ws("_", "lccn", "date", F.col("sequence").cast("string"), F.col("doc_id").cast("string"))
    fields = {"title": F.concat(F.lit("The "), "slug"), **{c: F.col(c) for c in ("lccn", "date", "edition", "sequence", "year", "month", "day")}, "boxes": F.array(F.lit(1.5)), "$own": F.lit(1), "doc": F.struct(F.col("doc_id"))}
    rows = p.withColumn("_order", F.struct("date", "edition", "sequence", "doc_id")).orderBy("_order").limit(200)
    return acceptable(export_documents(rows, key, F.col("text"), fields))


@query(f"""WITH {PAGES_SQL} SELECT doc_id, CAST((row_number() OVER (ORDER BY date, doc_id) - 1) // 64 AS INTEGER) AS shard FROM pages_v""")
def shard_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return in_shards(pages(spark, sf).select("doc_id", "date"), ["date", "doc_id"], 64).select("doc_id", "shard")


@query(f"""WITH {PAGES_SQL}, wanted AS (SELECT DISTINCT strftime(o_orderdate, '%m-%d') AS md FROM orders WHERE o_custkey % 40 = 0),
t AS (SELECT doc_id, year, date, CASE WHEN substring(date, 6) IN (SELECT md FROM wanted) THEN 0 WHEN substring(date, 6) IN ('07-07', '12-28') THEN 1 WHEN month = 1 THEN 2 WHEN month = 7 THEN 3 WHEN month = 12 THEN 4 WHEN month = 8 THEN 5 ELSE 6 END AS tier FROM pages_v)
SELECT doc_id, year, tier, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY tier, date, doc_id) AS INTEGER) AS rank FROM t) WHERE rank <= 6""")
def tiered_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of each year: those of reference dates first, then of listed days, then by months in a given order, then any."""
    wanted = table(spark, sf, "orders").filter("o_custkey % 40 = 0").select(F.date_format("o_orderdate", "MM-dd").alias("md")).distinct().withColumn("wanted", F.lit(True))
    p = pages(spark, sf).select("doc_id", "year", "month", "date").withColumn("md", F.substring("date", 6, 5)).join(wanted, "md", "left")
    tiers = [F.coalesce("wanted", F.lit(False)), F.col("md").isin("07-07", "12-28"), *(F.col("month") == m for m in (1, 7, 12, 8))]
    return tiered(p, ["year"], tiers, [F.col("date"), F.col("doc_id")], 6).select("doc_id", "year", "tier", "rank")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'July ' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS label, count(*) AS hits, list_sort(list(DISTINCT o_orderpriority)) AS slugs FROM orders WHERE month(o_orderdate) = 7 AND day(o_orderdate) IN (4, 7) GROUP BY 1, 2""")
def calendar_response(spark: SparkSession, sf: str) -> DataFrame:
    """What lies on some days, by year; years without any are not there."""
    o = table(spark, sf, "orders").select("o_orderdate", "o_orderpriority").filter((F.month("o_orderdate") == 7) & F.dayofmonth("o_orderdate").isin(4, 7))
    label = F.date_format("o_orderdate", "MMMM dd")
    return o.groupBy(F.year("o_orderdate").alias("year"), label.alias("label")).agg(F.count(F.lit(1)).alias("hits"), F.array_sort(F.collect_set("o_orderpriority")).alias("slugs"))


@query("""WITH q AS (SELECT *, CASE page_id % 3 WHEN 0 THEN '"san ' || page_id || '"~2 fire^2' WHEN 1 THEN 'quake~1 "big fire"' ELSE '/fl.*d/ storm~' END AS s FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 1 THEN ['"big fire"'] ELSE [] END AS phrases, CASE WHEN page_id % 3 = 0 THEN ['"san ' || page_id || '"~2'] ELSE [] END AS slop,
  CASE page_id % 3 WHEN 1 THEN ['quake~1'] WHEN 2 THEN ['storm~'] ELSE [] END AS fuzzy, CASE WHEN page_id % 3 = 0 THEN ['fire^2'] ELSE [] END AS boosts, CASE WHEN page_id % 3 = 2 THEN ['/fl.*d/'] ELSE [] END AS patterns FROM q""")
def query_features(spark: SparkSession, sf: str) -> DataFrame:
    """What queries hold besides plain words, a query for each page."""
    k = F.col("page_id") % 3
    text = F.when(k == 0, F.concat(F.lit('"san '), F.col("page_id").cast("string"), F.lit('"~2 fire^2'))).when(k == 1, 'quake~1 "big fire"').otherwise("/fl.*d/ storm~")
    return table(spark, sf, "pages").select("page_id", query_marks(text).alias("m")).select("page_id", "m.*")


@query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(text, chr(160) || chr(8195) || chr(11) || chr(12), ''), '[ \\t\\n\\r]+'), lambda w: w <> '') AS ws FROM documents)
SELECT doc_id, true AS sized, true AS numbered, CAST(len(ws) AS BIGINT) AS words, md5(array_to_string(ws, ' ')) AS said FROM w WHERE len(ws) > 0""")
def recursive_chunk_words(spark: SparkSession, sf: str) -> DataFrame:
    """The recursive chunker's chunks one after the other are the document, word by word; numbered in
    that order, below their count; none has more than 500 tokens."""
    chunks = recursive_chunks(table(spark, sf, "documents").select("doc_id", F.translate("text", "\u00a0\u2003\x0b\x0c", "").alias("text")))
    each = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "token_count", "text"))).alias("cs"), F.max("chunk_count").alias("n"))
    words = F.filter(F.split(F.array_join(F.transform("cs", lambda c: c["text"]), " "), r"[ \t\n\r]+"), lambda w: w != "")
    sized = F.forall("cs", lambda c: c["token_count"] <= 500)
    index = F.transform("cs", lambda c: c["chunk_index"])
    numbered = (index == F.array_distinct(index)) & (F.array_max(index) < F.col("n"))
    return each.select("doc_id", sized.alias("sized"), numbered.alias("numbered"), F.size(words).cast("long").alias("words"), F.md5(F.array_join(words, " ").cast("binary")).alias("said"))


@query("SELECT doc_id, regexp_replace(trim(regexp_replace(lower(source || ' ' || lang), '[^a-z0-9 -]', '', 'g')), '[- ]+', '-', 'g') AS slug, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS number, doc_id % 4 = 0 OR doc_id % 4 = 2 AS listed FROM documents")
def text_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs, digit strings with a default, and lists that come as JSON or with commas."""
    d = table(spark, sf, "documents")
    kinds = F.when(F.col("doc_id") % 4 == 0, '["a", "b"]').when(F.col("doc_id") % 4 == 1, "x, ,y").when(F.col("doc_id") % 4 == 2, "a,b").otherwise('["x"]')
    return d.select("doc_id", tx.slug(F.concat_ws(" ", "source", "lang"), "-").alias("slug"), tx.int_or(F.regexp_extract("source", "[0-9]+", 0), 0).alias("number"), (F.array_join(tx.string_list(kinds), "|") == "a|b").alias("listed"))
