"""Queries over pages: rollups, samples, identifiers, exports, text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import links, text as tx
from pagemill.operators.export import export_documents, violations
from pagemill.operators.ranking import first_middle_last, numbered_spread, tiered
from pagemill.operators.search import zero_filled
from pagemill.plans import query, table
from pagemill.plans.views import PAGES_SQL, TERMS_SQL, pages, with_id


@query(f"WITH {PAGES_SQL} SELECT doc_id, year, slug, substring(text, 1, 150) AS excerpt FROM pages_v WHERE year >= 1900 AND text ILIKE '%TION%'")
def recipe_ilike_excerpt(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).filter((F.col("year") >= 1900) & F.col("text").ilike("%TION%")).select("doc_id", "year", "slug", F.substring("text", 1, 150).alias("excerpt"))


@query(f"""WITH {PAGES_SQL} SELECT year, count(*) AS pages, CAST(sum(len(list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> ''))) AS BIGINT) AS words FROM pages_v GROUP BY 1""")
def year_rollup(spark: SparkSession, sf: str) -> DataFrame:
    n = F.size(F.filter(F.split("text", r"[ \t\n\r]+"), lambda w: w != "")).cast("long")
    return pages(spark, sf).groupBy("year").agg(F.count(F.lit(1)).alias("pages"), F.sum(n).alias("words"))


@query(f"""WITH {PAGES_SQL} SELECT lccn, min(slug) AS slug, count(DISTINCT date) AS issue_count, count(*) AS total_pages, round(sum(n_chars) / 1048576.0, 2) AS size_mb,
  min(year) AS first_year, max(year) AS last_year, list_sort(list(DISTINCT year)) AS years FROM pages_v GROUP BY 1""")
def catalog_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).groupBy("lccn").agg(F.min("slug").alias("slug"), F.countDistinct("date").alias("issue_count"), F.count(F.lit(1)).alias("total_pages"), F.round(F.sum("n_chars") / 1048576.0, 2).alias("size_mb"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.array_sort(F.collect_set("year")).alias("years"))


@query(f"""WITH {PAGES_SQL} SELECT substring(date, 6) AS month_day, count(*) FILTER (sequence = 1) AS fronts, list_sort(list(DISTINCT year)) AS years, list_sort(list(DISTINCT slug)) AS slugs FROM pages_v GROUP BY 1""")
def calendar_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).groupBy(F.substring("date", 6, 5).alias("month_day")).agg(F.count_if(F.col("sequence") == 1).alias("fronts"), F.array_sort(F.collect_set("year")).alias("years"), F.array_sort(F.collect_set("slug")).alias("slugs"))


@query(f"""WITH {PAGES_SQL}, dims AS (SELECT * FROM (SELECT DISTINCT slug FROM pages_v), (SELECT DISTINCT year FROM pages_v))
SELECT slug, year, count(doc_id) AS hits FROM dims LEFT JOIN (SELECT * FROM pages_v WHERE text ILIKE '%password%') USING (slug, year) GROUP BY 1, 2""")
def zero_filled_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = pages(spark, sf)
    # Distinct names of two dimensions, not rows of the collection.
    dims = p.select("slug").distinct().crossJoin(p.select("year").distinct())
    return zero_filled(p.filter(F.col("text").ilike("%password%")), dims, ["slug", "year"])


@query(f"""WITH {PAGES_SQL} SELECT year, slug, count(*) AS n FROM pages_v GROUP BY GROUPING SETS ((year, slug), (year), ())""")
def namespace_stats(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).rollup("year", "slug").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {PAGES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY date, doc_id) - 1 AS k, count(*) OVER (PARTITION BY slug) AS c FROM pages_v)
SELECT doc_id, slug, date FROM n WHERE k = 0 OR k = c // 2 OR k = c - 1""")
def sample_first_mid_last(spark: SparkSession, sf: str) -> DataFrame:
    return first_middle_last(pages(spark, sf).select("doc_id", "slug", "date"), ["slug"], ["date", "doc_id"])


@query(f"""WITH {PAGES_SQL}, t AS (SELECT doc_id, year, date, CASE WHEN date LIKE '%-01-01' THEN 0 WHEN month = 7 THEN 1 WHEN month IN (8, 12) THEN 2 ELSE 3 END AS tier FROM pages_v)
SELECT doc_id, year, date, tier, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY tier, date, doc_id) AS INTEGER) AS rank FROM t) WHERE rank <= 5""")
def tiered_pick(spark: SparkSession, sf: str) -> DataFrame:
    p = pages(spark, sf).select("doc_id", "year", "month", "date")
    return tiered(p, ["year"], [F.col("date").endswith("-01-01"), F.col("month") == 7, F.col("month").isin(8, 12)], [F.col("date"), F.col("doc_id")], 5).drop("month")


@query(f"""WITH {PAGES_SQL} SELECT doc_id, lccn || '_' || date || '_ed-' || edition || '_seq-' || sequence AS page_id,
  slug || '#' || date || '#ed-' || edition || '#p' || lpad(CAST(sequence AS VARCHAR), 2, '0') || '#c00' AS chunk_id FROM pages_v""")
def page_ids(spark: SparkSession, sf: str) -> DataFrame:
    p = with_id(pages(spark, sf))
    return p.select("doc_id", "page_id", links.chunk_id(F.col("slug"), F.col("date"), F.col("edition"), F.col("sequence"), F.lit(0)).alias("chunk_id"))


@query("""SELECT doc_id, length(text) AS char_count, CAST(len(list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '')) AS BIGINT) AS word_count,
  CAST(len(string_split(text, chr(10))) AS BIGINT) AS line_count FROM documents WHERE length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) >= 30""")
def page_stats(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter(F.length(F.trim("text", F.lit(" \t\n\r"))) >= 30)
    n = F.size(F.filter(F.split("text", r"[ \t\n\r]+"), lambda w: w != ""))
    return d.select("doc_id", F.length("text").cast("long").alias("char_count"), n.cast("long").alias("word_count"), F.size(F.split("text", "\n")).cast("long").alias("line_count"))


@query("""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(t, '\\s*\\([^)]*\\).*', '')), '[0-9]{4}[-–][0-9?]{4}$', '')), '[0-9]{4}$', '')), ''), t) AS title,
  regexp_replace(trim(regexp_replace(lower(t), '[^\\p{L}\\p{N}_\\s-]', '', 'g')), '[-\\s]+', '_', 'g') AS slug
FROM (SELECT p_partkey, p_name || ' (' || p_brand || ', Neb.) ' || CAST(1800 + p_size AS VARCHAR) || '-19??' AS t FROM part)""")
def title_clean(spark: SparkSession, sf: str) -> DataFrame:
    title = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(", Neb.) "), (1800 + F.col("p_size")).cast("string"), F.lit("-19??"))
    return table(spark, sf, "part").select("p_partkey", title.alias("t")).select("p_partkey", tx.clean_title(F.col("t")).alias("title"), tx.slug(F.col("t")).alias("slug"))


@query("""SELECT page_id, regexp_extract(u, '/(?:resource|item)/([^/?]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/ed-([0-9]+)', 1) AS lccn, '1915-07-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS date,
  CAST(1 + page_id % 3 AS INTEGER) AS edition FROM (SELECT page_id, 'https://x.test/resource/sn' || page_id || '/1915-07-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') || '/ed-' || (1 + page_id % 3) || '/?st=gallery' AS u FROM pages)""")
def url_parse(spark: SparkSession, sf: str) -> DataFrame:
    day, ed = F.lpad((1 + F.col("page_id") % 28).cast("string"), 2, "0"), (1 + F.col("page_id") % 3).cast("string")
    # All shapes of URL name the same issue.
    start = F.concat(F.lit("https://x.test/"), F.get(F.array(*map(F.lit, ("resource", "item", "lccn"))), F.col("page_id") % 3), F.lit("/sn"), F.col("page_id").cast("string"))
    url = F.when(F.col("page_id") % 2 == 0, F.concat(start, F.lit("/1915-07-"), day, F.lit("/ed-"), ed, F.lit("/?st=gallery"))).otherwise(F.concat(start, F.lit("/191507"), day, F.lpad(ed, 2, "0"), F.lit("/")))
    return table(spark, sf, "pages").select("page_id", links.issue_of_url(url).alias("i")).select("page_id", "i.lccn", "i.date", "i.edition")


@query("""SELECT page_id, unnest(list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda h: h <> '')) AS href FROM pages""")
def href_scrape(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.explode(F.filter(links.links_in(F.col("html")), lambda h: h != "")).alias("href"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path, CAST(row_number() OVER (PARTITION BY host ORDER BY path, page_id) AS INTEGER) AS sequence,
  first_value(path) OVER (PARTITION BY host ORDER BY path, page_id) AS first_path FROM p""")
def asset_sequencing(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path"))
    first = p.groupBy("host").agg(F.min("path").alias("first_path"))
    return numbered_spread(p, ["host"], ["path", "page_id"], "sequence").withColumn("sequence", F.col("sequence").cast("int")).join(first, "host").select("page_id", "host", "path", "sequence", "first_path")


@query(f"""WITH {PAGES_SQL} SELECT doc_id, 'newspapers/' || state || '/' || slug || '/' || year || '/' || slug || '_' || replace(date, '-', '_') || '.parquet' AS dest, year AS file_year FROM pages_v""")
def path_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    flat = F.concat(F.lit("newspapers/"), "state", F.lit("/"), "slug", F.lit("/"), "slug", F.lit("_"), F.translate("date", "-", "_"), F.lit(".parquet"))
    p = pages(spark, sf).select("doc_id", links.partitioned_path(flat).alias("dest"))
    return p.withColumn("file_year", links.year_of_file(F.col("dest")))


@query(f"""WITH {PAGES_SQL}, m AS (SELECT p.doc_id, slug, coalesce(CASE WHEN l.toxic = 1 THEN 'batch_' || l.quality END, slug) AS batch FROM pages_v p LEFT JOIN labels l ON p.doc_id = l.doc_id)
SELECT doc_id, slug, batch FROM m WHERE slug IS DISTINCT FROM batch""")
def manifest_left_join_patch(spark: SparkSession, sf: str) -> DataFrame:
    p, m = pages(spark, sf).select("doc_id", "slug"), table(spark, sf, "labels").filter("toxic = 1").select("doc_id", F.concat(F.lit("batch_"), F.col("quality").cast("string")).alias("new"))
    patched = p.join(m, "doc_id", "left").withColumn("batch", F.coalesce("new", "slug"))
    return patched.filter(~F.col("slug").eqNullSafe(F.col("batch"))).select("doc_id", "slug", "batch")


@query("""SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> '') AS full_text, count(*) AS page_count FROM conversations GROUP BY 1""")
def doc_assembly(spark: SparkSession, sf: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"), F.count(F.lit(1)).alias("page_count"))
    return c.select("conv_id", F.array_join(F.transform(F.filter("t", lambda x: x["text"] != ""), lambda x: x["text"]), "\n\n").alias("full_text"), "page_count")


@query("""SELECT c.conv_id, c.turn, 'c' || c.conv_id || '_seq-' || c.turn AS _id, n AS page_count, len(string_split_regex(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '[ \\t\\n\\r]+')) AS word_count
FROM conversations c JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) USING (conv_id) WHERE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) <> ''""")
def issue_export(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    c = c.join(c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("page_count")), "conv_id")
    c = c.withColumn("_id", F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_seq-"), F.col("turn").cast("string")))
    out = export_documents(c, F.col("_id"), F.col("text"), {"conv_id": F.col("conv_id"), "turn": F.col("turn"), "page_count": F.col("page_count")})
    return out.filter("word_count IS NOT NULL").select("conv_id", "turn", "_id", "page_count", F.col("word_count").cast("long").alias("word_count"))


@query(f"""WITH {PAGES_SQL}, x AS (SELECT CASE WHEN doc_id % 7 = 0 THEN '' ELSE lccn || '_' || date || '_' || sequence END AS _id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS text FROM pages_v),
v AS (SELECT _id, 'blank_id' AS rule FROM x WHERE trim(_id) = '' UNION ALL SELECT _id, 'no_text' FROM x WHERE text IS NULL UNION ALL SELECT _id, 'duplicate_id' FROM x WHERE trim(_id) <> '' GROUP BY _id HAVING count(*) > 1)
SELECT rule, count(*) AS n, count(DISTINCT _id) AS ids FROM v GROUP BY 1""")
def export_violations(spark: SparkSession, sf: str) -> DataFrame:
    p = pages(spark, sf)
    bad = p.select(F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.concat_ws("_", "lccn", "date", F.col("sequence").cast("string"))).alias("_id"), F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("text"))
    return violations(bad).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids"))


def _ocr_sql(text: str) -> str:
    return f"""w AS (SELECT doc_id, length({text}) AS chars, length(regexp_replace({text}, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace({text}, '[^\\^~|_*\\\\§#<>{{}}\\[\\]=@`]', '', 'g')) AS symbols,
  list_transform(regexp_extract_all({text}, '[a-zA-Z]+'), lambda x: lower(x)) AS ws FROM documents),
r AS (SELECT doc_id, len(ws) AS n, letters / nullif(chars, 0) AS a, symbols / nullif(chars, 0) AS s, len(list_filter(ws, lambda x: regexp_matches(x, '[aeiouy]'))) / nullif(len(ws), 0) AS v,
  len(list_filter(ws, lambda x: x IN ({", ".join(f"'{w}'" for w in tx.COMMON_WORDS)}))) / nullif(len(ws), 0) AS c,
  len(list_filter(ws, lambda x: length(x) = 1 AND x NOT IN ('a', 'i'))) / nullif(len(ws), 0) AS f FROM w),
o AS (SELECT doc_id, CAST(n AS BIGINT) AS n_words, round(coalesce(a, 0), 3) AS alpha_ratio, round(coalesce(v, 0), 3) AS vowel_ratio, round(coalesce(c, 0), 3) AS common_ratio,
  CASE WHEN n = 0 THEN 0.0 ELSE greatest(0, 100 - (CASE WHEN a < 0.6 THEN 35 WHEN a < 0.72 THEN 15 ELSE 0 END) - (CASE WHEN s > 0.03 THEN 30 WHEN s > 0.01 THEN 15 ELSE 0 END) - (CASE WHEN v < 0.8 THEN 30 WHEN v < 0.9 THEN 15 ELSE 0 END)
  - (CASE WHEN c < 0.1 THEN 25 WHEN c < 0.18 THEN 10 ELSE 0 END) - (CASE WHEN f > 0.1 THEN 25 ELSE 0 END)) / 100 END AS score FROM r)"""


@query(f"WITH {_ocr_sql('text')} SELECT * FROM o")
def ocr_quality(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.ocr_quality(F.col("text")).alias("q")).select("doc_id", "q.n_words", "q.alpha_ratio", "q.vowel_ratio", "q.common_ratio", "q.score")


@query(f"""WITH {_ocr_sql('substring(text, 1, 900)')}, m AS (SELECT *, doc_id % 10 / 20 AS noise, doc_id % 7 / 10 AS flaws, doc_id % 9 / 12 AS gibberish FROM o),
h AS (SELECT *, CAST(round_even(50 * least(greatest(0, 1 - (0.6 * noise + 0.4 * flaws)), 1 - gibberish) + 50 * score, 0) AS INTEGER) AS total FROM m)
SELECT doc_id, total, CASE WHEN total >= 70 AND noise < 0.35 AND score >= 0.65 THEN 'GOOD_OCR' WHEN total <= 45 OR noise >= 0.55 OR score <= 0.35 OR gibberish >= 0.7 THEN 'BAD_OCR' ELSE 'MARGINAL_OCR' END AS verdict FROM h""")
def ocr_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Composite verdicts from the first 900 characters; the model's probabilities are stood in for by the id."""
    part = lambda n, of: (F.col("doc_id") % n) / of
    d = table(spark, sf, "documents").select("doc_id", tx.ocr_quality(F.substring("text", 1, 900))["score"].alias("score"))
    total, verdict = tx.ocr_verdict(F.col("score"), part(10, 20), part(7, 10), part(9, 12))
    return d.select("doc_id", total.alias("total"), verdict.alias("verdict"))


@query(f"""WITH v AS (SELECT term, count(*) AS n FROM (SELECT unnest({TERMS_SQL.format('text')}) AS term FROM documents) GROUP BY 1)
SELECT term, n, CAST(levenshtein(term, 'thering') AS INTEGER) AS distance FROM v WHERE levenshtein(term, 'thering') <= 1""")
def fuzzy_terms(spark: SparkSession, sf: str) -> DataFrame:
    # Edit distances of the vocabulary, not of every occurrence.
    v = table(spark, sf, "documents").select(F.explode(tx.terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return v.filter(tx.near_terms(F.col("term"), "thering")).withColumn("distance", F.levenshtein("term", F.lit("thering")))


@query("""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\\s]+', ' ', 'g')) AS flat FROM documents)
SELECT doc_id, CASE WHEN length(flat) <= 260 THEN flat ELSE CASE WHEN contains(substring(flat, 1, 260), ' ') THEN regexp_replace(substring(flat, 1, 260), ' [^ ]*$', '') ELSE substring(flat, 1, 260) END || ' …' END AS snippet FROM t""")
def snippets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.snippet(F.col("text")).alias("snippet"))
