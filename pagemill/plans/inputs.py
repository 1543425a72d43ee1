"""Queries over inputs in the forms that they arrive in: listings, manifests, JSON and XML records, archives, JSON lines.

The forms are written from the driver's tables, and read back by the sources.
"""

from __future__ import annotations

import bz2
import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ranking import numbered_spread
from pagemill.plans import etl, query, table
from pagemill.plans.views import PAGES_SQL, pages
from pagemill.scratch import scratch_path, written
from pagemill.sources import archive_source, archives, layout, listings

_text = lambda c: F.col(c).cast("string")


@query("""SELECT 'nbu_b' || c_custkey AS name, 'nbu' AS awardee, CASE WHEN c_custkey % 3 <> 0 THEN '2020-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS ingested_date,
  CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE CAST(trunc((c_custkey % 100 + 0.5) * 1048576) AS BIGINT) END AS size_bytes, 'NE' AS state, 'https://x.test/ocr/nbu_b' || c_custkey || '.tar.bz2' AS archive_url FROM customer""")
def listing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Directory pages, one for each nation, scraped for archives."""
    k = F.col("c_custkey")
    day = F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit(" 2020-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0")))
    size = F.when(k % 5 == 0, "-").otherwise(F.concat((k % 100).cast("string"), F.lit(".5 MB")))
    row = F.concat(F.lit('<tr>\n <td><a href="nbu_b'), k.cast("string"), F.lit('.tar.bz2">nbu</a></td><td>'), day, F.lit("</td> <td class='r'>"), size, F.lit("</td></tr>"))
    html = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    return listings.batch_listing(html.select(F.concat(F.lit("<table><tr><th>a</th></tr><tr><td><a href='../'>up</a></td></tr>"), "rows", F.lit("</table>")).alias("html")), "https://x.test/ocr/")


@query(f"""WITH {PAGES_SQL}, f AS (SELECT lccn, date, unnest(CASE WHEN doc_id % 2 = 0 THEN ['jp2', 'pdf'] ELSE ['jp2'] END) AS kind, CASE WHEN year % 2 = 0 THEN '00175/' ELSE '' END AS reel, doc_id FROM pages_v),
p AS (SELECT *, 'data/' || lccn || '/' || reel || replace(date, '-', '') || '01/' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.' || kind AS path FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY lccn, date, kind ORDER BY path) AS s FROM p)
SELECT lccn, date, 1 AS edition, CAST(s AS INTEGER) AS sequence, 'https://x.test/b/' || max(path) FILTER (kind = 'jp2') AS image_url, 'https://x.test/b/' || max(path) FILTER (kind = 'pdf') AS pdf_url,
  CASE WHEN CAST(substring(date, 1, 4) AS INTEGER) % 2 = 0 THEN '00175' END AS reel_id FROM n GROUP BY lccn, date, s HAVING max(path) FILTER (kind = 'jp2') IS NOT NULL""")
def manifest_assets(spark: SparkSession, sf: str) -> DataFrame:
    """Images and PDFs of every page, from the lines of a checksum manifest."""
    p = pages(spark, sf)
    kinds = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("jp2"), F.lit("pdf"))).otherwise(F.array(F.lit("jp2")))
    p = p.withColumn("kind", F.explode(kinds))
    path = F.concat(F.lit("data/"), "lccn", F.lit("/"), F.when(F.col("year") % 2 == 0, "00175/").otherwise(""), F.translate("date", "-", ""), F.lit("01/"), F.lpad(_text("doc_id"), 8, "0"), F.lit("."), "kind")
    lines = p.select(F.concat(F.md5(_text("doc_id")), F.lit("  "), path).alias("value"))
    other = p.filter("doc_id % 5 = 0").select(F.explode(F.array(F.lit("bad"), F.lit("d41d data/readme.txt"), F.lit("d41d tags/x/1915070301/1.jp2"))).alias("value"))
    return listings.manifest_assets(lines.unionByName(other), "https://x.test/b/")


@query("SELECT c_custkey AS id, 'Name-' || c_nationkey AS key, c_name || ': ' || c_mktsegment AS text FROM customer WHERE c_custkey % 4 <> 0")
def bag_fields(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    lines = c.select(F.when(F.col("c_custkey") % 4 == 0, F.lit("no field")).otherwise(F.concat(F.lit("Name-"), _text("c_nationkey"), F.lit(" :  "), "c_name", F.lit(": "), "c_mktsegment", F.lit(" "), F.lit("|"), _text("c_custkey"))).alias("value"))
    out = listings.bag_info(lines)
    return out.select(F.substring_index("text", "|", -1).cast("long").alias("id"), "key", F.rtrim(F.substring_index("text", "|", 1)).alias("text"))


@query("""SELECT 'sn' || c_custkey AS lccn, CASE WHEN c_custkey % 4 = 0 THEN 'Unknown' ELSE c_name END AS name, CASE c_custkey % 3 WHEN 0 THEN 'Ohio' WHEN 1 THEN c_mktsegment END AS state, CASE WHEN c_custkey % 2 = 0 THEN 'Omaha' ELSE '' END AS city,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(1880 + c_custkey % 20 AS INTEGER) END AS start_year, CASE WHEN c_custkey % 5 = 2 THEN CAST(1915 AS INTEGER) END AS end_year, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS INTEGER) WHEN 1 THEN 7 END AS issue_count,
  CASE WHEN c_custkey % 5 > 0 THEN (1880 + c_custkey % 20) || '-01-02' END AS first_issue_date, CASE c_custkey % 5 WHEN 2 THEN '1915-12-31' WHEN 1 THEN 'now' END AS last_issue_date, CASE WHEN c_custkey % 6 = 0 THEN 'Czech' WHEN c_custkey % 6 = 1 THEN 'Dutch' END AS ethnicity, 'https://x.test/' || c_custkey AS loc_url FROM customer WHERE c_custkey % 11 <> 0""")
def title_records(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog records in JSON, whose fields are text, lists or objects."""
    k = F.col("c_custkey")
    field = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    said = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    label = lambda v: F.concat(F.lit('{"label": '), v, F.lit("}"))
    parts = F.array(
        F.when(k % 11 != 0, field("number_lccn", F.concat(F.lit("["), said(F.lit("sn"), k.cast("string")), F.lit("]")))),
        F.when(k % 4 == 1, field("title", said("c_name"))).when(k % 4 > 1, field("newspaper_title", F.concat(F.lit("["), said("c_name"), F.lit(", 1]")))),
        F.when(k % 3 == 0, field("location_state", label(F.lit('"Ohio"')))).when(k % 3 == 1, field("location_state", F.concat(F.lit("["), said("c_mktsegment"), F.lit("]")))),
        F.when(k % 2 == 0, field("location_city", F.lit('["Omaha"]'))), F.when(k % 3 == 0, field("number_issue_count", F.concat(F.lit('{"value": '), k.cast("string"), F.lit("}")))).when(k % 3 == 1, field("number_issue_count", F.lit('"7"'))),
        F.when(k % 5 > 0, field("number_first_issue", label(said((1880 + k % 20).cast("string"), F.lit("-01-02"))))),
        F.when(k % 5 == 2, field("number_last_issue", label(F.lit('"1915-12-31"')))).when(k % 5 == 1, field("number_last_issue", label(F.lit('"now"')))),
        F.when(k % 6 == 0, field("subject_ethnicity", label(F.lit('"Czech"')))).when(k % 6 == 1, field("subject_ethnicity", F.lit('"Dutch"'))), field("url", said(F.lit("https://x.test/"), k.cast("string"))),
    )
    return listings.titles(table(spark, sf, "customer").select(F.concat(F.lit("{"), F.array_join(F.filter(parts, lambda p: p.isNotNull()), ", "), F.lit("}")).alias("json")))


@query("""SELECT o_orderkey AS id, 'nbu_b' || o_custkey AS batch, CAST(s + 1 AS INTEGER) AS sequence, 'https://x.test/' || o_orderkey || '/' || s || '.pdf' AS pdf_url, CASE WHEN s % 2 = 0 THEN 'https://x.test/' || o_orderkey || '/' || s || '.jp2' END AS jp2_url,
  'first.jpg' AS thumbnail_url, 't' || s AS text_url, CASE WHEN s % 2 = 0 THEN 600 END AS width FROM (SELECT *, unnest(range(0, 1 + o_orderkey % 3)) AS s FROM orders)""")
def issue_records(spark: SparkSession, sf: str) -> DataFrame:
    """Issues in JSON, flattened to pages with their files by kind."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    url = lambda s, end: F.concat(F.lit('"url": "https://x.test/'), _text("id"), F.lit("/"), s, F.lit(f'.{end}"'))
    files = lambda s: F.concat(F.lit('[{"mimetype": "application/pdf", '), url(s, "pdf"), F.lit('}, {"mimetype": "image/jpeg", "url": "first.jpg"}, {"mimetype": "image/jpeg", "url": "second.jpg"}, {"fulltext_service": "t'), s, F.lit('"}'), F.when(s.cast("int") % 2 == 0, F.concat(F.lit(', {"mimetype": "image/jp2", "width": 600, '), url(s, "jp2"), F.lit("}"))).otherwise(""), F.lit("]"))
    groups = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("id") % 3).cast("int")), lambda s: files(s.cast("string"))), ", ")
    doc = F.concat(F.lit('{"item": {"batch": ["'), F.when(F.col("id") % 2 == 0, "batch_").otherwise(""), F.lit("nbu_b"), _text("o_custkey"), F.lit('"]}, "resources": [{"files": ['), groups, F.lit("]}]}"))
    return listings.issue_pages(o.select("id", doc.alias("json"))).select("id", "batch", "sequence", "pdf_url", "jp2_url", "thumbnail_url", "text_url", "width")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 3 THEN '{not json ' || c_name ELSE c_name END AS text FROM customer")
def unwrapped_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Full texts that come plain, as JSON, or as JSON by page."""
    k = F.col("c_custkey") % 4
    body = F.when(k == 0, F.concat(F.lit('{"/1/ocr": {"full_text": " '), "c_name", F.lit('\\n"}}'))).when(k == 1, F.concat(F.lit(' {"full_text": "'), "c_name", F.lit('"}'))).when(k == 2, F.concat("c_name", F.lit("\n "))).otherwise(F.concat(F.lit("{not json "), "c_name"))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), listings.unwrapped_text(body).alias("text"))


@query("""WITH p AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS s FROM (SELECT * FROM conversations WHERE turn % 3 <> 1))
SELECT c.conv_id, c.lccn, c.date, CAST(n AS INTEGER) AS page_count, coalesce(l, []) AS numbers FROM (SELECT DISTINCT conv_id, 'sn' || conv_id AS lccn, '1915-07-03' AS date FROM conversations) c
LEFT JOIN (SELECT conv_id, list(s || ':p' || turn || ':' || CASE WHEN turn % 2 = 0 THEN turn || '.xml' ELSE '' END ORDER BY s) AS l FROM p GROUP BY 1) USING (conv_id) JOIN (SELECT conv_id, count(*) FILTER (turn % 3 <> 1) AS n FROM conversations GROUP BY 1) USING (conv_id)""")
def issue_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Issue XML, a division for each turn; turns without files are blank pages and have no number."""
    t = _text("turn")
    file = lambda kind: F.concat(F.lit('<file ID="'), F.lit(kind[0]), t, F.lit('"><FLocat href="'), t, F.lit(f'.{kind}"/></file>'))
    files = F.when(F.col("turn") % 3 == 1, "").otherwise(F.concat(file("pdf"), F.when(F.col("turn") % 2 == 0, file("xml")).otherwise("")))
    point = lambda kind: F.concat(F.lit(f'<fptr FILEID="{kind[0]}'), t, F.lit('"/>'))
    div = F.concat(F.lit('<div TYPE="page" ID="p'), t, F.lit('">'), point("pdf"), point("xml"), F.lit("</div>"))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", files.alias("f"), div.alias("d")))).alias("t"))
    joined = lambda name: F.array_join(F.transform("t", lambda x: x[name]), "")
    xml = F.concat(F.lit('<mets LABEL="x"><identifier type="lccn">sn'), _text("conv_id"), F.lit("</identifier><dateIssued>1915-07-03</dateIssued><fileSec>"), joined("f"), F.lit("</fileSec><structMap>"), joined("d"), F.lit("</structMap></mets>"))
    i = c.select("conv_id", layout.issue(xml).alias("i"))
    said = F.transform("i.pages", lambda p: F.concat(_cast(p["sequence"]), F.lit(":"), p["page_id"], F.lit(":"), F.coalesce(p["alto"], F.lit(""))))
    return i.select("conv_id", "i.lccn", "i.date", F.size("i.pages").alias("page_count"), said.alias("numbers"))


def _cast(c):
    return c.cast("string")


@query("SELECT o_orderkey AS id, 'sn' || (o_custkey % 9) AS lccn, '1915-07-' || lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') AS issue_date, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE CAST(o_orderkey % 3 AS INTEGER) END AS edition FROM orders WHERE o_orderkey % 5 <> 0")
def issue_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Issues that batches name in XML, one batch for each customer; those without a path are left out."""
    k = F.col("o_orderkey")
    one = F.concat(F.lit('<issue lccn="sn'), (F.col("o_custkey") % 9).cast("string"), F.lit('" issueDate="1915-07-'), F.lpad((1 + k % 28).cast("string"), 2, "0"), F.when(k % 3 != 0, F.concat(F.lit('" editionOrder="'), (k % 3).cast("string"))).otherwise(""), F.lit('">'), F.when(k % 5 == 0, " ").otherwise(k.cast("string")), F.lit("</issue>"))
    b = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.collect_list(one), "").alias("x"))
    refs = b.select(F.explode(layout.issue_refs(F.concat(F.lit("<batch>"), "x", F.lit("</batch>")))).alias("r"))
    return refs.select(F.col("r.path").cast("long").alias("id"), "r.lccn", "r.issue_date", "r.edition")


@query("SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 300 OFFSET 150")
def json_lines_slice(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines in nested folders, blank and broken ones among them; records 150 to 449 in order."""
    root = scratch_path(spark, "lines")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    e.select(F.to_json(F.struct("event_id", "user_id")).alias("value"), "event_type").write.partitionBy("event_type").text(f"{root}/a")
    e.filter("event_id % 50 = 0").select(F.explode(F.array(F.lit(""), F.lit("{broken"), F.lit('["x"'))).alias("value")).coalesce(1).write.text(f"{root}/b")
    rows = spark.read.schema("event_id long, user_id long").option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(root)
    n = numbered_spread(rows.filter("event_id IS NOT NULL").withColumn("all", F.lit(0)), ["all"], ["event_id"], "n")
    return n.filter("n > 150 AND n <= 450").select("event_id", "user_id")


#: Pages of an archive that the queries write, about.
ARCHIVE_PAGES = 500


def page_members(p: DataFrame, layouts: bool = False) -> DataFrame:
    """OCR files of pages: k (0 to 7), member, content; ``layouts``: a sixth of the pages has layout XML and an empty text."""
    key = F.col("doc_id")
    two = lambda c: F.lpad(_text(c), 2, "0")
    reel = F.when(key % 2 == 0, "00175032496/").otherwise("")
    folder = F.concat("lccn", F.lit("/"), reel, _text("year"), F.lit("/"), two("month"), F.lit("/"), two("day"), F.lit("/ed-"), F.floor(1 + key / 168).cast("string"), F.lit("/seq-"), _text("sequence"))
    p = p.select((key % 8).alias("k"), "doc_id", folder.alias("folder"), F.when((key % 6 == 0) & F.lit(layouts), "").otherwise(F.col("text")).alias("text"), "text")
    p = p.toDF("k", "doc_id", "folder", "told", "text")
    docs = p.select("k", "folder", F.lit("ocr.txt").alias("file"), F.col("told").alias("content"))
    other = p.filter(key % 10 == 0).select("k", "folder", F.lit("notes.md"), F.lit("x"))
    out = docs.union(other)
    if layouts:
        out = out.union(p.filter(key % 6 == 0).select("k", "folder", F.lit("ocr.xml"), etl.layout_xml(F.col("text"))))
    return out.select("k", "folder", F.concat_ws("/", "folder", "file").alias("member"), "content")


def write_archives(rows: DataFrame, root: str, prefix: str = "") -> None:
    """Archives ``<prefix><k>-<n>.tar.bz2`` of OCR files, as many as their number needs; a page's files stay together."""
    pieces = max(1, -(-rows.count() // (8 * ARCHIVE_PAGES)))
    dealt = rows.withColumn("archive", F.concat(F.lit(prefix), _text("k"), F.lit("-"), F.pmod(F.xxhash64("folder"), F.lit(pieces)).cast("string")))
    # Many tasks for each core: what Spark puts together by size is about a task for each, and packing takes long for its size.
    tasks = min(8 * pieces, 16 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt.select("archive", "member", "content").repartition(tasks, "archive")
    written(dealt.groupBy("archive").applyInArrow(_write_archive(root), "archive string, members long"), "archived")


def _write_archive(root: str):
    """Writes one archive; returns what was written."""

    def run(group: pa.Table) -> pa.Table:
        name = group.column("archive")[0].as_py()
        system, folder = archives.store_of(root)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{name}.part", compression=None) as out:
            with bz2.BZ2File(out, "w") as packed, tarfile.open(fileobj=packed, mode="w|") as tar:
                for member, content in zip(group.column("member"), group.column("content"), strict=True):
                    data = (content.as_py() or "").encode()
                    info = tarfile.TarInfo(member.as_py())
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        system.move(f"{folder}/{name}.part", f"{folder}/{name}.tar.bz2")  # whole from the first moment on
        return pa.table({"archive": [name], "members": pa.array([group.num_rows], pa.int64())})

    return run


def _write_broken(root: str, prefix: str):
    """Archives that end in the midst of a member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("k").to_pylist():
                system, folder = archives.store_of(root)
                system.create_dir(folder, recursive=True)
                info = tarfile.TarInfo(f"{k}/ocr.txt")
                info.size = 10_000
                data = bz2.compress(info.tobuf() + bytes(range(256)) * 30)
                with system.open_output_stream(f"{folder}/{prefix}{k}-0.tar.bz2", compression=None) as out:
                    out.write(data[: len(data) // 2])
            yield pa.RecordBatch.from_arrays([batch.column("k")], names=["k"])

    return run


@query(f"""WITH {PAGES_SQL}, a AS (SELECT *, 1 + doc_id // 168 AS ed, doc_id % 8 AS k FROM pages_v)
SELECT lccn, date, CAST(ed AS INTEGER) AS edition, sequence, text AS txt, NULL AS problem FROM a WHERE k NOT IN (2, 5) UNION ALL SELECT DISTINCT 'a' || k, NULL, NULL, NULL, NULL, 'broken' FROM a WHERE k IN (2, 5)""")
def archive_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Archives that arrive in two lots, a broken one in each: pages of the whole ones, and what was set apart."""
    root, members = scratch_path(spark, "archive-stream"), page_members(pages(spark, sf))
    for lot in (0, 1):
        rows, bad = members.filter(F.col("k") % 2 == lot), F.col("k").isin(2, 5)
        write_archives(rows.filter(~bad), f"{root}/in", f"lot{lot}-")
        written(rows.filter(bad).select("k").distinct().mapInArrow(_write_broken(f"{root}/in", f"lot{lot}-"), "k long"), "broken")
        archive_source.run(spark, f"{root}/in", f"{root}/out")
    none = lambda t: F.lit(None).cast(t)
    good = archive_source.page_store(spark, f"{root}/out").read().select("lccn", "date", "edition", "sequence", "txt", none("string").alias("problem"))
    apart = archive_source.quarantine(spark, f"{root}/out").read()
    apart = apart.select(F.concat(F.lit("a"), F.regexp_extract("archive", r"lot\d-(\d)-", 1)).alias("lccn"), none("string").alias("date"), none("int").alias("edition"), none("int").alias("sequence"), none("string").alias("txt"), F.when(F.length("problem") > 0, "broken").alias("problem"))
    return good.unionByName(apart)


#: What is left of a text that was written as layout: its words, line by line.
_LINES_SQL = r"""list_filter(list_transform(string_split(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), chr(10)), lambda x: array_to_string(list_filter(string_split_regex(x, '[ \t\n\r]+'), lambda w: w <> ''), ' ')), lambda x: x <> '')"""
_ARCHIVE_SQL = f"""{PAGES_SQL}, a AS (SELECT *, 1 + doc_id // 168 AS ed, 'nbu_' || doc_id % 8 || '_ver01' AS batch, CASE WHEN doc_id % 6 = 0 THEN array_to_string(lines, chr(10)) ELSE text END AS raw, trim(CASE WHEN doc_id % 6 = 0 THEN array_to_string(lines, chr(10)) ELSE text END, chr(32) || chr(9) || chr(10) || chr(13)) AS clean,
  CASE WHEN doc_id % 6 = 0 THEN list_sum(list_transform(lines, lambda x: len(string_split(x, ' ')))) ELSE 0 END AS words FROM (SELECT *, {_LINES_SQL} AS lines FROM pages_v)),
r AS (SELECT lccn || '_' || date || '_ed-' || ed || '_seq-' || sequence AS _id, *, 'Paper ' || slug AS name FROM a WHERE clean <> '')"""


def _page_table(spark: SparkSession, sf: str) -> str:
    """The documents as archives, archives as a page table of two batches, the second of which is run twice."""
    root, key = scratch_path(spark, "archives"), F.col("doc_id")
    p = pages(spark, sf).withColumn("ed", (1 + F.floor(key / 168)).cast("string"))
    write_archives(page_members(pages(spark, sf), layouts=True), root)
    members = written(archives.archive_pages(archives.read_members(spark, root)), "archive-pages")
    titles = pages(spark, sf).filter("slug != 'src1'").select("lccn", F.concat(F.lit("Paper "), "slug", F.lit(" (Omaha, Neb.) 1915-19??")).alias("name"), F.lit("Omaha").alias("city"), F.lit("Nebraska").alias("state")).distinct()
    assets = p.filter(key % 3 == 0).select("lccn", "date", F.col("ed").cast("int").alias("edition"), "sequence", F.concat(F.lit("own/"), _text("doc_id"), F.lit(".jp2")).alias("image_url"), F.lit(None).cast("string").alias("pdf_url"), F.lit(None).cast("string").alias("reel_id"))
    out = scratch_path(spark, "page-table")
    for batch in (0, 1, 1):  # eight archives, two batches of four
        mine = members.filter(F.pmod(F.regexp_extract("archive", r"/(\d)-\d+\.tar\.bz2$", 1).cast("int"), F.lit(2)) == batch)
        etl.write_pages(etl.page_table(mine, titles, assets, f"nbu_{batch}_ver01", "https://v.test", "https://x.test"), out)
    return out


@query(f"""WITH {_ARCHIVE_SQL} SELECT _id, clean AS text, CASE WHEN slug = 'src1' THEN 'Newspaper ' || left(lccn, length(lccn) - 4) ELSE name END AS newspaper_title, year, month, day, CASE WHEN slug = 'src1' THEN 'Unknown' ELSE 'Omaha' END AS city, CASE WHEN slug = 'src1' THEN 'Unknown' ELSE 'Nebraska' END AS state,
  'nbu_' || doc_id % 2 || '_ver01' AS source_batch, 'University of Nebraska-Lincoln' AS awardee, length(raw) AS char_count, 'inch1200' AS page_unit, 'Unknown' AS ocr_engine, CAST(words AS INTEGER) AS n_words,
  CASE WHEN doc_id % 3 = 0 THEN 'own/' || doc_id || '.jp2' ELSE 'https://x.test/batches/nbu_' || doc_id % 2 || '_ver01/data/' || lccn || '/' || CASE WHEN doc_id % 2 = 0 THEN '00175032496/' ELSE '' END || replace(date, '-', '') || lpad(CAST(ed AS VARCHAR), 2, '0') || '/' || lpad(CAST(sequence AS VARCHAR), 4, '0') || '.jp2' END AS image_url,
  'https://v.test/resource/' || lccn || '/' || date || '/ed-' || ed || '/?sp=' || sequence AS page_url FROM r WHERE year >= 1900""")
def page_table_years(spark: SparkSession, sf: str) -> DataFrame:
    """From archives to the partitioned page table, read back from one year on: only its partitions are read."""
    rows = spark.read.parquet(_page_table(spark, sf)).filter("year >= 1900")
    return rows.select("_id", "text", "newspaper_title", "year", "month", "day", "city", "state", "source_batch", "awardee", "char_count", "page_unit", "ocr_engine", F.size("words").alias("n_words"), "image_url", "page_url")


@query(f"""WITH {_ARCHIVE_SQL} SELECT lccn, CASE WHEN slug = 'src1' THEN 'Newspaper ' || lccn ELSE name || ' (Omaha, Neb.) 1915-19??' END AS title, count(*) AS total_pages, min(year) || '-' || max(year) AS years FROM r GROUP BY 1, 2""")
def catalog_written(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog of the page table, written in both forms and read back from both."""
    out = scratch_path(spark, "catalog")
    etl.write_catalog(etl.catalog(spark, _page_table(spark, sf)), out)
    columns = ["lccn", "title", "total_pages", "years"]
    both = spark.read.json(f"{out}/jsonl").select(*columns).intersect(spark.read.parquet(f"{out}/parquet").select(*columns))
    return both
