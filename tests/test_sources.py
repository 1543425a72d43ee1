import io
import tarfile

from pyspark.sql import functions as F

from pagemill.plans import etl
from pagemill.sources import archives, layout, listings

WORDS = (("A", 30, 40, 60, 90, ".5"), ("SHIP", 150, 40, 310, 90, ".75"), ("came", 30, 200, 205, 80, ""), ("in.", 260, 200, 120, 80, "1.0"))


def alto():
    word = lambda i, t, x, y, w, h, c: f'<String ID="w{i}" CONTENT="{t}" HPOS="{x}" VPOS="{y}" WIDTH="{w}" HEIGHT="{h}"' + (f' WC="{c}"' if c else "") + "/>"
    lines = ["".join(word(i, *WORDS[i]) for i in at) for at in ((0, 1), (2, 3))]
    body = "".join(f"<TextLine>{x}</TextLine>" for x in lines)
    return f'<alto xmlns="urn:own"><MeasurementUnit>pixel</MeasurementUnit><Layout><Page WIDTH="1000" HEIGHT="2000"><TextBlock ID="b7" HPOS="30" VPOS="40" WIDTH="600" HEIGHT="300">{body}</TextBlock><TextBlock ID="none"/></Page></Layout></alto>'


METS = """<mets LABEL="Own Paper" xmlns:l="urn:l"><identifier type="lccn">sn77</identifier><detail type="volume"><number>3</number></detail><detail type="issue"><number>9</number></detail>
<detail type="edition"><number>2</number></detail><dateIssued>1901-02-03</dateIssued><fileSec><file ID="x"><FLocat l:href="p/7.xml"/></file><file ID="y"><FLocat l:href="p/7.pdf"/></file></fileSec>
<structMap><div TYPE="page" ID="empty"/><div TYPE="page" ID="seven"><fptr FILEID="x"/><fptr FILEID="y"/></div></structMap></mets>"""


def test_layout(spark):
    rows = spark.createDataFrame([(0, alto()), (1, "<broken"), (2, None), (3, "<alto><Page/></alto>")], "id int, xml string").select("id", layout.layout("xml").alias("p"))
    flat = layout.flattened(F.col("p"))
    got = {r.id: r for r in rows.select("id", "p", layout.full_text(F.col("p.blocks")).alias("text"), *(v.alias(k) for k, v in flat.items())).collect()}
    p = got[0]
    assert p.text == "A SHIP\ncame in." and p.words == [w[0] for w in WORDS]
    assert p.boxes == [[30, 20, 90, 65], [150, 20, 460, 65], [30, 100, 235, 140], [260, 100, 380, 140]]
    assert (p.p.unit, p.p.width, p.p.height, len(p.p.blocks)) == ("pixel", 1000, 2000, 1)
    assert [x.text for x in p.lines] == ["A SHIP", "came in."] and p.blocks[0].block_id == "b7"
    assert p.word_confidences == [0.5, 0.75, 1.0, 1.0]
    assert got[1].p is None and got[2].p is None and got[3].words == []


def test_issue(spark):
    df = spark.createDataFrame([(METS, '<batch><issue lccn="a" issueDate="1915-07-03" editionOrder="1">x/1.xml</issue><issue lccn="b" issueDate="1915-07-10">y/2.xml</issue><issue lccn="c"/></batch>'), ("nope", None)], "m string, b string")
    one, two = df.select(layout.issue("m").alias("i"), layout.issue_refs("b").alias("r")).collect()
    assert (one.i.lccn, one.i.date, one.i.volume, one.i.issue, one.i.edition) == ("sn77", "1901-02-03", "3", "9", "2")
    assert [(x.sequence, x.page_id, x.alto, x.pdf, x.jp2) for x in one.i.pages] == [(1, "seven", "p/7.xml", "p/7.pdf", None)]
    assert [(x.lccn, x.issue_date, x.edition, x.path) for x in one.r] == [("a", "1915-07-03", 1, "x/1.xml"), ("b", "1915-07-10", 1, "y/2.xml")]
    assert two.i is None and two.r is None


def _archive(path, members):
    with tarfile.open(path, "w:bz2") as tar:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))


def test_archive_to_pages(spark, tmp_path):
    base = "sn85026945/1915/07/03/ed-1/seq-"
    _archive(tmp_path / "nbu_test_ver01.tar.bz2", {base + "1/ocr.txt": " Front page\n", base + "1/ocr.xml": alto(), base + "2/ocr.xml": alto(), base + "3/ocr.txt": " ", "readme": "x", "00225879/00175032496/1915/07/03/ed-1/seq-1/ocr.txt": "Other"})
    pages = archives.archive_pages(archives.read_members(spark, f"file://{tmp_path}"))
    titles = spark.createDataFrame([("sn85026945", "The Evening Star. (Omaha, Neb.) 1915-19??", "Omaha", "Nebraska")], "lccn string, name string, city string, state string")
    lines = spark.createDataFrame([("d41d data/sn85026945/1915070301/0002.jp2",), ("d41d data/sn85026945/1915070301/0001.jp2",), ("d41d  data/sn85026945/1915070301/0001.pdf",), ("bad",)], "value string")
    rows = etl.page_table(pages, titles, listings.manifest_assets(lines, "https://x.test/b/"), "nbu_test_ver01", "https://v.test", "https://x.test")
    etl.write_pages(rows, f"file://{tmp_path}/pages")
    etl.write_pages(rows, f"file://{tmp_path}/pages")  # again: the same partitions
    got = {r._id: r for r in spark.read.parquet(f"file://{tmp_path}/pages").collect()}
    assert set(got) == {"sn85026945_1915-07-03_ed-1_seq-1", "sn85026945_1915-07-03_ed-1_seq-2", "00225879_1915-07-03_ed-1_seq-1"}
    a, b, c = (got[k] for k in ("sn85026945_1915-07-03_ed-1_seq-1", "sn85026945_1915-07-03_ed-1_seq-2", "00225879_1915-07-03_ed-1_seq-1"))
    assert (a.text, a.char_count, a.word_count, a.year, a.awardee) == ("Front page", 12, 2, 1915, "University of Nebraska-Lincoln")
    assert a.image_url.endswith("/1915070301/0001.jp2") and a.pdf_url.endswith("/1915070301/0001.pdf") and a.newspaper_title == "The Evening Star."
    assert b.text.startswith("A SHIP") and b.image_url.endswith("0002.jp2") and b.page_width == 1000
    assert c.reel_id == "00175032496" and c.title == "Newspaper 00225879" and c.state == "Unknown" and c.page_unit == "inch1200"
    cat = {r.lccn: r for r in etl.catalog(spark, f"file://{tmp_path}/pages").collect()}
    assert cat["sn85026945"].total_pages == 2 and cat["sn85026945"].years == "1915-1915"


def test_listings(spark):
    html = '<table><tr><td><a href="nbu_a_ver01.tar.bz2">nbu_a_ver01.tar.bz2</a></td><td>2020-01-01</td><td>12.5 MB</td></tr><tr> <td><a href="plain.tar.bz2">p</a></td><td></td><td>-</td></tr></table>'
    rows = {r.name: r for r in listings.batch_listing(spark.createDataFrame([(html,)], "html string"), "https://x.test/ocr").collect()}
    assert (rows["nbu_a_ver01"].state, rows["nbu_a_ver01"].size_bytes, rows["plain"].awardee, rows["plain"].size_bytes) == ("NE", 13107200, None, 0)
    lines = spark.createDataFrame([("Bag-Size: 1.2 GB: about",), ("nothing",)], "value string")
    assert [tuple(r) for r in listings.bag_info(lines).collect()] == [("Bag-Size", "1.2 GB: about")]
    assert [tuple(r) for r in listings.checksums(spark.createDataFrame([("abc  data/a b.txt",), ("x",)], "value string")).collect()] == [("data/a b.txt", "abc")]
    texts = spark.createDataFrame([('["a", "b"]',), ('{"label": "l"}',), ('"s"',), ("no json",)], "v string")
    assert [r[0] for r in texts.select(listings.first_text("v")).collect()] == ["a", "l", "s", None]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbroken\n{"a": 2}\n')
    assert sorted(r.a for r in listings.json_lines(spark, f"file://{tmp_path}/x.jsonl", "a int").collect()) == [1, 2]


def test_batches_of_one_year_both_stay(spark, tmp_path):
    path, base = f"file://{tmp_path}/pages", "sn85026945/1915/07/"
    none = spark.createDataFrame([], "lccn string, name string, city string, state string, ethnicity string")
    assets = listings.manifest_assets(spark.createDataFrame([], "value string"), "https://x.test")
    batches = {"nbu_a_ver01": ("03", 1, "one"), "nbu_b_ver01": ("10", 1, "two"), "nbu_a_ver02": ("03", 2, "three")}
    for k, (name, (day, ed, text)) in enumerate(list(batches.items()) + [("nbu_a_ver01", ("03", 1, "again"))]):
        (tmp_path / f"in{k}").mkdir()
        _archive(tmp_path / f"in{k}" / f"{name}.tar.bz2", {f"{base}{day}/ed-{ed}/seq-1/ocr.txt": text})
        pages = archives.archive_pages(archives.read_members(spark, f"file://{tmp_path}/in{k}"))
        etl.write_pages(etl.page_table(pages, none, assets, name, "https://v.test", "https://x.test"), path)
    assert sorted((r.date, r.edition, r.text) for r in spark.read.parquet(path).collect()) == [("1915-07-03", 1, "again"), ("1915-07-03", 2, "three"), ("1915-07-10", 1, "two")]


def test_archives_are_streamed(spark, tmp_path, monkeypatch):
    """An archive of many times what a task holds leaves it in many parts, each member once."""
    texts = {f"sn1/1915/07/03/ed-1/seq-{i}/ocr.txt": f"page {i} " * 50 for i in range(300)}
    _archive(tmp_path / "x.tar.bz2", {**texts, "./sn2/1915/07/04/ed-1/seq-1/ocr.txt": "dot"})
    monkeypatch.setattr(archives, "HELD", 2000)
    import pyarrow as pa

    parts = list(archives._read(archives.open_uri)([pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/x.tar.bz2"]})]))
    assert len(parts) > 50 and max(p.num_rows for p in parts) < 10 and sum(p.num_rows for p in parts) == 301
    pages = archives.archive_pages(archives.read_members(spark, f"file://{tmp_path}"))
    assert pages.count() == 301 and pages.filter("lccn = 'sn2'").head().txt == "dot"


def test_layouts_are_read_in_slices_and_once(spark, monkeypatch):
    """A task holds the trees of a slice, not of a batch; a filter on what was read doesn't read again."""
    import pyarrow as pa

    monkeypatch.setattr(layout, "SLICE", 300)
    xml = [None, "<broken", *(f'<a><Page WIDTH="9"/><TextBlock ID="b{i}"><TextLine><String CONTENT="w{i}" HPOS="1.5"/></TextLine></TextBlock></a>' * (1 if i != 4 else 0) or "x" * 1000 for i in range(9))]
    slices = [s.to_pylist() for s in layout._slices(pa.array(xml, pa.string()))]
    assert [x for s in slices for x in s] == xml and len(slices) > 4
    assert all(len(s) == 1 or sum(len(x or "") for x in s) <= 300 for s in slices)
    df = spark.createDataFrame(list(enumerate(xml)), "i int, xml string").coalesce(1).select("i", layout.layout("xml").alias("p"))
    got = {r.i: r.p for r in df.collect()}
    assert {i: p and p.blocks[0].lines[0].words[0].text for i, p in got.items()} == {i: None if i in (0, 1, 6) else f"w{i - 2}" for i in range(len(xml))}
    assert got[2].blocks[0].lines[0].words[0].x == 1 and got[2].width == 9
    kept = df.select("i", layout.full_text("p.blocks").alias("t"), F.size(layout.flattened(F.col("p"))["words"]).alias("n")).filter("n > 0")
    assert kept.count() == 8
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_page_table_reads_layouts_once(spark):
    """The filter on pages without text isn't pushed below the layout reader, which would read each layout twice."""
    pages = spark.createDataFrame([("a", "sn1", "1901-02-03", 1, i, None, t, x) for i, (t, x) in enumerate([("told", None), (None, alto()), (" ", None), ("", "<broken")])], "archive string, lccn string, date string, edition int, sequence int, reel string, txt string, xml string").coalesce(1)
    titles = spark.createDataFrame([("sn1", "Paper", "Omaha", "Nebraska")], "lccn string, name string, city string, state string")
    assets = spark.createDataFrame([], "lccn string, date string, edition int, sequence int, image_url string, pdf_url string, reel_id string")
    rows = etl.page_table(pages, titles, assets, "nbu_x_ver01", "https://v.test", "https://x.test")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.sequence: r.words for r in rows.collect()} == {0: [], 1: [w[0] for w in WORDS]}


def test_layouts_are_read_after_all_shuffles_a_few_pages_at_a_time(spark, tmp_path, monkeypatch):
    """Joins and dealing move XML, not what is read from it, and a task's batches hold few pages."""
    import pyarrow as pa

    words = "".join(f"<String CONTENT='w{i}'/>" for i in range(20))
    xml = f"<a><TextBlock ID='b'><TextLine>{words}</TextLine></TextBlock></a>"
    pages = spark.range(300).select(F.lit("a").alias("archive"), F.lit("sn1").alias("lccn"), F.lit("1901-02-03").alias("date"), F.lit(1).alias("edition"), F.col("id").cast("int").alias("sequence"), F.lit(None).cast("string").alias("reel"), F.lit("").alias("txt"), F.lit(xml).alias("xml"))
    titles = spark.createDataFrame([("sn1", "Paper", "Omaha", "Nebraska")], "lccn string, name string, city string, state string")
    assets = spark.range(0, 300, 3).select(F.lit("sn1").alias("lccn"), F.lit("1901-02-03").alias("date"), F.lit(1).alias("edition"), F.col("id").cast("int").alias("sequence"), F.lit("own").alias("image_url"), F.lit(None).cast("string").alias("pdf_url"), F.lit(None).cast("string").alias("reel_id"))

    def told(xml):
        arrow = layout.to_arrow_type(layout.DataType.fromDDL(layout.LAYOUT))

        def run(batch: pa.Array) -> pa.Array:
            return pa.array([{"engine": str(len(batch)), "blocks": []}] * len(batch), arrow)

        return F.arrow_udf(run, layout.LAYOUT).asNondeterministic()(xml)

    rows = etl.page_table(pages, titles, assets, "nbu_x_ver01", "https://v.test", "https://x.test")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("ArrowEvalPython")
    assert "Join" not in above and "Repartition" not in above and "Join" in below and "Repartition" in below
    etl.write_pages(rows, f"file://{tmp_path}/pages")
    got = spark.read.parquet(f"file://{tmp_path}/pages")
    assert got.filter("size(words) = 20").count() == 300 and got.filter("image_url = 'own'").count() == 100
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(layout, "layout", told)  # the batch's size as the engine
    etl.write_pages(etl.page_table(pages.withColumn("txt", F.lit("x")), titles, assets, "nbu_x_ver01", "https://v.test", "https://x.test"), f"file://{tmp_path}/told")
    most = spark.read.parquet(f"file://{tmp_path}/told").select(F.max(F.col("ocr_engine").cast("int"))).head()[0]
    assert most == etl.PAGES_AT_A_TIME and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
