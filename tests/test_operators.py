import json

import pytest
from pyspark.sql import functions as F

from pagemill.functions import links
from pagemill.functions import text as tx
from pagemill.operators import chunks, export, filters, highlight, patching, queue, ranking, search
from pagemill.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head().v


def test_slugs_and_titles(spark):
    # The names that stored paths have.
    for text, want in (("The Monitor (Omaha, Neb.)", "the-monitor-omaha-neb"), ("New York", "new-york"), ("St. Louis", "st-louis")):
        assert one(spark, tx.slug(F.lit(text), "-")) == want
    for text, want in (("The Monitor (Omaha, Neb.) 1915-1928", "The Monitor"), ("Bee 1900-19??", "Bee"), ("Sun 1885", "Sun"), ("1885", "1885")):
        assert one(spark, tx.clean_title(F.lit(text))) == want


def test_urls(spark):
    for url, want in (("https://x.test/resource/00225879/1915-07-03/ed-1/?st=gallery", ("00225879", "1915-07-03", 1)), ("https://x.test/item/sn85026945/1847-03-03/ed-2/", ("sn85026945", "1847-03-03", 2)), ("https://x.test/resource/sn84020657/1917012601/", ("sn84020657", "1917-01-26", 1)), ("https://x.test/lccn/sn1/19170126/", ("sn1", "1917-01-26", 1)), ("https://x.test/lccn/sn1/1917-01-26/ed-3/seq-2/", ("sn1", "1917-01-26", 3)), ("https://x.test/item/sn1/1917-1-26/", None), ("https://x.test/about/", None)):
        got = one(spark, links.issue_of_url(F.lit(url)))
        assert (tuple(got) if got else None) == want
    url = "https://x.test/data/batches/nbu_a_ver01/data/sn1/00175/1915070301/0004.jp2"
    assert one(spark, links.image_id(F.lit(url))) == "service:ndnp:nbu:batch_nbu_a_ver01:data:sn1:00175:1915070301:0004"
    assert one(spark, links.image_url(F.lit("none"), "https://i.test")) == "none"
    assert one(spark, links.rescaled(F.lit("a/full/pct:12.5/0/x.jpg"), 50)) == "a/full/pct:50/0/x.jpg"


def test_text(spark):
    assert one(spark, tx.stem(F.lit("stories"))) == "story" and one(spark, tx.stem(F.lit("glass"))) == "glass"
    assert one(spark, F.size(tx.words(F.lit("a b  c ")))) == 3
    assert one(spark, tx.int_or(F.lit("x"), 0)) == 0 and one(spark, tx.int_or(F.lit("07"), 0)) == 7
    assert one(spark, tx.string_list(F.lit('["a","b"]'))) == ["a", "b"] and one(spark, tx.string_list(F.lit("a, ,b"))) == ["a", "b"]
    assert one(spark, tx.ocr_quality(F.lit("")))["score"] == 0.0
    score, verdict = tx.ocr_verdict(F.lit(1.0), F.lit(0.0), F.lit(0.1), F.lit(0.0))
    assert (one(spark, score), one(spark, verdict)) == (98, "GOOD_OCR")


def test_queue(spark):
    q = spark.createDataFrame([("a", "processing", None, None, 1), ("b", "processing", None, "e", 2), ("c", "completed", 5, None, 1)], "name string, status string, pages long, error string, attempts int")
    state = lambda df: {r.name: (r.status, r.attempts) for r in df.collect()}
    r = queue.recover(q, 2)
    assert state(r) == {"a": ("pending", 1), "b": ("failed", 2), "c": ("completed", 1)}
    assert state(queue.retry(r)) == {"a": ("pending", 1), "b": ("pending", 0), "c": ("completed", 1)}
    assert state(queue.start(r, F.col("name") == "a"))["a"] == ("processing", 2)
    assert state(queue.enqueue(q, spark.createDataFrame([("c",), ("d",), ("d",)], "name string")))["d"] == ("pending", 0)
    assert queue.enqueue(q, spark.createDataFrame([("d",), ("d",)], "name string")).count() == 4
    assert queue.summary(q).head().asDict() == {"pending": 0, "processing": 2, "completed": 1, "failed": 0, "total": 3, "pages_extracted": 5}


def test_filters(spark):
    df = spark.createDataFrame([("NE", "nbu", 5), ("XX", "iune", 1)], "state string, awardee string, n int")
    assert filters.where(df, filters.contains(["state", "awardee"], "ne"), filters.at_least("n", None)).count() == 2
    assert filters.where(df, filters.equals_folded("state", "ne")).count() == 1 and filters.where(df).count() == 2
    assert df.filter(filters.metadata({"state": {"$in": ["NE", "OH"]}, "n": 5})).count() == 1
    with pytest.raises(ValueError, match="ne"):
        filters.metadata({"n": {"$ne": 1}})


def test_search(spark):
    t = F.array(*map(F.lit, "to be or not to be".split()))
    assert one(spark, search.match_phrase(t, ["not", "to"])) and not one(spark, search.match_phrase(t, ["not", "be"]))
    assert one(spark, search.match_phrase(t, ["be", "to"], 2)) and one(spark, search.match_fuzzy(t, "nut")) and one(spark, search.match_regex(t, "n.t"))
    lists = [spark.createDataFrame([("x", i, r) for r, i in enumerate(ids, 1)], "ns string, id int, rank int") for ids in ((1, 2, 3), (3, 4))]
    assert [(r.id, r.rank) for r in ranking.fused(lists, ["ns"], "id", 3).orderBy("rank").collect()] == [(3, 1), (1, 2), (2, 3)]


def test_highlight(spark):
    assert one(spark, highlight.highlight(F.lit("storms & a storm"), ["storm"])) == '<mark class="hl">storms</mark> &amp; a <mark class="hl">storm</mark>'
    marks = one(spark, highlight.query_marks(F.lit('"san fran" "a b"~3 quake~1 fire^2 /fl.*d/')))
    assert marks.phrases == ['"san fran"'] and marks.slop == ['"a b"~3'] and marks.boosts == ["fire^2"] and marks.patterns == ["/fl.*d/"]
    assert highlight.plain_terms("+fire -smoke text:storm^2 AND quake~1") == ["fire", "storm", "quake"]


def test_chunks(spark):
    text = "\n\n".join(" ".join(f"w{i}" for i in range(k)) for k in (30, 700, 5)) + "\n\n"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, text string")
    rows = chunks.recursive_chunks(df, target=100).collect()
    assert {r.id for r in rows} == {1} and all(r.token_count <= 100 for r in rows)
    assert " ".join(r.text for r in sorted(rows, key=lambda r: r.chunk_index)).split() == text.split()


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", "some text", None, [1.5]), ("b", None, "t", [])], "key string, text string, title string, v array<double>")
    out = export.export_documents(df, F.col("key"), F.col("text"), {"title": F.col("title"), "v": F.col("v")})
    assert export.acceptable(out).columns == ["_id", "text", "title", "char_count", "word_count"]
    export.write_jsonl(export.acceptable(out).coalesce(1), f"file://{tmp_path}/j", rows_per_file=1)
    docs = [json.loads(line) for p in tmp_path.glob("j/*.json") for line in p.read_text().splitlines()]
    assert {"_id": "a", "text": "some text", "char_count": 9, "word_count": 2} in docs and {"_id": "b", "text": "", "title": "t"} in docs
    bad = spark.createDataFrame([("x", "t"), ("x", "t"), (" ", None)], "_id string, text string")
    assert sorted((r._id, r.rule) for r in export.violations(bad).collect()) == [(" ", "blank_id"), (" ", "no_text"), ("x", "duplicate_id")]


def test_numbers_across_ranges(spark):
    rows = [("hot", i % 50, i) for i in range(400)] + [("cold", 1, 1000), (None, None, 1001)]
    df = spark.createDataFrame(rows, "g string, k int, id int").repartition(5)
    got = {(r.g, r.id): r.n for r in ranking.numbered_spread(df, ["g"], ["k", "id"], "n").filter("g IS NOT NULL").collect()}
    want = sorted((k, i) for g, k, i in rows if g == "hot")
    assert all(got["hot", i] == n for n, (_, i) in enumerate(want, 1)) and got["cold", 1000] == 1 and len(got) == 401
    picked = ranking.first_middle_last(df.filter("g = 'hot'"), ["g"], ["k", "id"]).collect()
    assert sorted((r.k, r.id) for r in picked) == sorted([want[0], want[200], want[-1]])


def test_patch_touches_what_changes(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(i, "a" if i < 5 else "b", "old", None) for i in range(10)], "id int, p string, x string, y int").write.partitionBy("p").parquet(path)
    before = {f.name for f in tmp_path.glob("t/p=a/*.parquet")}
    news = spark.createDataFrame([(7, "new", 3), (8, "", None), (1, "old", None)], "id int, x string, y int")
    assert patching.patch(spark, path, news, ["id"], ["x", "y"], "p", dry_run=True) == 1
    assert patching.patch(spark, path, news, ["id"], ["x", "y"], "p") == 1
    got = {r.id: (r.p, r.x, r.y) for r in spark.read.parquet(path).collect()}
    assert got[7] == ("b", "new", 3) and got[8] == ("b", "old", None) and len(got) == 10
    assert {f.name for f in tmp_path.glob("t/p=a/*.parquet")} == before
    assert patching.patch(spark, path, news, ["id"], ["x", "y"], "p") == 0


def test_corrupt_files_and_late_rows(spark, tmp_path):
    folder, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    df = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "key string, n int")
    df.repartition(3).write.parquet(folder)
    (tmp_path / "in" / "bad.parquet").write_bytes(b"PAR1 not a table")
    run = lambda: ingest.ingest(ingest.file_stream(spark, folder, df.schema, 1), out, f"file://{tmp_path}/check", "key", "n")
    run()
    assert ingest.current(spark, out, "key").count() == 20
    assert [r.path.rsplit("/", 1)[-1] for r in ingest.unread(spark, folder, out).collect()] == ["bad.parquet"]
    spark.createDataFrame([("k3", 99)], "key string, n int").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert {r.n for r in ingest.current(spark, out, "key").filter("key = 'k3'").collect()} == {99}
    events = "ts timestamp, kind string, v int"
    for k, times in enumerate((["2024-01-01 00:10", "2024-01-01 05:00"], ["2024-01-01 00:20"], ["2024-01-01 04:30"])):
        spark.createDataFrame([(t, "a", 1) for t in times], "t string, kind string, v int").selectExpr("CAST(t AS timestamp) AS ts", "kind", "v").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/ev")
        stream = spark.readStream.schema(events).option("pathGlobFilter", "*.parquet").parquet(f"file://{tmp_path}/ev")
        ingest.save_windows(ingest.windowed_counts(stream, "ts", "kind", "1 hour", "2 hours", "v"), f"file://{tmp_path}/w", f"file://{tmp_path}/wc")
    got = {r.start.hour: (r.n, r.total) for r in ingest.latest_windows(spark, f"file://{tmp_path}/w", "kind").collect()}
    assert got == {0: (1, 1), 5: (1, 1), 4: (1, 1)}  # 00:20 came more than two hours late


def test_query_choices(spark):
    assert [filters.number_of(x) for x in ("01 - January", "12", 7, "(any)", "", None, "all", "00")] == [1, 12, 7, None, None, None, None, None]
    dim = spark.createDataFrame([("sun", "The Sun", "east", "New York"), ("call", "The Call", "west", "California")], "slug string, title string, region string, state_name string")
    pick = lambda **k: sorted(r.slug for r in filters.publications(dim, **k).collect())
    assert pick() == ["call", "sun"] and pick(region="WEST", state="New York") == ["call"] and pick(state="in california") == ["call"]
    assert pick(newspaper="sun", region="west") == ["sun"] and pick(newspaper="east") == ["sun"] and pick(newspaper="from The Call today") == ["call"] and pick(newspaper=["call"]) == ["call"] and pick(newspaper="nothing") == []
    assert {"story", "stories"} <= set(tx.variants("story")) and all(tx.stem_of(v) == w for w in ("story", "thing", "glass") for v in tx.variants(w))


def test_index_schema(spark):
    df = spark.createDataFrame([("a", "t", 1, ["x"], [1.5])], "_id string, text string, n int, tags array<string>, v array<double>")
    assert json.loads(export.index_schema(df))["fields"] == {"text": {"type": "string", "full_text_search": True}, "n": {"type": "number"}, "tags": {"type": "string_list"}}


def test_patch_settles_or_refuses_repeated_keys(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(i, "a", i % 3) for i in range(30)], "id long, x string, p int").write.partitionBy("p").parquet(path)
    news = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1), (2, "d", 1)], "id long, x string, at int")
    with pytest.raises(Exception, match="several values for the key"):
        patching.patch(spark, path, news, ["id"], ["x"], "p")
    assert patching.patch(spark, path, news, ["id"], ["x"], "p", order=["at"], task_rows=3) == 2
    rows = spark.read.parquet(path)
    assert rows.count() == 30 and {(r.id, r.x) for r in rows.filter("x != 'a'").collect()} == {(1, "c"), (2, "d")}


def test_slop_is_shared_by_the_gaps(spark):
    lines = ["a b c", "a x b y c", "a x b y z w c", "a a x x x b c", "x a b b c", "c b a", "a", "", "a.b c x"]
    tokens = spark.createDataFrame([(x.split(),) for x in lines], "t array<string>")
    for slop in (1, 2, 4):
        want = [any(w[0] == "a" and any("b" in w[1:j] and w[j] == "c" for j in range(2, min(len(w), 3 + slop))) for w in (x.split()[i:] for i in range(len(x.split())))) for x in lines]
        assert [r[0] for r in tokens.select(search.match_phrase(F.col("t"), ["a", "b", "c"], slop)).collect()] == want
    assert tokens.filter(search.match_phrase(F.col("t"), ["a.b", "c"], 1)).count() == 1


def test_bm25_takes_words_as_they_are(spark):
    docs = spark.createDataFrame([("n", 1, "many things"), ("n", 2, "a thing"), ("n", 3, "none")], "ns string, id long, text string")
    assert {r.id for r in search.bm25(docs, "ns", "id", {"things": 1.0}).collect()} == {1, 2}


def test_embedder_finds_terms_once(spark):
    """The terms stand outside of the function over places (a Python function can't stand inside it), and are right."""
    from pagemill.operators import records

    once = F.udf(lambda t: t, "string")
    df = spark.createDataFrame([(1, "Aa b q, a"), (2, "  "), (3, None)], "i int, text string").withColumn("text", once("text"))
    got = {r.i: r.embedding for r in records.embedded(df, lambda t: records.hashed_terms(once(t), 8)).collect()}
    assert got == {1: [0.0, 3.0, 1.0] + [0.0] * 5, 2: [0.0] * 8, 3: [0.0] * 8}
