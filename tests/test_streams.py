"""Streams: the queue by events and timers, the ledger of files, archives as they arrive."""

from __future__ import annotations

import bz2
import datetime
import io
import os
import random
import tarfile

import pyarrow.parquet as pq
import pytest

from pagemill.plans import inputs
from pagemill.sources import archive_source
from pagemill.streaming import ledger, queue_stream

BASE = datetime.datetime(2024, 1, 1)


def fold(events, limit, most, until):
    """The queue after all events, and the time after them, one entry at a time."""
    out = {}
    for name in {e[0] for e in events}:
        entry, due = None, None
        for _, kind, at, _, pages, error in [*sorted((e for e in events if e[0] == name), key=lambda e: (e[2], e[3])), (name, "end", until, 0, None, None)]:
            if due is not None and due < at:
                status, p, e, a = entry
                entry, due = (("failed", p, "stalled", a) if a >= most else ("pending", p, e, a)), None
            status, p, e, a = entry or (None, None, None, 0)
            if kind == "enqueue" and entry is None:
                entry = ("pending", p, e, a)
            elif kind == "start":
                entry, due = ("processing", p, None, a + 1), at + limit
            elif kind == "complete" and entry:
                entry, due = ("completed", pages, e, a), None
            elif kind == "fail" and entry:
                entry, due = ("failed", p, error, a), None
            elif kind == "retry" and status == "failed":
                entry, due = ("pending", p, e, 0), None
        if entry:
            out[name] = entry
    return out


def test_queue_of_events(spark, tmp_path):
    """Three lots with a restart after each, an hour apart; a start may take half an hour."""
    rng, root = random.Random(3), f"file://{tmp_path}"
    limit, most, all_ = datetime.timedelta(minutes=30), 2, []
    for lot in range(3):
        events = []
        for i in range(60):
            kind = rng.choice(["enqueue", "start", "start", "complete", "fail", "retry", "other"])
            at = BASE + datetime.timedelta(hours=lot, seconds=rng.randrange(600))
            events.append((f"b{rng.randrange(14)}", kind, at, 100 * lot + i, rng.randrange(9) if kind == "complete" else None, "bad" if kind == "fail" else None))
        all_ += events
        spark.createDataFrame([*events, (None, "start", BASE, 0, None, None)], queue_stream.EVENT).coalesce(1).write.mode("append").parquet(f"{root}/in")
        queue_stream.run(spark.readStream.schema(queue_stream.EVENT).parquet(f"{root}/in"), f"{root}/queue", f"{root}/check", "30 minutes", most)
    end = BASE + datetime.timedelta(hours=9)
    for name, until in (("tick", BASE + datetime.timedelta(hours=2, seconds=601)), ("tick", end)):
        spark.createDataFrame([(name, "tick", until, 0, None, None)], queue_stream.EVENT).write.mode("append").parquet(f"{root}/in")
        queue_stream.run(spark.readStream.schema(queue_stream.EVENT).parquet(f"{root}/in"), f"{root}/queue", f"{root}/check", "30 minutes", most)
    got = {r.name: (r.status, r.pages, r.error, r.attempts) for r in queue_stream.queue_table(spark, f"{root}/queue").read().collect()}
    assert got == fold(all_, limit, most, end)
    assert {s for s, *_ in got.values()} >= {"pending", "failed"} and any(e == "stalled" for _, _, e, _ in got.values())


def states(log):
    return {r.path.rsplit("/", 1)[-1].split(".")[0]: (r.state, r.footer_rows, r.read_rows, r.kept_rows) for r in log.table.read().collect()}


def test_every_file_is_accounted_for(spark, tmp_path):
    """Whole, empty, superseded, truncated and half-corrupt files; mended ones are taken again; a reset reads all."""
    folder, made = tmp_path / "in", tmp_path / "made"
    folder.mkdir()

    def put(name, rows, groups=None):
        spark.createDataFrame(rows, "key string, n int").coalesce(1).write.mode("overwrite").parquet(f"file://{made}/{name}")
        source = next(f for f in made.joinpath(name).iterdir() if f.name.startswith("part-") and f.suffix == ".parquet")
        table = pq.read_table(source)
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=groups or max(1, len(table)), compression="none", use_dictionary=False)

    put("whole", [(f"w{i}", 1) for i in range(5)])
    put("empty", [])
    put("old", [("s1", 1), ("s2", 1)])
    put("new", [("s1", 2), ("s2", 2)])
    rows = [(f"h{i:05d}" * 20, 1) for i in range(4000)]
    put("half", rows, 500)
    data = bytearray((folder / "half.parquet").read_bytes())
    data[len(data) // 2 : len(data) // 2 + 60_000] = os.urandom(60_000)
    (folder / "half.parquet").write_bytes(data)
    whole = (folder / "whole.parquet").read_bytes()
    (folder / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    log = ledger.Ledger(spark, f"file://{folder}", f"file://{tmp_path}/out", "key string, n int", "key", "n")
    log.ingest()
    got = states(log)
    assert got["whole"] == ("read", 5, 5, 5) and got["empty"] == ("empty", 0, 0, 0) and got["new"] == ("read", 2, 2, 2)
    assert got["old"] == ("superseded", 2, 2, 0) and got["cut"][:2] == ("corrupt", None) and got["half"][:2] == ("partial", 4000)
    assert got["half"][2] < 4000 and log.retried() == 0
    put("half", rows, 500)
    put("cut", [("c", 1)])
    os.utime(folder / "half.parquet", (2e9, 2e9))
    assert log.retried() == 2 and log.retried() == 0
    log.ingest()
    got = states(log)
    assert got["half"] == ("read", 4000, 4000, 4000) and got["cut"] == ("read", 1, 1, 1) and len(got) == 6
    assert log.current().count() == 5 + 2 + 4000 + 1
    log.reset()
    log.ingest()
    assert states(log)["half"] == ("read", 4000, 4000, 4000) and log.current().count() == 4008


def archive(path, pages, cut=False):
    held = io.BytesIO()
    with bz2.BZ2File(held, "w") as packed, tarfile.open(fileobj=packed, mode="w|") as tar:
        for i, text in enumerate(pages):
            info = tarfile.TarInfo(f"sn1/1900/01/0{i + 1}/ed-1/seq-1/ocr.txt")
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    data = held.getvalue()
    path.write_bytes(data[: len(data) // 2] if cut else data)


def test_archives_as_they_arrive(spark, tmp_path):
    folder, root = tmp_path / "in", f"file://{tmp_path}/out"
    folder.mkdir()
    archive(folder / "a.tar.bz2", ["one", "two"])
    archive(folder / "b.tar.bz2", ["x" * 50_000 + str(random.Random(1).random()) for _ in range(3)], cut=True)
    (folder / "c.tar.bz2").write_bytes(b"no archive")
    archive_source.run(spark, f"file://{folder}", root)
    take = lambda: {(r.date, r.txt) for r in archive_source.page_store(spark, root).read().collect()}
    assert take() == {("1900-01-01", "one"), ("1900-01-02", "two")}
    archive(folder / "d.tar.bz2", ["new"])
    os.utime(folder / "d.tar.bz2", (3e9, 3e9))
    archive_source.run(spark, f"file://{folder}", root)
    archive_source.run(spark, f"file://{folder}", root)
    assert take() == {("1900-01-01", "new"), ("1900-01-02", "two")}
    bad = {r.archive.rsplit("/", 1)[-1]: r.problem for r in archive_source.quarantine(spark, root).read().collect()}
    assert set(bad) == {"b.tar.bz2", "c.tar.bz2"} and all(bad.values())
    rows = spark.read.format(archive_source.NAME).load(f"file://{folder}")
    assert rows.rdd.getNumPartitions() == 4 and rows.filter("archive LIKE '%d.tar.bz2'").count() == 1
    (tmp_path / "none").mkdir()
    assert spark.read.format(archive_source.NAME).load(f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("n", [0, 3])
def test_archives_are_as_many_as_needed(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(inputs, "ARCHIVE_PAGES", 1)
    rows = spark.createDataFrame([(i % 2, f"f{i}", f"f{i}/ocr.txt", "x") for i in range(10 * n)], "k long, folder string, member string, content string")
    inputs.write_archives(rows, f"file://{tmp_path}/a")
    files = list((tmp_path / "a").glob("*.tar.bz2")) if n else []
    assert len(files) == (0 if not n else len({f.name for f in files})) and (n == 0 or len(files) > 2)


def test_archives_are_packed_by_many_tasks(spark, tmp_path, monkeypatch):
    """Small as the rows are, they aren't put together into a task or two: packing takes long for its size."""
    seen = []
    monkeypatch.setattr(inputs, "ARCHIVE_PAGES", 1)
    monkeypatch.setattr(inputs, "written", lambda df, name: seen.append(df.rdd.getNumPartitions()))
    rows = spark.range(64).selectExpr("id % 8 AS k", "concat('f', id) AS folder", "concat('f', id, '/ocr.txt') AS member", "'x' AS content")
    inputs.write_archives(rows, f"file://{tmp_path}/a")
    assert seen == [64]


def test_contents_of_archives_are_shuffled_once(spark):
    """From members to settled pages: one shuffle, one sort, and a member's name is split once; same pages as by hand."""
    from pyspark.sql import functions as F

    from pagemill.operators.patching import settled
    from pagemill.sources import archives

    name = F.concat(F.lit("sn1/00175032496/1900/01/0"), (F.col("id") % 9 + 1).cast("string"), F.lit("/ed-"), F.floor(F.col("id") / 2).cast("string"), F.lit("/seq-1/ocr."), F.when(F.col("id") % 2 == 0, "txt").otherwise("xml"))
    rows = spark.range(400).select(F.concat(F.lit("a"), (F.col("id") % 7).cast("string")).alias("archive"), name.alias("member"), F.col("id").cast("string").alias("content"), F.when(F.col("id") == 8, "cut").alias("problem"))
    pages = archives.archive_pages(archive_source.whole(rows, F.broadcast(archive_source.quarantined(rows).select("archive"))))
    keys = ["lccn", "date", "edition", "sequence"]
    out = settled(pages, keys, ["archive", "reel", "txt", "xml"], ["txt", "xml"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(lccn") == 1 and plan.count("Sort [") == 1 and plan.count("split(") == 1
    want = {}
    for i in (i for i in range(400) if i % 7 != 1):
        want.setdefault((f"1900-01-0{i % 9 + 1}", i // 2), []).append(str(i))
    assert {(r.date, r.edition): [t for t in (r.txt, r.xml) if t] for r in out.collect()} == want


def test_queue_entries_are_folded_without_python(spark):
    """Every event's effect is an expression: 20,000 names in one batch, some of them in the queue already."""
    from pyspark.sql import functions as F

    seconds = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 60)
    kinds = F.array(*map(F.lit, ["start", "enqueue", "start", "fail", "retry", "complete"]))
    events = spark.range(20_000).select(F.col("id").cast("string").alias("name"), F.posexplode(F.slice(kinds, 1, (F.col("id") % 7).cast("int"))).alias("seq", "kind"))
    events = events.select("name", "kind", seconds.alias("at"), F.col("seq").cast("long").alias("seq"), F.lit(5).cast("long").alias("pages"), F.lit("bad").alias("error"))
    queue = spark.createDataFrame([("1", "processing", None, None, 1, 1_699_999_999_000, 3), ("9", "pending", 4, None, 0, None, 1)], queue_stream.ENTRY)
    out = queue_stream.folded(queue, events, 90_000, 2)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 20_000 - len(range(0, 20_000, 7))
    of = {r.name: r[1:] for r in out.filter("CAST(name AS INT) < 14").collect()}
    start, millis = "processing", 1_700_000_000_000
    assert of["1"] == (start, None, None, 2, millis + 90_000, 5)  # what it had was due before
    assert of["8"] == of["2"] == (start, None, None, 1, millis + 90_000, 1)
    assert of["9"] == (start, 4, None, 1, millis + 90_000, 2)
    assert of["3"] == (start, None, None, 2, millis + 210_000, 3)  # stalled before its second start
    assert of["4"] == ("failed", None, "bad", 2, None, 4)
    assert of["5"] == ("pending", None, "bad", 0, None, 5)
    assert of["6"] == ("completed", 5, "bad", 0, None, 6)


def test_late_events_are_left_out(spark, tmp_path):
    """What lies further back than ``late`` from the newest event of earlier batches; a repeated run changes nothing."""
    root = f"file://{tmp_path}"
    at = lambda minutes: BASE + datetime.timedelta(minutes=minutes)
    lots = [[("a", "enqueue", at(60))], [("b", "enqueue", at(49)), ("c", "enqueue", at(50)), ("d", "start", at(90))], [], [("e", "tick", at(130)), ("c", "start", at(125))]]
    for lot in [*lots, []]:
        if lot:
            spark.createDataFrame([(*e, 0, None, None) for e in lot], queue_stream.EVENT).coalesce(1).write.mode("append").parquet(f"{root}/in")
        queue_stream.run(spark.readStream.schema(queue_stream.EVENT).parquet(f"{root}/in"), f"{root}/queue", f"{root}/check", "25 minutes", 2, "10 minutes")
    got = {r.name: (r.status, r.attempts) for r in queue_stream.queue_table(spark, f"{root}/queue").read().collect()}
    assert got == {"a": ("pending", 0), "c": ("processing", 1), "d": ("pending", 1)}
