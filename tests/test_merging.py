"""Keyed tables with versions against a dictionary."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators.merging import BASE, DELTA, MergeTable

SCHEMA = "k long, v string, n int"


def state(df):
    rows = [(r.k, r.v, r.n) for r in df.collect()]
    assert len(rows) == len(set(r[0] for r in rows))
    return {r[0]: r[1:] for r in rows}


def test_any_sequence_of_changes(spark, tmp_path):
    rng = random.Random(7)
    t, want, versions = MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 4), {}, {}
    assert state(t.read()) == {}
    for step in range(9):
        keys = rng.sample([None, *range(40)], rng.randrange(0, 12))
        if step % 3 == 2:
            version = t.delete(spark.createDataFrame([(k,) for k in keys], "k long"))
            want = {k: x for k, x in want.items() if k not in keys}
        else:
            new = {k: (f"s{step}", rng.choice([None, step])) for k in keys}
            version = t.upsert(spark.createDataFrame([(k, *x) for k, x in new.items()], SCHEMA))
            want = want | new
        versions[version] = dict(want)
        if step in (3, 6):
            versions[t.compact()] = dict(want)
        assert state(t.read()) == want
    for version, then in versions.items():
        assert state(t.read(version)) == then


def test_compaction_leaves_other_files_alone(spark, tmp_path):
    t = MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 8)
    t.upsert(spark.createDataFrame([(i, "a", i) for i in range(200)], SCHEMA))
    t.compact()
    read = lambda: {r.f for r in t.read().select(F.input_file_name().alias("f")).distinct().collect()}
    files = read()
    assert "Exchange" not in t.read()._jdf.queryExecution().executedPlan().toString()
    t.upsert(spark.createDataFrame([(5, "b", 0)], SCHEMA))
    t.delete(spark.createDataFrame([(6,)], "k long"))
    touched = {b for r in t.versions.parts() if r.kind == DELTA for b in r.live}
    t.compact()
    kept = files & read()
    assert 0 < len(touched) <= 2 and {int(f.split("_bucket=")[1].split("/")[0]) for f in kept} == set(range(8)) - touched
    assert not [r for r in t.versions.parts() if r.kind == DELTA] and len([r for r in t.versions.parts() if r.kind == BASE]) == 2
    assert state(t.read())[5] == ("b", 0) and 6 not in state(t.read())
    before = state(t.read())
    assert t.sweep(t.versions.latest()) and state(t.read()) == before


def test_tokens_and_repeated_keys(spark, tmp_path):
    t = MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 2)
    frame = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    version = t.upsert(frame((1, "a", 1)), token="one")
    assert t.upsert(frame((1, "x", 9)), token="one") == version
    t.compact()
    t.upsert(frame((1, "x", 9)), token="one")
    assert state(t.read()) == {1: ("a", 1)}
    t.upsert(frame((1, "b", 2), (1, "c", 3), (2, "d", 1), (2, "d", 1)), order=["n"])
    assert state(t.read()) == {1: ("c", 3), 2: ("d", 1)}
    with pytest.raises(Exception, match="several values for the key"):
        t.upsert(frame((1, "b", 2), (1, "c", 3)))
    assert state(t.read()) == {1: ("c", 3), 2: ("d", 1)}


def test_a_write_that_is_not_published_is_not_there(spark, tmp_path, monkeypatch):
    t = MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 2)
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    monkeypatch.setattr(t.versions, "publish", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        t.upsert(spark.createDataFrame([(1, "b", 2)], SCHEMA))
    assert state(MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 2).read()) == {1: ("a", 1)}


def test_a_write_is_written_once_and_large_buckets_by_several_tasks(spark, tmp_path):
    from pagemill.scratch import scratch_root

    root = scratch_root(spark).removeprefix("file://")
    beside = lambda: set(glob.glob(f"{root}/*/part-*"))
    t, before, size = MergeTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 2), beside(), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "32k")
    try:
        t.upsert(spark.range(0, 40_000, 1, 8).selectExpr("id AS k", "uuid() AS v", "1 AS n"), order=["n"])
    finally:
        spark.conf.unset(size)
    assert beside() == before and t.read().count() == 40_000
    assert all(len(list(tmp_path.glob(f"t/parts/*/_bucket={b}/*.parquet"))) > 2 for b in (0, 1))
    assert t.upsert(spark.createDataFrame([], SCHEMA)) == 2 and [r.live for r in t.versions.parts()] == [[0, 1]]
