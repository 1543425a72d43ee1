"""Queries over keyed tables with upserts, deletes, versions and compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.merging import MergeTable
from pagemill.plans import query, table
from pagemill.scratch import scratch_path

_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _written(spark: SparkSession, sf: str) -> tuple[MergeTable, list[int]]:
    """Two thirds of the orders; then prices that change among them and the rest; then some that go."""
    t = MergeTable(spark, scratch_path(spark, "merged"), _SCHEMA, ["o_orderkey"])
    o, k = table(spark, sf, "orders").select(*_COLUMNS), F.col("o_orderkey")
    versions = [t.upsert(o.filter(k % 3 > 0), token="load")]
    changed = o.filter((k % 3 == 0) | (k % 5 == 0)).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "n": F.lit(2)})
    stale = changed.withColumns({"o_totalprice": F.lit(-1.0), "n": F.lit(1)})
    versions.append(t.upsert(changed.unionByName(stale), order=["n"], token="change"))
    versions.append(t.upsert(stale, order=["n"], token="change"))  # the same token again
    versions.append(t.delete(o.filter(k % 7 == 0).select(k).unionByName(o.select((-k).alias("o_orderkey")))))
    return t, versions


_LAST_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 7 <> 0"


@query(_LAST_SQL)
def merge_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A table after upserts (some stale, some repeated) and deletes (some of nothing)."""
    return _written(spark, sf)[0].read()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0")
def merge_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The same table as of its first version, after it was compacted."""
    t, versions = _written(spark, sf)
    t.compact()
    return t.read(versions[0])


@query(f"WITH l AS ({_LAST_SQL}) SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 50 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM l WHERE o_custkey % 50 <> 2")
def merge_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Compacted, changed again in a few places, and compacted once more: only touched buckets are written."""
    t, _ = _written(spark, sf)
    t.compact()
    c = F.col("o_custkey")
    t.upsert(t.read().filter(c % 50 == 1).withColumn("o_orderstatus", F.lit("X")))
    t.delete(t.read().filter(c % 50 == 2))
    t.compact()
    return t.read()
