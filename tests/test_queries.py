import pytest
from compare import same

import __spark_entry__ as entry
from pagemill import plans

NAMES = sorted(plans.SQL)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, sf, name):
    same(plans.QUERIES[name](spark, sf), plans.SQL[name], sf)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "id", "score", "rank"] and df.count() > 0


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) <= set(entry.queries())
