import pytest
from compare import same

from pagemill.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    same(queries.queries()[name](spark, sf), SQL[name], sf)
