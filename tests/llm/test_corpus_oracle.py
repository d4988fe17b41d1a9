import pytest
from oracle import check

from voxelspark.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, name, sf):
    check(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], sf)
