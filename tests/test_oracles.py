import pytest
from oracle import from_duckdb, from_spark

from ledgerline.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    got = from_spark(registry.QUERIES[name](spark, sf_dir))
    if name not in registry.ORACLES:
        assert got[0]
        return
    want = from_duckdb(sf_dir, registry.ORACLES[name])
    assert got[0] == want[0]
    assert got[1] == want[1], (list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3])
