import pytest
from oracle import from_duckdb, from_spark

from ledgerline.llm import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got, want = from_spark(QUERIES[name](spark, sf_dir)), from_duckdb(sf_dir, ORACLES[name])
    assert got[0] == want[0]
    assert got[1] == want[1], (list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3])
