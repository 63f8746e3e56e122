import pytest

from tabflow.llm.queries import ORACLES, QUERIES
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    got = compare(spark, SF, name, QUERIES[name], ORACLES[name], duck(SF))
    assert got["match"] and got["spark_rows"] > 0, got
