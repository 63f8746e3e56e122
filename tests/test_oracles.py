"""Every registered query of the library against its DuckDB SQL at sf0.001."""

import pytest

import __spark_entry__ as entry
from tabflow.plans import catalog
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    r = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert r["match"] and r["spark_rows"] > 0, r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 26
