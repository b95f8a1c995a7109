"""Every registered query against its DuckDB oracle on sf0.01 (the
driver's correctness gate, run locally)."""

import os

import pytest

SF = os.environ.get("STRONGROOM_TEST_SF", "/root/testdata/sf0.01")

import __spark_entry__ as E  # noqa: E402

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    from tools_check import duck

    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    from tools_check import compare

    r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF, con)
    assert r.get("ok") is not False, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
