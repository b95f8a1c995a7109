"""Plan shape of every registered query: no Cartesian product, no
nested-loop join, no row-at-a-time Python UDF, and column-pruned scans."""

import os
import re

import pytest

import __spark_entry__ as E

SF = os.environ.get("STRONGROOM_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.queries())
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# Queries whose result is every lineitem column (a row sample, a profile of all columns).
ALL_COLUMNS = {"sample", "sample_bounds", "profile_columns_approx", "profile_columns_approx_error"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF)
    qe = df._jdf.queryExecution()
    plan = qe.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    # Scans of the wide test tables never read every column.
    if name in ALL_COLUMNS:
        return
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        fields = m.group(1).split(",")
        assert not ({"l_orderkey:bigint", "l_tax:double", "l_returnflag:string"} <= set(fields)), f"{name}: full lineitem scan"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize(
    "name,scans,exchanges",
    [("sat_user_state", 1, 2), ("sat_end_dated", 1, 2), ("audit_consecutive_equal", 1, 2), ("sat_split", 2, 4), ("driving_key", 1, 4), ("sat_merge", 2, 6)],
)
def test_histories_are_read_once(spark, name, scans, exchanges):
    """Both parts of a history cut into buckets read one reused exchange (scans: stored tables or files)."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = E.queries()[name](own, SF)._jdf.queryExecution().executedPlan().toString()
    made = len(re.findall(r"- Exchange hash", plan))
    assert (len(re.findall("FileScan", plan)), made) == (scans, exchanges), plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["hub_prehashed", "link_prehashed", "sat_prehashed"])
def test_loads_take_the_staged_hashes(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "sha2" not in plan and "parquet" in plan and "lineitem.parquet" not in plan
