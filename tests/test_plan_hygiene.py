"""Every registered query plans without the patterns that do not scale: no
cross product or nested-loop join, no Python UDF operator, and scans that
read only the columns the query uses."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
)
# columns no registered query needs: a scan that reads them is not pruned
NEVER_READ = ("l_extendedprice", "l_discount", "l_tax", "lang", "source", "n_chars")


@pytest.mark.parametrize("name", sorted(E.OWN_QUERIES))
def test_plan_has_no_unscalable_parts(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    assert "RoundRobinPartitioning" not in plan and "REPARTITION_BY_NUM" not in plan, name
    for line in plan.splitlines():
        if "ReadSchema" in line:
            schema = line.split("ReadSchema:", 1)[1]
            for col in NEVER_READ:
                assert col not in schema, f"{name} reads {col}: {schema}"
