"""Plan checks: no Python UDF nodes, no cartesian products,
partition pruning and pushed filters on bounded bronze reads."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from parcelflow.sources import bronze as B
from parcelflow.sources.fixtures import bronze_from_dir

BATCH = [k for k in E.queries() if k[0] in "qm"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_or_cartesian(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_bounded_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    B.append_bronze(bronze_from_dir(spark, SF_SMALL), path)
    df = B.read_bronze(spark, path, "2024-01-08", "2024-01-14").filter("event_type = 'DELIVERED'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,DELIVERED)]" in plan
    assert B.expire_partitions(spark, path, "2024-01-31", 10)[-1] == "2024-01-20"
    with pytest.raises(ValueError):
        B.read_bronze(spark, path, None, "2024-01-14")
