"""E1-E8 and A6 (p95 against a brute-force quantile)."""

import duckdb
import pytest

from pyspark.sql import functions as F

from parcelflow.operators.aggregates import p95
from parcelflow.operators.quality import Check, freshness, run_suite
from parcelflow.plans.suite import REFERENCE_TESTS


def test_suite_statuses(spark):
    orders = spark.createDataFrame([(1, "F"), (2, "X"), (2, None), (None, "O")], "k long, s string")
    items = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    checks = [
        Check("orders", "not_null", "k"), Check("orders", "unique", "k"),
        Check("orders", "accepted_values", "s", ("F", "O")),
        Check("orders", "accepted_values", "s", ("F", "O"), severity="warn"),
        Check("items", "relationships", "k", to="orders", field="k"),
        Check("orders", "not_null", "missing_col"),
        Check("orders", "unique", "concat(k, missing_col)"),
    ]
    got = [(r.failures, r.status) for r in run_suite(spark, {"orders": orders, "items": items}, checks).collect()]
    assert got == [(1, "fail"), (1, "fail"), (1, "fail"), (1, "warn"), (1, "fail"), (None, "error"),
                   (None, "error")]


def test_reference_suite_has_81_tests():
    assert len(REFERENCE_TESTS) == 81
    kinds = [c.kind for c in REFERENCE_TESTS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"),
            kinds.count("relationships")) == (46, 19, 8, 8)


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-30 23:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    st = lambda now: freshness(df, "t", now).first().status
    assert st("2024-01-30 23:20:00") == "pass"
    assert st("2024-01-30 23:45:00") == "warn"
    assert st("2024-01-31 01:30:00") == "error"
    assert st("2024-02-05 00:00:00") == "error"          # outside the 3-day filter: no rows


@pytest.mark.parametrize("n", [1, 2, 20, 21, 119, 500])
def test_p95_matches_discrete_quantile(spark, n):
    vals = [(i * 37) % 101 - 20 for i in range(n)]
    got = spark.createDataFrame([(v,) for v in vals], "x long").agg(p95("x").alias("p")).first().p
    want = duckdb.connect().execute(f"select quantile_disc(x, 0.95) from (select unnest({vals}) as x)").fetchall()[0][0]
    assert got == want


def test_p95_all_null_group(spark):
    df = spark.createDataFrame([(None,), (None,)], "x long")
    assert df.agg(p95("x").alias("p")).first().p is None


def test_suite_is_one_plan(spark):
    """All tests of all tables: as many stages as tables and the shuffles of one aggregate, not one job per test."""
    import uuid

    from parcelflow.operators.quality import Check, run_suite

    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", None), (2, None, 2.5), (None, "z'", 9.0)], "k int, v string, d double")
    b = spark.createDataFrame([(1, 7), (3, 7)], "k long, w int")
    checks = [Check("a", "not_null", "k"), Check("a", "unique", "k"), Check("a", "unique", "concat(k, v)"), Check("a", "accepted_values", "v", ("x", "z'")),
              Check("a", "relationships", "k", to="b"), Check("b", "relationships", "k", to="a", severity="warn"), Check("b", "unique", "w"), Check("a", "not_null", "d"),
              Check("a", "accepted_values", "k", (1, 2)), Check("a", "relationships", "d", to="b", field="k"), Check("a", "not_null", "no"), Check("c", "unique", "k"),
              Check("a", "relationships", "k", to="c")]
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "suite")
    try:
        got = [(r.failures, r.status) for r in run_suite(spark, {"a": a, "b": b}, checks).collect()]
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [(1, "fail"), (1, "fail"), (0, "pass"), (1, "fail"), (1, "fail"), (1, "warn"), (1, "fail"), (1, "fail"), (0, "pass"), (2, "fail"), (None, "error"), (None, "error"), (None, "error")]
    assert jobs <= 5                           # the stages of one adaptive plan, and the result's own
