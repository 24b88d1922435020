"""Readers see whole versions; views follow the snapshot they belong to."""

import pytest
from pyspark.sql import functions as F

from parcelflow.sources import published as P


def _df(spark, values):
    return spark.createDataFrame([(v, v % 2) for v in values], "v long, day int")


def _values(df):
    return sorted(r.v for r in df.collect())


def test_a_reader_keeps_its_version_while_the_next_is_written(spark, tmp_path):
    base = str(tmp_path / "p")
    assert P.snapshot(spark, base) is None
    P.publish(spark, base, {"a": _df(spark, [1, 2]), "b": _df(spark, [5])}, partition_by={"a": "day"})
    early = P.snapshot(spark, base)
    lazy = early.read("a")
    # Half of the next run is written: its table is there, its pointer isn't.
    _df(spark, [9]).write.parquet(f"{base}/a/version=1")
    assert P.snapshot(spark, base).version == 0 and _values(P.snapshot(spark, base).read("a")) == [1, 2]
    assert P.publish(spark, base, {"a": _df(spark, [3])}) == 2                    # the stopped run's number is not used again
    late = P.snapshot(spark, base)
    assert (_values(lazy), _values(early.read("b")), _values(late.read("a")), _values(late.read("b"))) == ([1, 2], [5], [3], [5])
    assert dict(late.tables) == {"a": 2, "b": 0}


def test_an_unfinished_pointer_is_no_version(spark, tmp_path):
    base = str(tmp_path / "p")
    P.publish(spark, base, {"a": _df(spark, [1])})
    P.publish(spark, base, {"a": _df(spark, [2])})
    (tmp_path / "p" / "published" / "version=1" / "_SUCCESS").unlink()
    assert P.published(spark, base) == [0] and _values(P.snapshot(spark, base).read("a")) == [1]
    with pytest.raises(KeyError):
        P.snapshot(spark, base, 1)


def test_retire_keeps_what_a_kept_pointer_names(spark, tmp_path):
    base = str(tmp_path / "p")
    P.publish(spark, base, {"a": _df(spark, [1]), "b": _df(spark, [7])})
    for v in (2, 3):
        P.publish(spark, base, {"a": _df(spark, [v])}, drop=["c"])
    P.publish(spark, base, {"c": _df(spark, [])})
    assert P.retire(spark, base, keep=2) == ["published/version=0", "published/version=1", "a/version=0", "a/version=1"]
    s = P.snapshot(spark, base)
    assert (_values(s.read("a")), _values(s.read("b")), _values(s.read("c"))) == ([3], [7], [])
    assert P.retire(spark, base, keep=2) == []
    with pytest.raises(KeyError):
        s.read("d")


def test_views_are_computed_over_their_snapshot(spark, tmp_path):
    base = str(tmp_path / "p")
    views = {"per_day": lambda s: s.read("a").groupBy("day").agg(F.count("*").alias("n"))}
    P.publish(spark, base, {"a": _df(spark, range(5))}, partition_by={"a": "day"})
    P.register_views(P.snapshot(spark, base), views, "x_")
    P.publish(spark, base, {"a": _df(spark, range(50))}, partition_by={"a": "day"})
    assert {(r.day, r.n) for r in spark.table("x_per_day").collect()} == {(0, 3), (1, 2)}
    assert P.register_views(P.snapshot(spark, base), views, "x_") == ["x_a", "x_per_day"]
    one = spark.sql("SELECT n FROM x_per_day WHERE day = 1")
    assert one.first().n == 25
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
