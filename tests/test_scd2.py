"""New, changed, NULL<->value, deleted, returned keys."""

from conftest import ts

from parcelflow.operators.scd2 import current_rows, scd2_diff, scd2_snapshot

SCHEMA = "k string, a string, seen string"


def _snap(spark, hist, rows, run):
    return scd2_snapshot(hist, spark.createDataFrame(rows, SCHEMA), "k", ["a"], run)


def test_scd2_lifecycle(spark):
    t1, t2, t3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
    h = _snap(spark, None, [("same", "x", "1"), ("chg", "x", "1"), ("n2v", None, "1"), ("v2n", "x", "1"),
                            ("gone", "x", "1")], t1)
    h = _snap(spark, h, [("same", "x", "2"), ("chg", "y", "2"), ("n2v", "x", "2"), ("v2n", None, "2"),
                         ("new", "z", "2")], t2)
    h = _snap(spark, h, [("same", "x", "3"), ("chg", "y", "3"), ("n2v", "x", "3"), ("v2n", None, "3"),
                         ("new", "z", "3"), ("gone", "x", "3")], t3)
    rows = sorted((r.k, str(r.a), r.seen, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in h.collect())
    assert rows == sorted([
        ("chg", "x", "1", t1, t2), ("chg", "y", "2", t2, "None"),
        ("gone", "x", "1", t1, t2), ("gone", "x", "3", t3, "None"),       # deleted, then returned
        ("n2v", "None", "1", t1, t2), ("n2v", "x", "2", t2, "None"),
        ("new", "z", "2", t2, "None"),
        ("same", "x", "1", t1, "None"),                                   # unchecked column not refreshed
        ("v2n", "x", "1", t1, t2), ("v2n", "None", "2", t2, "None"),
    ])
    cur = current_rows(h)
    assert cur.count() == cur.select("k").distinct().count() == 6       # one open row per live key


def test_no_hard_delete_keeps_row_open(spark):
    h = _snap(spark, None, [("a", "x", "1")], "2024-01-01 00:00:00")
    h = scd2_snapshot(h, spark.createDataFrame([], SCHEMA), "k", ["a"], "2024-01-02 00:00:00",
                      invalidate_hard_deletes=False)
    assert [r.dbt_valid_to for r in h.collect()] == [None]


def test_scd2_diff_classes(spark):
    cur = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "k string, a string")
    src = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", "z"), ("c", None)], "k string, a string")
    got = dict((r.k, r.change) for r in scd2_diff(cur, src, "k", ["a"]).collect())
    assert got == {"a": "unchanged", "b": "changed", "c": "unchanged", "d": "new"}
    got = dict((r.k, r.change) for r in scd2_diff(src, cur, "k", ["a"]).collect())
    assert got["d"] == "deleted"
    assert ts("2024-01-01 00:00:00")
