"""The index of keys beside a table opens few days and changes no result."""

import random

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as Y

from parcelflow.sources import key_index as K
from parcelflow.sources import tables as T

def _rows(spark, rows):
    """(id, day or None, value); ids are text."""
    df = spark.createDataFrame([(i, 0, d, v) for i, d, v in rows], "event_id string, part long, day int, value long")
    date = F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))
    return df.select("event_id", "part", date.cast("timestamp").alias("event_ts"), date.alias("event_date"), "value")


def _table(spark, path):
    return sorted((r.event_id, str(r.event_date), r.value) for r in spark.read.parquet(path).select("event_id", "event_date", "value").collect())


def test_random_merges_equal_the_full_search(spark, tmp_path):
    rng = random.Random(5)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for run in range(5):
        ids = rng.sample(range(60), 25)
        rows = [(f"e{i}", rng.choice([None, *range(8)]), 100 * run + i) for i in ids]
        batch = _rows(spark, rows)
        T.upsert(spark, a, batch, "event_id", key_index=True)
        T.upsert(spark, b, batch, "event_id")
        if run == 2:                                       # a writer that knows nothing of the index
            for p in (a, b):
                T.replace_days(spark, p, [__import__("datetime").date(2024, 1, 4)], _rows(spark, [(f"x{k}", 3, k) for k in range(5)]))
        assert _table(spark, a) == _table(spark, b)


def test_days_opened_do_not_grow_with_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    opened = []
    for days in (6, 24):
        rng = random.Random(days)
        ids = rng.sample(range(10**9), 40 * days)                      # no order in time, so ranges don't tell
        T.upsert(spark, path, _rows(spark, [(f"{i:09d}", k % days, k) for k, i in enumerate(ids)]), "event_id", key_index=True)
        old = spark.read.parquet(path).where("event_date in (date'2024-01-02', date'2024-01-05')").orderBy("event_id").limit(3).select("event_id").collect()
        batch = _rows(spark, [(r.event_id, days + 1, 1) for r in old])
        held = {str(r.event_date) for r in spark.read.parquet(path).join(batch.select("event_id"), "event_id").select("event_date").collect()}
        got = K.days_to_open(spark, path, batch, "event_id")
        assert held <= got
        opened.append(len(got))
    assert opened[1] <= 4                                              # of 24 days


def test_ranges_keep_ordered_keys_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    T.upsert(spark, path, _rows(spark, [(f"{k:06d}", k // 20, k) for k in range(200)]), "event_id", key_index=True)
    new = _rows(spark, [(f"{k:06d}", 10, k) for k in range(200, 400)])
    assert K.days_to_open(spark, path, new, "event_id") == set()
    assert T.upsert(spark, path, new, "event_id", key_index=True)["searched"] == 0


def test_entries_of_other_files_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    T.upsert(spark, path, _rows(spark, [("a", 0, 1), ("b", 1, 1)]), "event_id", key_index=True)
    _rows(spark, [("z", 0, 1)]).drop("event_date").write.mode("append").parquet(f"{path}/event_date=2024-01-01")
    assert K.days_to_open(spark, path, _rows(spark, [("z", 3, 2)]), "event_id") == {"2024-01-01"}
    assert K.refresh(spark, path, "event_id") == ["2024-01-01"]
    assert K.days_to_open(spark, path, _rows(spark, [("z", 3, 2)]), "event_id") == {"2024-01-01"}
    assert K.days_to_open(spark, path, _rows(spark, [("y", 3, 2)]), "event_id") <= {"2024-01-01", "2024-01-02"}


@pytest.mark.parametrize("written", [False, True])
def test_a_stopped_index_run_is_ignored(spark, tmp_path, written):
    path = str(tmp_path / "t")
    T.upsert(spark, path, _rows(spark, [("a", 0, 1), ("b", 1, 1)]), "event_id", key_index=True)
    for run in (tmp_path / "t__keys").iterdir():
        for f in [x for x in run.rglob("*") if x.is_file() and (x.name == "_SUCCESS") is not written]:
            f.unlink()
    assert K.days_to_open(spark, path, _rows(spark, [("q", 3, 2)]), "event_id") == {"2024-01-01", "2024-01-02"}
    assert T.upsert(spark, path, _rows(spark, [("a", 3, 2)]), "event_id", key_index=True)["partitions"] == 2
    assert _table(spark, path) == [("a", "2024-01-04", 2), ("b", "2024-01-02", 1)]


def test_keys_of_another_type_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    number = lambda df, t: df.withColumn("event_id", F.col("event_id").cast(t))
    T.upsert(spark, path, number(_rows(spark, [("5", 0, 1), ("6", 1, 1)]), Y.LongType()), "event_id", key_index=True)
    assert K.days_to_open(spark, path, number(_rows(spark, [("5", 4, 2)]), Y.IntegerType()), "event_id") == {"2024-01-01"}
    assert "2024-01-02" in K.days_to_open(spark, path, _rows(spark, [("6", 4, 2), ("x", 4, 2)]), "event_id")


def test_several_key_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    T.upsert(spark, path, _rows(spark, [("a", 0, 1), ("b", 1, 1)]), ["part", "event_id"], key_index=True)
    T.upsert(spark, path, _rows(spark, [("a", 2, 7)]), ["part", "event_id"], key_index=True)
    assert _table(spark, path) == [("a", "2024-01-03", 7), ("b", "2024-01-02", 1)]
