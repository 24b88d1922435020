"""J2 upsert and the incremental rules T3-T5 (merge modes, high-water)."""

import os

import pytest
from conftest import bronze_rows, ev

from pyspark.sql import functions as F

from parcelflow.plans.build import run_fact, run_silver_events
from parcelflow.plans.silver import Incremental, silver_parcel_events
from parcelflow.sources.tables import upsert

ROWS = [
    ev("e1", "p1", "SCAN_IN_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d1"),
    ev("e2", "p1", "SCAN_OUT_DEPOT", "2024-01-10 10:30:00", 2, depot_id="d1"),
    ev("e3", "p2", "SCAN_IN_DEPOT", "2024-01-11 09:00:00", 1, depot_id="d2"),
    ev("e4", "p1", "SCAN_IN_DEPOT", "2024-01-12 08:00:00", 3, depot_id="d3"),
    ev("e5", "p1", "SCAN_OUT_DEPOT", "2024-01-12 09:00:00", 4, depot_id="d3"),
    ev("e6", "p2", "SCAN_OUT_DEPOT", "2024-01-12 10:00:00", 2, depot_id="d2"),
]


def _keys(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_moves_key_and_empties_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("k1", "2024-01-01", 1), ("k2", "2024-01-01", 1)], "k string, d string, v int") \
        .withColumn("event_date", F.col("d").cast("date")).drop("d")
    upsert(spark, path, a, ["k"], order=["v"])
    b = spark.createDataFrame([("k1", "2024-01-02", 2), ("k2", "2024-01-02", 2)], "k string, d string, v int") \
        .withColumn("event_date", F.col("d").cast("date")).drop("d")
    upsert(spark, path, b, ["k"], order=["v"])
    got = _keys(spark.read.parquet(path), "k", "v")
    assert got == [("k1", 2), ("k2", 2)]
    assert not os.path.exists(os.path.join(path, "event_date=2024-01-01"))
    upsert(spark, path, b, ["k"], order=["v"])          # re-run is idempotent
    assert spark.read.parquet(path).count() == 2


def test_upsert_refuses_null_key(spark, tmp_path):
    df = spark.createDataFrame([(None, 1)], "k string, v int").withColumn("event_date", F.current_date())
    with pytest.raises(ValueError):
        upsert(spark, str(tmp_path / "t"), df, ["k"], order=["v"])


def _run_batches(spark, path, batches, mode):
    for rows in batches:
        run_silver_events(spark, bronze_rows(spark, rows), path, "2024-01-31", 30, merge_mode=mode)
    return spark.read.parquet(path)


def test_reference_merge_keeps_superseded_rows_T3(spark, tmp_path):
    full = silver_parcel_events(bronze_rows(spark, ROWS), "2024-01-31", 30)
    inc = _run_batches(spark, str(tmp_path / "ref"), [ROWS[:3], ROWS[3:]], "reference")
    # p1 has SCAN_IN_DEPOT in both batches: the reference keeps both rows.
    assert inc.count() == full.count() + 2
    conv = _run_batches(spark, str(tmp_path / "conv"), [ROWS[:3], ROWS[3:]], "convergent")
    assert _keys(conv, "event_id") == _keys(full, "event_id")


@pytest.mark.parametrize("split", [1, 2, 4, 5])
def test_convergent_equals_full_refresh(spark, tmp_path, split):
    full = silver_parcel_events(bronze_rows(spark, ROWS), "2024-01-31", 30)
    conv = _run_batches(spark, str(tmp_path / f"c{split}"), [ROWS[:split], ROWS[split:]], "convergent")
    assert _keys(conv, "event_id", "event_type") == _keys(full, "event_id", "event_type")


def test_high_water_strict_and_late_rows_T4(spark, tmp_path):
    path = str(tmp_path / "hw")
    _run_batches(spark, path, [ROWS[3:]], "reference")
    late = [ev("e9", "p3", "SCAN_IN_DEPOT", "2024-01-11 00:00:00", 1, depot_id="d9")]
    _run_batches(spark, path, [late], "reference")
    assert "e9" not in {r.event_id for r in spark.read.parquet(path).collect()}   # dropped for good
    run_silver_events(spark, bronze_rows(spark, late), path, "2024-01-31", 30, lateness_seconds=3 * 86400)
    assert "e9" in {r.event_id for r in spark.read.parquet(path).collect()}       # lateness readmits


def test_empty_target_admits_nothing_unless_null_safe(spark):
    b = bronze_rows(spark, ROWS)
    assert silver_parcel_events(b, "2024-01-31", 30, Incremental(None)).count() == 0
    assert silver_parcel_events(b, "2024-01-31", 30, Incremental(None, null_safe=True)).count() == 4


def test_fact_date_high_water_T5(spark, tmp_path):
    s_path, f_path = str(tmp_path / "s"), str(tmp_path / "f")
    a = [ev("a1", "p1", "SCAN_IN_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d1"),
         ev("a2", "p1", "SCAN_OUT_DEPOT", "2024-01-10 10:30:00", 2, depot_id="d1")]
    b = [ev("b1", "p2", "SCAN_IN_DEPOT", "2024-01-10 12:00:00", 1, depot_id="d2"),
         ev("b2", "p2", "SCAN_OUT_DEPOT", "2024-01-10 12:30:00", 2, depot_id="d2")]
    for rows in (a, b):
        run_silver_events(spark, bronze_rows(spark, rows), s_path, "2024-01-31", 30)
        run_fact(spark, "fact_depot_visits", s_path, f_path, "2024-01-31", 30)
    # 2024-01-10 already had a row, so its later stay never loads (T5)...
    assert spark.read.parquet(f_path).count() == 1
    run_fact(spark, "fact_depot_visits", s_path, f_path, "2024-01-31", 30, reprocess_days=1)
    # ...unless recent days are reprocessed (the merge key keeps it idempotent).
    assert spark.read.parquet(f_path).count() == 2
    run_fact(spark, "fact_depot_visits", s_path, f_path, "2024-01-31", 30, reprocess_days=1)
    assert spark.read.parquet(f_path).count() == 2
