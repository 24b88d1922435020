"""Dedup tie-breaks, depot pairing edge cases, minute truncation."""

from conftest import bronze_rows, ev, ts

from pyspark.sql import functions as F

from parcelflow.functions.columns import minutes_between
from parcelflow.operators.windows import dedup_latest
from parcelflow.plans.facts import fact_depot_visits
from parcelflow.plans.silver import silver_parcel_events


def test_dedup_newest_then_sequence_then_event_id(spark):
    b = bronze_rows(spark, [
        ev("e1", "p1", "SCAN_IN_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d1"),
        ev("e1", "p1", "SCAN_IN_DEPOT", "2024-01-10 10:05:00", 1, depot_id="d2"),   # same id, newer copy
        ev("e2", "p1", "ETA_SET", "2024-01-10 11:00:00", 3),
        ev("e3", "p1", "ETA_SET", "2024-01-10 11:00:00", 4),                       # tie on ts: seq 4 wins
        ev("e5", "p1", "EXCEPTION", "2024-01-10 12:00:00", 5),
        ev("e4", "p1", "EXCEPTION", "2024-01-10 12:00:00", 5),                     # full tie: e5 wins
    ])
    out = {(r.event_type): r for r in silver_parcel_events(b, "2024-01-31", 30).collect()}
    assert out["SCAN_IN_DEPOT"].depot_id == "d2"
    assert out["ETA_SET"].event_id == "e3"
    assert out["EXCEPTION"].event_id == "e5"
    all_ = silver_parcel_events(b, "2024-01-31", 30, keep_latest_per_type=False)
    assert all_.count() == 5  # one per event_id


def test_dedup_plans_partial_group_limit(spark):
    b = bronze_rows(spark, [ev("e1", "p1", "ETA_SET", "2024-01-10 10:00:00")])
    plan = silver_parcel_events(b, "2024-01-31", 30)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "LocalTableScan" in plan


def _visits(spark, rows):
    s = silver_parcel_events(bronze_rows(spark, rows), "2024-01-31", 30, keep_latest_per_type=False)
    return sorted((r.depot_id, str(r.in_depot_ts), str(r.out_depot_ts), r.dwell_minutes, str(r.event_date))
                  for r in fact_depot_visits(s, "2024-01-31", 30).collect())


def test_pairing_in_in_out_pairs_second_in_only(spark):
    got = _visits(spark, [
        ev("a", "p", "SCAN_IN_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d"),
        ev("b", "p", "SCAN_IN_DEPOT", "2024-01-10 10:10:00", 2, depot_id="d"),
        ev("c", "p", "SCAN_OUT_DEPOT", "2024-01-10 10:40:00", 3, depot_id="d"),
    ])
    assert got == [("d", "2024-01-10 10:10:00", "2024-01-10 10:40:00", 30, "2024-01-10")]


def test_pairing_out_only_and_in_at_end(spark):
    assert _visits(spark, [ev("a", "p", "SCAN_OUT_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d")]) == []
    assert _visits(spark, [
        ev("a", "p", "SCAN_IN_DEPOT", "2024-01-10 10:00:00", 1, depot_id="d"),
        ev("b", "p", "SCAN_OUT_DEPOT", "2024-01-10 10:30:00", 2, depot_id="d"),
        ev("c", "p", "SCAN_IN_DEPOT", "2024-01-10 11:00:00", 3, depot_id="d"),
    ]) == [("d", "2024-01-10 10:00:00", "2024-01-10 10:30:00", 30, "2024-01-10")]


def test_pairing_two_depots_and_midnight(spark):
    got = _visits(spark, [
        ev("a", "p", "SCAN_IN_DEPOT", "2024-01-10 23:50:00", 1, depot_id="d1"),
        ev("b", "p", "SCAN_IN_DEPOT", "2024-01-10 23:55:00", 2, depot_id="d2"),
        ev("c", "p", "SCAN_OUT_DEPOT", "2024-01-11 00:20:00", 3, depot_id="d1"),
        ev("d", "p", "SCAN_OUT_DEPOT", "2024-01-11 00:05:00", 4, depot_id="d2"),
    ])
    assert got == [("d1", "2024-01-10 23:50:00", "2024-01-11 00:20:00", 30, "2024-01-10"),
                   ("d2", "2024-01-10 23:55:00", "2024-01-11 00:05:00", 10, "2024-01-10")]


def test_minutes_truncate_toward_zero(spark):
    df = spark.createDataFrame([
        (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")),
        (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:00")),
        (ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
        (ts("2024-01-01 00:01:30"), ts("2024-01-01 00:00:00")),
    ], "a timestamp, b timestamp")
    assert [r.m for r in df.select(minutes_between("a", "b").alias("m")).collect()] == [0, 1, 0, -1]


def test_dedup_latest_generic_key(spark):
    df = spark.createDataFrame([("m1", 1, "x"), ("m1", 2, "y"), ("m2", 1, "z")], "k string, o int, v string")
    got = sorted((r.k, r.v) for r in dedup_latest(df, ["k"], [F.col("o").desc()]).collect())
    assert got == [("m1", "y"), ("m2", "z")]


def test_repair_event_time_sequence(spark):
    from parcelflow.operators.repair import repair_event_time
    secs = [10, 5, 20, 19, 19]
    df = spark.createDataFrame([("p", i, ts(f"2024-01-01 00:00:{s:02d}"), f"e{i}") for i, s in enumerate(secs)]
                               + [("q", 0, ts("2024-01-01 00:00:03"), "x")],
                               "parcel_id string, sequence_no int, event_ts timestamp, event_id string")
    got = {(r.parcel_id, r.sequence_no): r.event_ts.second for r in repair_event_time(df).collect()}
    assert [got[("p", i)] for i in range(5)] == [10, 11, 20, 21, 22]
    assert got[("q", 0)] == 3


def test_bucketed_pairing_equals_single_window(spark):
    import datetime as dt
    import random

    from parcelflow.operators.windows import pair_events
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        p, d = f"p{rnd.randint(0, 3)}", f"d{rnd.randint(0, 1)}"
        t = ts("2024-01-10 00:00:00").timestamp() + rnd.randint(0, 3 * 86400)
        rows.append((p, d, rnd.choice(["SCAN_IN_DEPOT", "SCAN_OUT_DEPOT"]),
                     dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(tzinfo=None), rnd.randint(0, 3), f"e{i}"))
    df = spark.createDataFrame(rows, "parcel_id string, depot_id string, event_type string, event_ts timestamp, "
                                     "sequence_no int, event_id string")
    k = ["parcel_id", "depot_id"]
    got = sorted(map(tuple, pair_events(df, k, bucket_seconds=3600).select("event_id", "next_ts").collect()))
    want = sorted(map(tuple, pair_events(df, k, bucket_seconds=None).select("event_id", "next_ts").collect()))
    assert got == want and len(got) > 20
