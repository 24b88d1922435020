"""Ordered streams, schemas that grow, stored history."""

import datetime as dt
import json
import random

import pytest
from conftest import bronze_rows, ev
from pyspark.sql import functions as F

from parcelflow.sources import history as H
from parcelflow.sources import schema_log as L
from parcelflow.sources import tables as T
from parcelflow.streaming import reorder as R


# ---- R4 -------------------------------------------------------------------------

def test_release_rules():
    t = lambda k: dt.datetime(2024, 1, 1 + k)
    assert R.release([(1, t(1)), (0, t(0)), (3, t(3))], None, None) == ([(0, t(0)), (1, t(1))], [(3, t(3))], 2)
    assert R.release([(3, t(3)), (5, t(5))], 2, t(2)) == ([], [(3, t(3)), (5, t(5))], 2)
    assert R.release([(3, t(3)), (5, t(5))], 2, t(4)) == ([(3, t(3))], [(5, t(5))], 4)
    assert R.release([(3, t(9)), (5, t(5))], 2, t(6)) == ([(3, t(9)), (5, t(5))], [], 6)      # a lower number never comes after a higher one
    assert R.release([(1, t(1))], 2, t(9)) == ([], [], 2)                                     # a copy of one released


def test_stream_is_ordered_once(spark, tmp_path):
    """Shuffled, late and repeated arrival over several batches, with gaps."""
    rnd, src = random.Random(1), str(tmp_path / "src")
    start = dt.datetime(2024, 1, 1)
    events = [(f"p{p}", n, f"e{p}-{n}", "SCAN", start + dt.timedelta(hours=p + 2 * n)) for p in range(12) for n in range(14) if not (p % 3 == 0 and n == 5)]
    parts = [[] for _ in range(4)]
    for e in events:
        arrival = (e[4] - start).total_seconds() / 3600 + rnd.random() * 9
        parts[min(3, int(arrival // 10))].append(e)
        if rnd.random() < 0.2:
            parts[min(3, int(arrival // 10) + 1)].append(e)
    parts.append([("clock", 0, "c", "TICK", dt.datetime(2024, 3, 1))])
    schema = "parcel_id string, sequence_no long, event_id string, event_type string, event_ts timestamp"
    out = None
    for part in parts:                       # one run a part: the buffer comes back from the checkpoint each time
        rnd.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        R.start_ordered(spark, spark.readStream.schema(schema).parquet(src), f"{tmp_path}/out", f"{tmp_path}/chk", "20 hours", partitions=2).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").where("parcel_id <> 'clock'").collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.parcel_id, r.position)):
        got.setdefault(r.parcel_id, []).append((r.position, r.sequence_no, r.event_id))
    want = {}
    for p, n, e, _, _ in sorted(events, key=lambda e: (e[0], e[1])):
        want.setdefault(p, []).append((len(want.get(p, [])), n, e))
    assert got == want


# ---- C7 -------------------------------------------------------------------------

def _batch(spark, ids, day, **extra):
    df = bronze_rows(spark, [ev(f"e{k}", f"p{k}", "delivered", f"2024-01-{day:02d} 10:00:00", k) for k in ids]).select("event_id", "event_ts", "sequence_no", "producer")
    return df.withColumn("event_date", F.to_date("event_ts")).withColumns({k: F.expr(v) for k, v in extra.items()})


def test_columns_are_added_and_types_stay(spark, tmp_path):
    path, bad = str(tmp_path / "t"), str(tmp_path / "refused")
    L.upsert_evolving(spark, path, _batch(spark, range(4), 1), "event_id", bad)
    second = _batch(spark, [2, 3, 4, 5, 6], 2, carrier="concat('c', sequence_no)", weight="sequence_no * 10L", sequence_no="if(sequence_no = 5, 'five', cast(sequence_no * 100 as string))")
    assert L.upsert_evolving(spark, path, second, "event_id", bad)["inserted_or_updated"] == 4
    third = _batch(spark, [0, 7], 3, note="'n'").drop("producer")                    # lacks known columns
    L.upsert_evolving(spark, path, third, "event_id", bad)
    out = L.read_evolved(spark, path)
    assert out.columns == ["event_id", "event_ts", "sequence_no", "producer", "event_date", "carrier", "weight", "note"]
    assert dict(out.dtypes)["sequence_no"] == "bigint"
    rows = {r.event_id: (r.sequence_no, r.producer, r.carrier, r.weight, r.note, r.event_date.day) for r in out.collect()}
    assert rows == {"e0": (0, None, None, None, "n", 3), "e1": (1, "t", None, None, None, 1), "e2": (200, "t", "c2", 20, None, 2), "e3": (300, "t", "c3", 30, None, 2),
                    "e4": (400, "t", "c4", 40, None, 2), "e6": (600, "t", "c6", 60, None, 2), "e7": (7, None, None, None, "n", 3)}
    refused = [(json.loads(r.row), r.failed) for r in spark.read.parquet(bad).collect()]
    assert [(r["event_id"], r["sequence_no"], f) for r, f in refused] == [("e5", "five", ["sequence_no"])]
    assert T.read_table(spark, path).count() == 7


def test_two_writers_extend_the_schema(spark, tmp_path):
    from pyspark.sql import types as Y
    path = str(tmp_path / "t")
    cols = lambda *n: Y.StructType([Y.StructField(x, Y.StringType()) for x in n])
    L.extend_schema(spark, path, cols("a"))
    L.extend_schema(spark, path, cols("a", "b"))
    assert L.extend_schema(spark, path, cols("c")).names == ["a", "b", "c"]
    assert L.extend_schema(spark, path, cols("b")).names == ["a", "b", "c"] and L._newest(spark, path) == 2


# ---- D1, D2, J5 -------------------------------------------------------------------

def _source(spark, **rows):
    return spark.createDataFrame([(k, v, f"seen {v}") for k, v in rows.items()], "k string, v string, seen string")


def test_key_leaves_and_returns(spark, tmp_path):
    path, days = str(tmp_path / "h"), ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
    run = lambda n, **rows: H.run_snapshot(spark, path, _source(spark, **rows), "k", ["v"], days[n])
    assert H.read_history(spark, path) is None
    assert run(0, a="1", b="1", c=None) == {"new": 3}
    before = sorted(map(tuple, H.read_history(spark, path).collect()), key=str)

    # A run that stops before its commit is not seen, and can be repeated.
    feed = H.change_feed(H.read_current(spark, path), _source(spark, a="2", c="x"), "k", ["v"], days[1])
    feed.write.parquet(f"{path}/changes/run={H._micros(days[1])}")
    feed.where("change in ('changed', 'deleted')").select("old.*").write.parquet(f"{path}/closed/run={H._micros(days[1])}")
    assert sorted(map(tuple, H.read_history(spark, path).collect()), key=str) == before and H.read_changes(spark, path).count() == 3

    assert run(1, a="2", c="x") == {"changed": 2, "deleted": 1}
    reader = H.read_history(spark, path)                     # a reader that began before the next run
    seen = sorted(map(tuple, reader.collect()), key=str)
    assert run(2, a="2", b="1", c="x", d="9") == {"unchanged": 2, "returned": 1, "new": 1}
    assert sorted(map(tuple, reader.collect()), key=str) == seen
    assert run(2, a="other") == {"unchanged": 2, "returned": 1, "new": 1}          # published: a repeat changes nothing
    with pytest.raises(ValueError):
        run(1, a="3")
    got = sorted((r.k, r.v, str(r.dbt_valid_from)[8:10], str(r.dbt_valid_to)[8:10]) for r in H.read_history(spark, path).fillna("-").collect())
    assert got == [("a", "1", "01", "02"), ("a", "2", "02", ""), ("b", "1", "01", "02"), ("b", "1", "03", ""), ("c", "-", "01", "02"), ("c", "x", "02", ""), ("d", "9", "03", "")]
    assert H.read_current(spark, path).count() == 4
    assert H.read_history(spark, path, days[1]).count() == 5
    assert H.drop_versions(spark, path, 1) == [H._micros(d) for d in days[:2]] and H.read_history(spark, path).count() == 7
    H.run_snapshot(spark, path, _source(spark, a="2"), "k", ["v"], "2024-01-04 00:00:00", invalidate_hard_deletes=False)
    assert H.read_current(spark, path).count() == 4          # what left the source stays open
    with pytest.raises(ValueError):
        H.run_snapshot(spark, path, spark.createDataFrame([(None, "1", "s")], "k string, v string, seen string"), "k", ["v"], "2024-01-05 00:00:00")


def test_parcels_of_one_cell_are_one_state_call():
    """Parcels that share a cell cost one read and one write of the state, and are ordered each on its own."""
    from types import SimpleNamespace as NS
    calls, kept = [], {}
    state = NS(get=lambda: calls.append("get") or kept.get("v"), update=lambda v: calls.append("update") or kept.update(v=v))
    buffer = R.ReorderBuffer()
    buffer.init(NS(getValueState=lambda *a: state, registerTimer=lambda ms: calls.append(ms)))
    rows = [NS(parcel_id=f"p{p}", sequence_no=n, event_us=1_000_000 * n + 1, event_id=f"{p}-{n}", event_type="T") for n in (3, 1, 0, 1) for p in range(50)]
    out = list(buffer.handleInputRows((0,), iter(rows), None))
    assert calls == ["get", "update", 3001]
    assert sorted((r.parcel_id, r.position, r.sequence_no) for r in out) == sorted((f"p{p}", n, n) for p in range(50) for n in (0, 1))
    clock = lambda ms: (NS(getCurrentWatermarkInMs=lambda: ms), NS(getExpiryTimeInMs=lambda: ms))
    assert list(buffer.handleExpiredTimer((0,), *clock(2999))) == []
    assert {(r.position, r.sequence_no) for r in buffer.handleExpiredTimer((0,), *clock(3001))} == {(2, 3)}
