"""Late rows in any order give what a full refresh gives."""

import random

from conftest import bronze_rows, ev

from parcelflow.plans import facts, gold, refresh, silver
from parcelflow.streaming import ingest as S


def _events():
    rnd, out = random.Random(2), []
    for p in range(9):
        at = rnd.randrange(1, 20)
        for k in range(6):
            kind = "SCAN_IN_DEPOT" if k % 2 == 0 else "SCAN_OUT_DEPOT"
            out.append(ev(f"e{p}-{k}", f"p{p}", kind, f"2024-01-{at + k // 2:02d} {10 + k:02d}:00:00", k, depot_id=f"d{p % 2}{k // 4}"))
        out.append(ev(f"e{p}-0", f"p{p}", "SCAN_IN_DEPOT", f"2024-01-{at:02d} 10:30:00", 0, depot_id=f"d{p % 2}0"))        # a second copy
        out.append(ev(f"e{p}-8", f"p{p}", "ETA_SET", f"2024-01-{at + 3:02d} 12:00:00", 8, predicted_delivery_ts="2024-01-09 00:00:00", generated_ts="2024-01-02 00:00:00"))
        out.append(ev(f"e{p}-9", f"p{p}", "DELIVERED", f"2024-01-{at + 3:02d} 18:00:00", 9, attempt_number=1, outcome="SUCCESS", delivered_ts=f"2024-01-{at + 3:02d} 18:00:00", route_id="r", courier_id="c", predicted_delivery_ts="2024-01-01 00:00:00", generated_ts="2024-01-01 00:00:00"))
    rnd.shuffle(out)
    return out


def _rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_late_batches_equal_a_full_refresh(spark, tmp_path):
    rows, base = _events(), str(tmp_path / "t")
    for k in range(3):
        batch = bronze_rows(spark, rows[k::3])
        days = refresh.refresh(spark, base, batch, "2024-01-31", 30)
        assert days["silver_parcel_events"]
    again = refresh.refresh(spark, base, batch, "2024-01-31", 30)                     # the last batch once more
    assert set(again["fact_depot_visits"]) <= set(days["fact_depot_visits"])
    full = silver.silver_parcel_events(bronze_rows(spark, rows), "2024-01-31", 30)
    assert _rows(spark.read.parquet(f"{base}/silver_parcel_events")) == _rows(full)
    for name in ("fact_depot_visits", "fact_parcel_deliveries"):
        assert _rows(spark.read.parquet(f"{base}/{name}")) == _rows(getattr(facts, name)(full, "2024-01-31", 30))
    assert _rows(spark.read.parquet(f"{base}/vw_depot_dwell_p95")) == _rows(gold.vw_depot_dwell_p95(facts.fact_depot_visits(full, "2024-01-31", 30)))


def test_compaction_with_another_id_finds_what_was_left(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    for k in range(4):
        bronze_rows(spark, [ev(f"e{k}", "p", "DELIVERED", "2024-01-01 10:00:00", k)]).selectExpr("*", "date(event_ts) as event_date").write.partitionBy("event_date").parquet(f"{path}/batch_id={k}")
    real, calls = S._rename, []

    def stops(fs, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("stopped here")
        real(fs, a, b)

    monkeypatch.setattr(S, "_rename", stops)
    try:
        S.compact_batches(spark, path, 2)
    except OSError:
        pass
    monkeypatch.setattr(S, "_rename", real)
    S.compact_batches(spark, path, 3)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["e0", "e1", "e2", "e3"]
