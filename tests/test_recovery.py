"""Runs that stop half-way: the keyed upsert, compaction, counts, typing."""

import datetime as dt

import pytest
from conftest import ev, bronze_rows

from parcelflow.operators.quality import Check, freshness, run_suite
from parcelflow.sources import bronze as B
from parcelflow.sources import tables as T
from parcelflow.streaming import ingest as S


def _rows(spark, path):
    return sorted((r.event_id, r.event_date, r.sequence_no) for r in T.read_table(spark, path).select("event_id", "event_date", "sequence_no").collect())


def _events(spark, ids, day, seq):
    df = bronze_rows(spark, [ev(f"e{k}", f"p{k}", "delivered", f"2024-01-{day:02d} 10:00:00", seq) for k in ids])
    return df.withColumn("event_date", df["event_ts"].cast("date"))


@pytest.mark.parametrize("fail_at", range(6))
def test_upsert_survives_a_stop_at_any_rename(spark, tmp_path, monkeypatch, fail_at):
    path, clean = str(tmp_path / "t"), str(tmp_path / "clean")
    first = _events(spark, range(6), 1, 1).unionByName(_events(spark, range(6, 10), 2, 1)).unionByName(_events(spark, [20], 4, 1))
    update = _events(spark, [0, 1, 20], 2, 2).unionByName(_events(spark, [30], 3, 2))      # keys move between days; day 4 empties
    for p in (path, clean):
        T.upsert(spark, p, first, "event_id")
    T.upsert(spark, clean, update, "event_id")
    calls, real = [0], T._rename

    def failing(fs, a, b):
        calls[0] += 1
        if calls[0] == fail_at + 1:
            raise OSError("stopped here")
        real(fs, a, b)

    monkeypatch.setattr(T, "_rename", failing)
    try:
        T.upsert(spark, path, update, "event_id")
    except OSError:
        pass
    monkeypatch.setattr(T, "_rename", real)
    T.upsert(spark, path, update, "event_id")
    assert _rows(spark, path) == _rows(spark, clean)
    assert [x.name for x in tmp_path.iterdir() if "__" in x.name] == []


def test_typing_is_exact_and_strict(spark):
    from parcelflow.functions.validate import _typed, with_variant
    from pyspark.sql import types as Y

    raw = ['{"sequence_no":9007199254740993,"event_ts":"2024-01-02T03:04:05Z"}', '{"sequence_no":12345678901234567890123,"event_ts":"12:00"}',
           '{"sequence_no":7.9,"event_ts":"2024"}', '{"sequence_no":-3,"event_ts":"hello"}', '{"sequence_no":"12","event_ts":5}']
    df = with_variant(spark.createDataFrame([(x,) for x in raw], "raw string").coalesce(1), "raw")
    got = df.select(_typed("sequence_no", Y.LongType()).alias("n"), _typed("event_ts", Y.TimestampType()).alias("t")).collect()
    assert [r.n for r in got] == [9007199254740993, None, 7, -3, 12]
    assert [r.t for r in got] == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None, None]


def test_counts_are_kept_for_every_batch(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for k in range(6):
        (src / f"{k}.txt").write_text("no json\n" * (k + 1))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        q = S.start_ingest(S.read_event_stream(spark, str(src), max_files_per_trigger=1), str(tmp_path / "b"), str(tmp_path / "q"), str(tmp_path / "c"))
        S.drain(q)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = S.ingest_counts(spark, str(tmp_path / "q")).collect()
    assert len(rows) == 6 and sum(r.rejected for r in rows) == 21 and sum(r.accepted for r in rows) == 0


@pytest.mark.parametrize("fail_at", range(5))
def test_compaction_survives_a_stop(spark, tmp_path, monkeypatch, fail_at):
    path = str(tmp_path / "b")
    for k in range(3):
        _events(spark, [k, k + 10], 1 + k, 1).write.partitionBy("event_date").parquet(f"{path}/batch_id={k}")
    want = _rows(spark, path)
    calls, real = [0], T._rename

    def failing(fs, a, b):
        calls[0] += 1
        if calls[0] == fail_at + 1:
            raise OSError("stopped here")
        real(fs, a, b)

    monkeypatch.setattr(S, "_rename", failing)
    try:
        S.compact_batches(spark, path, 2)
    except OSError:
        pass
    monkeypatch.setattr(S, "_rename", real)
    S.compact_batches(spark, path, 2)
    assert _rows(spark, path) == want
    assert sorted(x.name for x in (tmp_path / "b").iterdir() if not x.name.startswith(".")) == ["batch_id=2"]


def test_one_day_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        B.append_bronze(_events(spark, range(4000), 1, 1).drop("event_date"), str(tmp_path / "b"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in (tmp_path / "b" / "event_date=2024-01-01").iterdir() if f.name.endswith(".parquet")]) > 1


def test_retention_reaches_days_below_batches(spark, tmp_path):
    for k in range(2):
        _events(spark, [k], 1 + 20 * k, 1).write.partitionBy("event_date").parquet(f"{tmp_path}/b/batch_id={k}")
    assert B.expire_partitions(spark, f"{tmp_path}/b", "2024-01-22", 5) == ["2024-01-01"]


def test_unique_takes_any_expression(spark):
    df = spark.createDataFrame([("a1",), ("a2",)], "x string")
    checks = [Check("m", "unique", c) for c in ("substr(x, 1, 1)", "md5(x)", "concat(x, nope)")]
    got = [(r.status, r.message) for r in run_suite(spark, {"m": df}, checks).collect()]
    assert got == [("fail", None), ("pass", None), ("error", "missing column nope")]


def test_freshness_prunes_days(spark, tmp_path):
    _events(spark, range(3), 1, 1).write.partitionBy("event_date").parquet(f"{tmp_path}/b")
    df = freshness(spark.read.parquet(f"{tmp_path}/b"), "event_ts", dt.datetime(2024, 1, 2))
    assert "event_date" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]


def test_many_batches_are_all_counted_and_limits_stop_the_query(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for k in range(150):
        (src / f"{k:03d}.txt").write_text("x\n")
    rate = lambda chk: (spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(src)).withColumn("is_valid", (F := __import__("pyspark.sql.functions", fromlist=["x"])).lit(False))
                        .observe("ingest_metrics", F.count_if("is_valid").alias("accepted"), F.count_if(~F.col("is_valid")).alias("rejected"))
                        .writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/{chk}").trigger(availableNow=True).start())
    q = rate("a")
    assert S.drain(q, max_messages=5)["nacked"] < 150 and not q.isActive           # stopped, not left running
    q = rate("b")
    assert S.drain(q, timeout_seconds=0.5)["nacked"] < 150 and not q.isActive
    assert S.drain(rate("c")) == {"acked": 0, "nacked": 150, "batches": 150}
