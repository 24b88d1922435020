"""Rejected messages are delivered again, pass when they can, and are set aside after five failures."""

import json
import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from parcelflow.streaming import ingest as S
from parcelflow.streaming import redelivery as R


def _msg(i, **kw):
    d = {"schema_version": "1.0.0", "event_version": "1.0.0", "event_id": f"e{i}", "parcel_id": "p1", "event_type": "EXCEPTION",
         "event_ts": "2024-01-01T00:00:00Z", "producer": "t", "sequence_no": i, "exception_code": "MISSORT"}
    return json.dumps({**d, **kw})


def _at(seconds):
    return F.timestamp_seconds(F.lit(1_700_000_000 + seconds))


def test_five_deliveries_then_aside(spark, tmp_path):
    src, base = tmp_path / "src", str(tmp_path / "again")
    src.mkdir()
    lines = [_msg(1), _msg(2, event_ts="hello"), "{bad", "{bad", _msg(3, extra_note="x"), _msg(4, sequence_no=10**25)]
    (src / "a.txt").write_text("\n".join(lines) + "\n")
    q = S.start_ingest(S.read_event_stream(spark, str(src)), f"{tmp_path}/bronze", f"{tmp_path}/q", f"{tmp_path}/c1", nack_path=f"{tmp_path}/nack")
    assert S.drain(q) == {"acked": 1, "nacked": 5, "batches": 1}

    def run(seconds, **kw):
        R.start_redelivery(spark, f"{tmp_path}/nack", base, f"{tmp_path}/c2", now=_at(seconds), **kw).awaitTermination()
        return sorted((r.outcome, r.attempts, r.copies) for r in R.read_log(spark, base).where(F.col("batch_ts") == _at(seconds)).collect())

    assert run(0) == [("retry", 1, 1)] * 3 + [("retry", 1, 2)]
    assert run(5) == [("waiting", 1, 1)] * 3 + [("waiting", 1, 2)]           # before the backoff is over
    (src / "b.txt").write_text("{bad\n")                                      # a copy of a message in flight
    S.drain(S.start_ingest(S.read_event_stream(spark, str(src)), f"{tmp_path}/bronze", f"{tmp_path}/q", f"{tmp_path}/c1", nack_path=f"{tmp_path}/nack"))
    assert run(10) == [("retry", 2, 1)] * 3 + [("retry", 2, 2)]
    # The contract with extra_note is deployed: that message passes at its third delivery.
    assert run(30, also_allowed=["extra_note"]) == [("delivered", 3, 1), ("retry", 3, 1), ("retry", 3, 1), ("retry", 3, 3)]
    assert run(69) == [("waiting", 3, 1)] * 2 + [("waiting", 3, 3)]
    assert run(70) == [("retry", 4, 1)] * 2 + [("retry", 4, 3)]
    assert R.read_dead_letters(spark, base).count() == 0
    assert run(150) == [("dead", 5, 1)] * 2 + [("dead", 5, 3)]
    dead = {r.raw: (list(r.reasons), r.attempts, r.copies) for r in R.read_dead_letters(spark, base).collect()}
    assert dead == {lines[1]: (["event_ts:typing"], 5, 1), "{bad": (["<root>:malformed"], 5, 3), lines[5]: (["sequence_no:typing"], 5, 1)}
    assert [r.event_id for r in spark.read.parquet(f"{base}/bronze").collect()] == ["e3"]
    assert run(900) == []                                                     # nothing is left in flight


def test_backoff_doubles_to_its_bound():
    p = R.RetryPolicy()
    assert [p.wait(k) for k in (1, 2, 3, 6, 7, 100)] == [10, 20, 40, 320, 600, 600]


def test_copies_handed_over_while_a_message_ends(spark):
    """Counted by column expressions: a message that ends in a micro-batch and the copies that begin anew are two rows."""
    bad, good = "{bad", _msg(1)
    rows = [("b", bad, 2, 4, 0), ("b", bad, 3, None, None), ("b", bad, 1, None, None), ("g", good, 5, 2, 0), ("g", good, 7, None, None),
            ("w", bad, 1, 2, 60), ("w", bad, 9, None, None), ("n", bad, 6, None, None)]
    df = spark.createDataFrame(rows, "message_id string, raw string, copies long, attempts int, due int") \
        .select("message_id", "raw", "copies", "attempts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("due")).alias("due_ts"), _at(10).alias("batch_ts"))
    out = R.redelivered(df)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.message_id, r.outcome, r.attempts, r.copies, r.all_copies, r.due_ts and int((r.due_ts - r.batch_ts).total_seconds())) for r in out.collect())
    assert got == [("b", "dead", 5, 2, 2, None), ("b", "retry", 1, 4, 4, 10), ("g", "delivered", 3, 5, 5, None), ("g", "retry", 1, 7, 7, 10),
                   ("n", "retry", 1, 6, 6, 10), ("w", "waiting", 2, 1, 10, 50)]


def test_a_partition_larger_than_memory(tmp_path):
    """Half a GB of rejected texts in one shuffle partition pass through a JVM of 512 MB."""
    job = """
        import sys
        from pyspark.sql import functions as F
        from parcelflow.session import build_session
        from parcelflow.streaming import redelivery as R
        tmp = sys.argv[1]
        spark = build_session("local[1]", 1, extra={"spark.driver.memory": "512m", "spark.local.dir": f"{tmp}/local"})
        text = F.concat(F.lit("{bad"), F.col("id"), F.repeat(F.lit("x"), F.lit(8000)))
        spark.range(64_000).select(F.col("id").cast("string").alias("message_id"), text.alias("raw"), F.lit(1).cast("long").alias("copies")).write.parquet(f"{tmp}/nack")
        R.start_redelivery(spark, f"{tmp}/nack", f"{tmp}/again", f"{tmp}/chk").awaitTermination()
        log = R.read_log(spark, f"{tmp}/again").groupBy("outcome", "attempts").agg(F.sum("copies").alias("n"), F.countDistinct("message_id").alias("ids")).collect()
        print("LOG", *map(tuple, log))
        """
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(job), str(tmp_path)], env=env, capture_output=True, text=True, timeout=600)
    assert "LOG ('retry', 1, 64000, 64000)" in done.stdout, done.stderr[-3000:]
    assert not (tmp_path / "again" / "outcomes" / "batch_id=0").exists()
