"""Redelivery of rejected messages, and the dead letters.

The hot ingest does not wait for a message that fails: it hands it over
(``nack_path`` of :func:`parcelflow.streaming.ingest.start_ingest`) and goes
on. A second query, with its own checkpoint, delivers such messages again:

* its input is the handed-over messages and its own ``retry_path``, where every
  micro-batch leaves the messages that are to come back;
* each message is validated and typed anew as column expressions, under the
  contracts of this run. So a message that failed for a field of a contract not
  deployed yet passes as soon as the query is restarted with the newer one;
* a counter numbers the deliveries of each message. It travels with the message
  in ``retry_path``, so a micro-batch groups the messages handed over and those
  that came back by message, once, and the counting is column expressions: no
  call of Python and no state look-up per message. The hot path's delivery was
  the first. A message that passes goes to bronze; one that fails waits for a
  backoff that doubles from ``min_backoff`` to ``max_backoff`` seconds; after
  ``max_attempts`` failed deliveries it goes to the dead letters with its reasons.

Only failing messages are shuffled or kept, never the good ones. A
message is its text (or an id the source gives it): copies of a text that come
while it is in flight are counted with it and don't get lives of their own; a
text that comes again after it was delivered or set aside begins anew.

Outputs, the counters among them, are written below ``batch_id=<id>`` with
overwrite, and a batch's input is fixed by its offsets in the checkpoint, so a
batch repeated after a failure replaces its own files and counts no delivery twice.

A micro-batch may be everything that ever failed, so no partition of it is held
in memory: its outcomes are written once to ``outcomes``, in a stream of rows,
and each output reads its own rows and columns of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contracts import BRONZE_COLUMNS, all_fields, layer_type
from ..functions.validate import _typed, validate, with_variant
from ..sources.bronze import CLUSTER_COLS, PARTITION_COL
from ..sources.tables import _fs
from .ingest import SMALL_ROW_GROUPS, written_once

NACKED = "message_id string, raw string, copies long"
RETRY = "message_id string, raw string, due_ts timestamp, attempts int, copies long"
PARTITIONS = "spark.sql.shuffle.partitions"


@dataclass(frozen=True)
class RetryPolicy:
    """Failed deliveries after which a message is set aside, the first one
    included, and the bounds of the wait between two of them, in seconds."""

    max_attempts: int = 5
    min_backoff: int = 10
    max_backoff: int = 600

    def steps(self) -> int:
        """Failed deliveries after which the wait grows no more."""
        k = 1
        while k < 31 and self.wait(k) < self.max_backoff:
            k += 1
        return k

    def wait(self, attempts: int) -> int:
        return min(self.min_backoff << min(attempts - 1, 30), self.max_backoff)


def redelivered(messages: DataFrame, policy: RetryPolicy = RetryPolicy(), also_allowed=()) -> DataFrame:
    """Rows of one micro-batch (message_id, raw, copies, attempts, due_ts,
    batch_ts; attempts and due_ts null when handed over) -> a row per message
    with its outcome: ``delivered``, ``retry``, ``waiting`` (came back before its
    time) or ``dead``; ``copies`` as of this delivery, ``all_copies`` with those
    handed over meanwhile.

    A message that was in flight and ends in this micro-batch while copies of it
    are handed over gives a second row, the first delivery of its next life."""
    new = F.col("due_ts").isNull()
    # One row per message comes back: the maxima are of that row.
    each = messages.groupBy("message_id").agg(
        F.max(F.when(~new, F.col("raw"))).alias("_back"), F.max(F.when(new, F.col("raw"))).alias("_new"),
        F.max("due_ts").alias("due_ts"), F.coalesce(F.max(F.when(~new, F.col("attempts"))), F.lit(0)).alias("_before"),
        F.max(F.when(~new, F.col("copies"))).alias("_carried"), F.coalesce(F.sum(F.when(new, F.col("copies"))), F.lit(0)).alias("_more"),
        F.count_if(new).alias("_n_new"), F.max("batch_ts").alias("batch_ts"))
    v = validate(each.withColumn("raw", F.coalesce("_back", "_new")), "raw", layer="hot", also_allowed=also_allowed)
    text = F.array_sort(F.transform("violations", lambda x: F.concat(x["path"], F.lit(":"), x["rule"])))
    v = v.select(*each.columns, "raw", F.col("is_valid").alias("passes"), text.alias("reasons"))
    back, again = F.col("due_ts").isNotNull(), F.col("_n_new") > 0
    attempts = F.col("_before") + 1
    failed = F.when(attempts >= policy.max_attempts, "dead").otherwise("retry")
    outcome = F.when(F.col("due_ts") > F.col("batch_ts"), "waiting").when(back & F.col("passes"), "delivered").otherwise(failed)
    v = v.withColumn("outcome", outcome).withColumn("attempts", F.when(F.col("outcome") == "waiting", F.col("_before")).otherwise(attempts))
    flies = F.col("outcome").isin("retry", "waiting")
    wait = F.lit(policy.max_backoff)
    for k in range(policy.steps(), 0, -1):
        wait = F.when(F.col("attempts") <= k, policy.wait(k)).otherwise(wait)
    due = F.when(F.col("outcome") == "retry", F.timestamp_add("SECOND", wait, F.col("batch_ts"))).when(F.col("outcome") == "waiting", F.col("due_ts"))
    first = F.struct(F.col("raw"), F.col("outcome"), F.col("attempts").cast("int").alias("attempts"), F.when(back, F.col("_carried")).otherwise(F.col("_more")).alias("copies"),
                     F.when(~back, F.col("_more")).when(flies, F.col("_carried") + F.col("_more")).otherwise(F.col("_carried")).alias("all_copies"), due.alias("due_ts"), F.col("reasons"))
    starts = "dead" if policy.max_attempts <= 1 else "retry"
    due = F.timestamp_add("SECOND", F.lit(policy.wait(1)), F.col("batch_ts")) if starts == "retry" else F.lit(None).cast("timestamp")
    second = F.struct(F.col("_new").alias("raw"), F.lit(starts).alias("outcome"), F.lit(1).alias("attempts"), F.col("_more").alias("copies"), F.col("_more").alias("all_copies"),
                      due.alias("due_ts"), F.col("reasons"))
    lives = F.when(back & again & ~flies, F.array(first, second)).otherwise(F.array(first))
    return v.select("message_id", "batch_ts", F.inline(lives))


def _write_outcomes(messages: DataFrame, batch_id: int, bronze_path: str, retry_path: str, dead_path: str, log_path: str, outcomes_path: str, policy: RetryPolicy, also_allowed, partitions: int | None) -> None:
    with written_once(redelivered(messages, policy, also_allowed), f"{outcomes_path}/batch_id={batch_id}", {PARTITIONS: partitions}) as batch:
        good = with_variant(batch.filter("outcome = 'delivered'"), "raw")
        spec = all_fields()
        typed = good.select(*[_typed(c, layer_type(c, spec.get(c), "hot")).alias(c) for c in BRONZE_COLUMNS])
        (typed.withColumn(PARTITION_COL, F.to_date("event_ts")).hint("rebalance", PARTITION_COL).sortWithinPartitions(*CLUSTER_COLS)
            .write.mode("overwrite").partitionBy(PARTITION_COL).parquet(f"{bronze_path}/batch_id={batch_id}"))
        batch.filter("outcome in ('retry', 'waiting')").select("message_id", "raw", "due_ts", "attempts", F.col("all_copies").alias("copies")).write.mode("overwrite").options(**SMALL_ROW_GROUPS).parquet(f"{retry_path}/batch_id={batch_id}")
        batch.filter("outcome = 'dead'").select("message_id", "raw", "reasons", "attempts", "copies", "batch_ts").write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")
        batch.select("message_id", "outcome", "attempts", "copies", "batch_ts").write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")


def start_redelivery(spark: SparkSession, nack_path: str, base: str, checkpoint: str, policy: RetryPolicy = RetryPolicy(),
                     now: Column | None = None, also_allowed=(), available_now: bool = True, processing_time: str = "10 seconds", partitions: int | None = None):
    """Start the redelivery query; returns the StreamingQuery.

    ``partitions`` is the number of shuffle partitions of a micro-batch (the
    session's by default).

    Below ``base``: ``bronze`` (messages that passed, typed), ``retry`` (read
    again by this query), ``dead`` and ``log`` (every outcome), and ``outcomes``
    (of the micro-batch at work). With ``available_now`` a run makes one
    delivery of every message that is due.
    """
    bronze, retry, dead, log, outcomes = (f"{base}/{x}" for x in ("bronze", "retry", "dead", "log", "outcomes"))
    fs, _, jvm = _fs(spark, retry)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(retry))
    first = spark.readStream.schema(NACKED).parquet(nack_path).select("message_id", "raw", "copies", F.lit(None).cast("int").alias("attempts"), F.lit(None).cast("timestamp").alias("due_ts"))
    again = spark.readStream.schema(RETRY).parquet(retry).select("message_id", "raw", "copies", "attempts", "due_ts")
    # The stream's own clock: it is the same when a batch is repeated.
    messages = first.unionByName(again).withColumn("batch_ts", F.current_timestamp() if now is None else now)
    w = (messages.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
         .foreachBatch(lambda b, i: _write_outcomes(b, i, bronze, retry, dead, log, outcomes, policy, also_allowed, partitions)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_dead_letters(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema("message_id string, raw string, reasons array<string>, attempts int, copies long, batch_ts timestamp, batch_id long").parquet(f"{base}/dead")


def read_log(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema("message_id string, outcome string, attempts int, copies long, batch_ts timestamp, batch_id long").parquet(f"{base}/log")
