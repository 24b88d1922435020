"""The order of each parcel's events, restored on a stream.

The publisher numbers a parcel's events (``sequence_no``) and the transport may
deliver them late, out of order and more than once. :func:`ordered_stream` is a
reorder buffer per parcel (``transformWithState``, event time): an event whose
predecessors have all been released is released at once; one behind a gap waits
for the missing ones, but no longer than until the watermark passes its own
event time, since nothing older is expected then. So the output holds every
event once, in ``sequence_no`` order per parcel, with its gapless position.

State per parcel is small: the next number, the next position, and the events
that wait. The parcels of a cell (``CELLS`` of them, by hash) lie in one value,
so a micro-batch reads and writes one value per cell it touches, whatever the
number of parcels: each of these is a call from Python to the state store, which
costs more than the work on a parcel. What comes below a number already released is a second copy, or came after the watermark
had closed its gap, and is left out (a late event is also left out by Spark's
own watermark filter before it gets here).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import session_conf
from .redelivery import PARTITIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ORDERED = "parcel_id string, position long, sequence_no long, event_id string, event_type string, event_ts timestamp"


def release(waiting: list[tuple], next_no: int | None, closed_to) -> tuple[list[tuple], list[tuple], int | None]:
    """(released, still waiting, next number) of (number, event time, ...) tuples.

    An event goes when its number is the next one, or when ``closed_to`` (the
    watermark, or None) has passed the time of it or of one with a higher
    number. Numbers begin at 0.
    """
    next_no = 0 if next_no is None else next_no
    last = max((w[0] for w in waiting if closed_to is not None and w[1] <= closed_to), default=-1)
    out, left = [], []
    for w in sorted(waiting):
        if w[0] < next_no:
            continue
        if w[0] == next_no or w[0] <= last:
            out.append(w)
            next_no = w[0] + 1
        else:
            left.append(w)
    return out, left, next_no


#: Cells of parcels; fixed by the checkpoint. A task holds one cell's parcels at a time.
CELLS = 1 << 12


class ReorderBuffer(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Parcel -> [next number, next position, waiting [number, event time in microseconds, event id, event type]], as JSON.
        self.buffer = handle.getValueState("buffer", "parcels string")

    def _held(self) -> dict[str, list]:
        held = self.buffer.get()
        return json.loads(held[0]) if held else {}

    def _keep(self, parcels: dict[str, list]) -> None:
        self.buffer.update((json.dumps(parcels, separators=(",", ":"), ensure_ascii=False),))
        # The first event whose time the watermark will pass; the next one is registered then.
        first = min((w[1] for _, _, waiting in parcels.values() for w in waiting), default=None)
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))

    @staticmethod
    def _go(parcel_id: str, state: list, closed_to: int | None) -> Iterator[Row]:
        next_no, position, waiting = state
        out, left, next_no = release([tuple(w) for w in waiting], next_no, closed_to)
        state[:] = [next_no, position + len(out), left]
        for k, (number, ts, event_id, event_type) in enumerate(out):
            yield Row(parcel_id=parcel_id, position=position + k, sequence_no=number, event_id=event_id, event_type=event_type, event_ts=_time(ts))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parcels, came = self._held(), {}
        for r in rows:
            came.setdefault(r.parcel_id, []).append((r.sequence_no, r.event_us, r.event_id, r.event_type))
        for parcel_id, events in came.items():
            state = parcels.setdefault(parcel_id, [0, 0, []])
            seen = {w[0] for w in state[2]}
            for e in sorted(events, key=lambda e: e[:2] + (e[2] or "",)):
                if e[0] >= state[0] and e[0] not in seen:
                    seen.add(e[0])
                    state[2].append(e)
            yield from self._go(parcel_id, state, None)
        self._keep(parcels)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        parcels = self._held()
        # A timer can outlive the event it was for.
        closed_to, late = 1000 * max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()), False
        for parcel_id, state in parcels.items():
            if any(w[1] <= closed_to for w in state[2]):
                late = True
                yield from self._go(parcel_id, state, closed_to)
        if late:
            self._keep(parcels)

    def close(self) -> None:
        pass


def _time(micros: int):
    import datetime as dt

    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


def ordered_stream(events: DataFrame, delay: str = "1 day", cells: int = CELLS) -> DataFrame:
    """Each event once, in order per parcel, with its position. ``delay`` is how
    far behind the newest event time one may still come. Events without parcel,
    number or time can't be ordered and are left out. ``cells`` is fixed by the
    first run of a checkpoint."""
    d = events.where("parcel_id is not null and sequence_no >= 0 and event_ts is not null")
    d = d.select("parcel_id", F.col("sequence_no").cast("long").alias("sequence_no"), "event_id", "event_type", "event_ts")
    d = d.withWatermark("event_ts", delay)
    d = d.withColumn("event_us", F.unix_micros("event_ts")).withColumn("cell", F.pmod(F.xxhash64("parcel_id"), F.lit(cells)))
    return d.groupBy("cell").transformWithState(ReorderBuffer(), ORDERED, "append", "eventTime")


def start_ordered(spark: SparkSession, events: DataFrame, path: str, checkpoint: str, delay: str = "1 day", available_now: bool = True, partitions: int | None = None):
    """Append the ordered events to a Parquet table; returns the StreamingQuery."""
    w = ordered_stream(events, delay).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    with session_conf(spark, {PROVIDER: ROCKSDB, PARTITIONS: partitions}):
        return w.start(path)
