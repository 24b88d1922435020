"""Producer data rules kept from the event simulator: context injection
(C10) and monotone event-time repair per parcel (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import types_allowing

CONTEXT_FIELDS = ("route_id", "courier_id", "depot_id", "merchant_id")


def parcel_context(df: DataFrame, fields=CONTEXT_FIELDS, key: str = "parcel_id") -> DataFrame:
    """Per-parcel context values: a deterministic representative (``min``)
    of each field over the parcel's events. A partial + final aggregate."""
    return df.groupBy(key).agg(*[F.min(f).alias(f"ctx_{f}") for f in fields])


def inject_context(df: DataFrame, ctx: DataFrame, fields=CONTEXT_FIELDS, key: str = "parcel_id") -> DataFrame:
    """Copy a context value into an event only where the event type's
    contract allows that field and the event lacks it (absent or NULL)."""
    j = df.join(ctx, key, "left")
    out = []
    for c in df.columns:
        if c in fields:
            allowed = types_allowing(c)
            out.append(F.when(F.col("event_type").isin(*allowed), F.coalesce(F.col(c), F.col(f"ctx_{c}")))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def repair_event_time(df: DataFrame, key: str = "parcel_id", ts: str = "event_ts",
                      order=("sequence_no", "event_ts", "event_id"), step_seconds: int = 1) -> DataFrame:
    """C11: walk each parcel's events in lifecycle order and, where an event
    is earlier than the previous *repaired* time, set it to that time plus
    one second. Not a running max: [10, 5, 20, 19, 19] -> [10, 11, 20, 21, 22].

    The recurrence is sequential within a parcel, so it is a streaming fold:
    rows are hash-partitioned by parcel and sorted within each partition
    (Spark's sort spills), then ``mapInPandas`` walks the sorted Arrow
    batches carrying one value (the parcel's last repaired time) from row to
    row and batch to batch. Memory is one batch, whatever a parcel's size;
    no group is ever collected.
    """
    import numpy as np

    step = np.timedelta64(int(step_seconds) * 1_000_000, "us")
    order = [c for c in order if c in df.columns]

    def fold(batches):
        cur, prev = object(), None
        for pdf in batches:
            keys = pdf[key].to_numpy()
            t = pdf[ts].to_numpy().astype("datetime64[us]")
            out = t.copy()
            for i in range(len(t)):
                if keys[i] != cur:
                    cur, prev = keys[i], None
                v = t[i]
                if prev is not None and not np.isnat(v) and not np.isnat(prev) and v < prev:
                    v = prev + step
                out[i] = v
                prev = v
            pdf[ts] = out
            yield pdf

    walked = df.repartition(key).sortWithinPartitions(key, *order)
    return walked.mapInPandas(fold, df.schema)
