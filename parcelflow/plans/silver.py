"""Silver models: typed, deduplicated events (Q1) and latest per parcel (Q2).

Plan shape of ``silver_parcel_events`` (full refresh): one scan with the
lookback predicate pushed to Parquet (and to the ``event_date`` partition
column when bronze is laid out by day), then two keyed window dedups, each a
partial WindowGroupLimit -> shuffle on its key -> final WindowGroupLimit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import event_date, lookback
from ..functions.contracts import BRONZE_COLUMNS
from ..operators.joins import restrict_to_keys
from ..operators.windows import dedup_latest

SILVER_COLUMNS = BRONZE_COLUMNS + ["event_date"]
TS_COLUMNS = ["event_ts", "created_ts", "promised_window_start", "promised_window_end",
              "first_planned_eta_ts", "predicted_delivery_ts", "generated_ts", "delivered_ts"]

DEFAULT_AS_OF = "2024-01-31"


@dataclass(frozen=True)
class Incremental:
    """Incremental-run parameters for the timestamp high-water filter (T4).

    ``high_water`` is the target's ``max(event_ts)``. The reference admits
    only ``event_ts > high_water`` and, when the target exists but is empty
    (NULL max), admits nothing. ``null_safe=True`` admits everything then;
    ``lateness_seconds`` moves the bound back so late rows are readmitted
    (the merge by key keeps the result idempotent).
    """

    high_water: object = None
    null_safe: bool = False
    lateness_seconds: int = 0

    def apply(self, df: DataFrame, ts: str = "event_ts") -> DataFrame:
        if self.high_water is None:
            return df if self.null_safe else df.filter(F.lit(False))
        bound = F.lit(self.high_water).cast("timestamp")
        if self.lateness_seconds:
            bound = F.timestamp_add("SECOND", F.lit(-int(self.lateness_seconds)), bound)
        cond = F.col(ts) > bound
        if "event_date" in df.columns:
            # Implied by the timestamp bound; lets a day-partitioned source
            # skip every directory before the high-water day.
            cond = cond & (F.col("event_date") >= F.to_date(bound))
        return df.filter(cond)


def typed_columns(bronze: DataFrame) -> DataFrame:
    """silver's columns, timestamps cast, with ``event_date``."""
    cols = [F.col(c).cast("timestamp").alias(c) if c in TS_COLUMNS else F.col(c) for c in BRONZE_COLUMNS]
    return bronze.select(*cols, event_date(F.col("event_ts").cast("timestamp")).alias("event_date"))


def typed_source(bronze: DataFrame, as_of=DEFAULT_AS_OF, days: int = 7,
                 incremental: Incremental | None = None) -> DataFrame:
    """Cast timestamps, derive ``event_date``, keep the lookback
    window and, on incremental runs, rows above the high-water mark."""
    if "event_date" in bronze.columns:
        # Bronze stored by day: filter the partition column itself so the
        # scan prunes directories (a predicate on DATE(event_ts) would not).
        bronze = bronze.filter(lookback("event_date", as_of, days))
    df = typed_columns(bronze).filter(lookback("event_date", as_of, days))
    return incremental.apply(df) if incremental is not None else df


def silver_parcel_events(bronze: DataFrame, as_of=DEFAULT_AS_OF, days: int = 7,
                         incremental: Incremental | None = None,
                         keep_latest_per_type: bool = True) -> DataFrame:
    """Q1: one row per event_id (newest copy wins, W1) and, by default, only
    the newest event per (parcel_id, event_type) within the batch (W2, T2).
    ``keep_latest_per_type=False`` keeps every deduplicated event."""
    df = dedup_latest(typed_source(bronze, as_of, days, incremental), ["event_id"])
    if keep_latest_per_type:
        df = dedup_latest(df, ["parcel_id", "event_type"])
    return df.select(*SILVER_COLUMNS)


def silver_parcel_latest(silver: DataFrame, changed_since=None, incremental: bool = False,
                         keep_rn: bool = False) -> DataFrame:
    """Q2: newest event per parcel across all types.

    On incremental runs only parcels with an event newer than
    ``coalesce(changed_since, 1970-01-01)`` are recomputed: the changed keys
    are applied as a left-semi join *before* the window, which gives the same
    rows as the reference's join after it while shuffling only changed
    parcels. ``keep_rn=True`` keeps the helper column the reference stores
    (always 1, T12).
    """
    base = silver.select(*[F.col(c).cast("timestamp").alias(c) if c in TS_COLUMNS else F.col(c)
                           for c in BRONZE_COLUMNS],
                         event_date(F.col("event_ts").cast("timestamp")).alias("event_date"))
    if incremental:
        bound = F.coalesce(F.lit(changed_since).cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))
        recent = F.col("event_date") >= F.to_date(bound)
        changed = silver.filter(recent & (F.col("event_ts") > bound)).select("parcel_id")
        # A changed parcel's newest event is itself newer than the bound, so
        # only days from the bound on are needed to find it: the window
        # reads recent partitions only, never the whole table.
        base = restrict_to_keys(base.filter(recent), changed, "parcel_id")
    out = dedup_latest(base, ["parcel_id"]).select(*SILVER_COLUMNS)
    return out.withColumn("rn", F.lit(1)) if keep_rn else out
