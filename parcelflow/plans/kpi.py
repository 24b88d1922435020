"""KPIs the reference names but does not compute (M1-M5); the definitions
are ours. All of them start from one per-parcel summary: a single
aggregation of the deduplicated events on parcel_id (one shuffle, partial
aggregation first), reused by every KPI.

They read silver with ``keep_latest_per_type=False``: the reference's
silver keeps only the newest event per (parcel, type), which drops earlier
delivery attempts and ETA updates (T2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import minutes_between
from ..operators.windows import dedup_latest
from .gold import vw_first_attempt_success


def _last(value: str, pred: Column, ts: str = "event_ts") -> Column:
    """The value of the newest event satisfying ``pred`` (NULL if none)."""
    return F.max_by(F.when(pred, F.col(value)), F.when(pred, F.col(ts)))


def parcel_summary(events: DataFrame) -> DataFrame:
    """One row per parcel: promise, tier, merchant, courier, last depot,
    first planned ETA, first successful delivery, last exception and last
    failure reason."""
    et = F.col("event_type")
    created = et == "PARCEL_CREATED"
    success = (et == "DELIVERED") & (F.col("outcome") == "SUCCESS")
    return events.groupBy("parcel_id").agg(
        F.min(F.when(created, F.to_date("event_ts"))).alias("created_date"),
        _last("promised_window_end", created).alias("promised_window_end"),
        _last("service_tier", created).alias("service_tier"),
        _last("merchant_id", created).alias("merchant_id"),
        _last("courier_id", et == "LOADED_TO_VAN").alias("courier_id"),
        _last("depot_id", et.isin("SCAN_IN_DEPOT", "SCAN_OUT_DEPOT")).alias("depot_id"),
        _last("first_planned_eta_ts", et == "OUT_FOR_DELIVERY").alias("first_planned_eta_ts"),
        F.min(F.when(success, F.col("delivered_ts"))).alias("delivered_ts"),
        _last("exception_code", et == "EXCEPTION").alias("exception_code"),
        _last("failure_reason", (et == "DELIVERED") & F.col("failure_reason").isNotNull()).alias("failure_reason"),
    )


def on_time_rate(summary: DataFrame) -> DataFrame:
    """M1: per delivery date and tier, parcels delivered (first SUCCESS) and
    the share delivered by the end of the promised window."""
    d = summary.filter(F.col("delivered_ts").isNotNull() & F.col("promised_window_end").isNotNull())
    on_time = F.col("delivered_ts") <= F.col("promised_window_end")
    return (d.groupBy(F.to_date("delivered_ts").alias("delivery_date"), "service_tier")
            .agg(F.count(F.lit(1)).alias("delivered"),
                 F.count_if(on_time).cast("bigint").alias("on_time"))
            .withColumn("on_time_rate", F.col("on_time") / F.col("delivered")))


def first_attempt_success_rate(attempts: DataFrame) -> DataFrame:
    """M2: per date, share of parcels whose first attempt succeeded
    (``outcome = 'SUCCESS'``; the reference's flag tests 'DELIVERED', T1)."""
    f = vw_first_attempt_success(attempts, success_outcomes=("SUCCESS",))
    return (f.groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("parcels"),
                 F.sum("first_attempt_success").cast("bigint").alias("first_attempt_successes"))
            .withColumn("first_attempt_success_rate", F.col("first_attempt_successes") / F.col("parcels")))


def eta_mae(events: DataFrame, summary: DataFrame) -> DataFrame:
    """M3: per delivery date, mean absolute error in minutes of the last ETA
    generated before the first successful delivery. The "last ETA before"
    is an as-of match done as an equi-join on parcel_id (each parcel has a
    handful of ETAs) followed by ``max_by`` per parcel - no range join."""
    etas = (events.filter(F.col("event_type").isin("ETA_SET", "ETA_UPDATED"))
            .select("parcel_id", "generated_ts", "predicted_delivery_ts"))
    d = summary.filter(F.col("delivered_ts").isNotNull()).select("parcel_id", "delivered_ts")
    j = etas.join(d, "parcel_id").filter(F.col("generated_ts") <= F.col("delivered_ts"))
    last = (j.groupBy("parcel_id", "delivered_ts")
            .agg(F.max_by("predicted_delivery_ts", "generated_ts").alias("predicted_delivery_ts")))
    err = F.abs(minutes_between("delivered_ts", "predicted_delivery_ts"))
    return (last.groupBy(F.to_date("delivered_ts").alias("delivery_date"))
            .agg(F.count(F.lit(1)).alias("parcels"), F.avg(err).alias("eta_mae_min")))


def eta_events_enriched(eta_events: DataFrame, summary: DataFrame) -> DataFrame:
    """M4 input: ETA facts with depot, courier, merchant and first planned
    ETA carried over from the parcel's other events (the ETA contracts
    forbid them on ETA rows, T6)."""
    ctx = summary.select("parcel_id", F.col("depot_id").alias("ctx_depot"), F.col("courier_id").alias("ctx_courier"),
                         F.col("merchant_id").alias("ctx_merchant"), F.col("first_planned_eta_ts").alias("ctx_eta"))
    j = eta_events.join(ctx, "parcel_id", "left")
    return j.select(
        *[c for c in eta_events.columns if c not in ("depot_id", "courier_id", "merchant_id", "first_planned_eta_ts")],
        F.coalesce("depot_id", "ctx_depot").alias("depot_id"),
        F.coalesce("courier_id", "ctx_courier").alias("courier_id"),
        F.coalesce("merchant_id", "ctx_merchant").alias("merchant_id"),
        F.coalesce("first_planned_eta_ts", "ctx_eta").alias("first_planned_eta_ts"))


def sla_breach(summary: DataFrame, as_of_ts) -> DataFrame:
    """M5: per creation date and attribution, parcels, breaches and breach
    rate. A breach is a first successful delivery after the promised window
    end, or no successful delivery by ``as_of_ts`` with the window passed.
    Attribution: the parcel's last exception code, else its last failure
    reason, else 'NONE'."""
    now = F.lit(str(as_of_ts)).cast("timestamp")
    s = summary.filter(F.col("promised_window_end").isNotNull())
    breached = (F.when(F.col("delivered_ts").isNotNull(), F.col("delivered_ts") > F.col("promised_window_end"))
                .otherwise(now > F.col("promised_window_end")))
    attr = F.coalesce("exception_code", "failure_reason", F.lit("NONE"))
    return (s.groupBy("created_date", attr.alias("attribution"))
            .agg(F.count(F.lit(1)).alias("parcels"), F.count_if(breached).cast("bigint").alias("breaches"))
            .withColumn("breach_rate", F.col("breaches") / F.col("parcels")))


def latest_created(events: DataFrame) -> DataFrame:
    """The newest PARCEL_CREATED row per parcel."""
    return dedup_latest(events.filter(F.col("event_type") == "PARCEL_CREATED"), ["parcel_id"])
