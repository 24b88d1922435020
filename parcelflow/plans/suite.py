"""The reference's 81 declarative data tests, as data, and the tables they
run against (E8).

Several tests name columns no model outputs (``courier_sk``,
``merchant_sk``, ``depot_sk``, ``exception_code_sk``, fact ``event_type``,
``visit_seq``, the deliveries' ``merchant_id``); they report ``error``
(T9). Fact relationships name no local column; the parent field is used
on both sides (T11). The service-tier list of ``dim_merchant`` differs from
the contract's tiers and is a warning (T10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import Check, run_suite
from ..sources.fixtures import bronze_from_dir
from . import facts, gold, silver, snapshots

# Accepted-value lists of the tests, in their published order.
BRONZE_EVENT_TYPES = ("PARCEL_CREATED", "SCAN_IN_DEPOT", "SCAN_OUT_DEPOT", "LOADED_TO_VAN", "OUT_FOR_DELIVERY",
                      "ETA_SET", "ETA_UPDATED", "EXCEPTION", "DELIVERED")
SILVER_EVENT_TYPES = ("PARCEL_CREATED", "SCAN_IN_DEPOT", "SCAN_OUT_DEPOT", "LOADED_TO_VAN", "OUT_FOR_DELIVERY",
                      "ETA_SET", "ETA_UPDATED", "DELIVERED", "EXCEPTION")
TEST_SERVICE_TIERS = ("STANDARD", "EXPRESS", "SAME_DAY")
ATTEMPT_EVENT_TYPES = ("DELIVERED", "EXCEPTION")
ETA_EVENT_TYPES = ("ETA_SET", "ETA_UPDATED")


def _nn(model, *cols):
    return [Check(model, "not_null", c) for c in cols]


def _uq(model, *cols):
    return [Check(model, "unique", c) for c in cols]


def _rel(model, to, field, severity="error", column=None):
    return Check(model, "relationships", column or field, to=to, field=field, severity=severity)


REFERENCE_TESTS: list[Check] = [
    # bronze source
    *_nn("parcel_events", "event_id", "parcel_id", "event_type"),
    Check("parcel_events", "accepted_values", "event_type", BRONZE_EVENT_TYPES),
    *_nn("parcel_events", "event_ts"),
    # silver
    *_nn("silver_parcel_events", "event_id"), *_uq("silver_parcel_events", "event_id"),
    *_nn("silver_parcel_events", "parcel_id", "event_type"),
    Check("silver_parcel_events", "accepted_values", "event_type", SILVER_EVENT_TYPES),
    *_nn("silver_parcel_events", "event_ts"),
    *_nn("silver_parcel_latest", "parcel_id"), *_uq("silver_parcel_latest", "parcel_id"),
    *_nn("silver_parcel_latest", "event_id"),
    _rel("silver_parcel_latest", "silver_parcel_events", "event_id"),
    *_nn("silver_parcel_latest", "event_ts"),
    # dimensions
    *_nn("dim_courier", "courier_sk"), *_uq("dim_courier", "courier_sk"),
    *_nn("dim_courier", "courier_id", "dbt_valid_from"),
    *_nn("dim_merchant", "merchant_sk"), *_uq("dim_merchant", "merchant_sk"),
    *_nn("dim_merchant", "merchant_id"),
    Check("dim_merchant", "accepted_values", "service_tier", TEST_SERVICE_TIERS, severity="warn"),
    *_nn("dim_merchant", "dbt_valid_from"),
    *_nn("dim_depot", "depot_sk"), *_uq("dim_depot", "depot_sk"),
    *_nn("dim_depot", "depot_id"), *_uq("dim_depot", "depot_id"),
    *_nn("dim_route", "route_sk"), *_uq("dim_route", "route_sk"),
    *_nn("dim_route", "route_id"), *_uq("dim_route", "route_id"),
    *_nn("dim_exception_code", "exception_code_sk"), *_uq("dim_exception_code", "exception_code_sk"),
    *_nn("dim_exception_code", "exception_code"), *_uq("dim_exception_code", "exception_code"),
    *_nn("dim_service_tier", "service_tier_sk"), *_uq("dim_service_tier", "service_tier_sk"),
    *_nn("dim_service_tier", "service_tier"), *_uq("dim_service_tier", "service_tier"),
    # facts
    *_nn("fact_parcel_delivery_attempts", "parcel_id", "attempt_number", "attempt_ts"),
    Check("fact_parcel_delivery_attempts", "accepted_values", "event_type", ATTEMPT_EVENT_TYPES),
    *_nn("fact_parcel_delivery_attempts", "event_date"),
    Check("fact_parcel_delivery_attempts", "unique",
          "concat(cast(parcel_id as string), '-', cast(attempt_number as string))"),
    _rel("fact_parcel_delivery_attempts", "dim_courier", "courier_id", "warn"),
    _rel("fact_parcel_delivery_attempts", "dim_route", "route_id", "warn"),
    *_nn("fact_parcel_deliveries", "parcel_id"), *_uq("fact_parcel_deliveries", "parcel_id"),
    *_nn("fact_parcel_deliveries", "delivered_ts"),
    Check("fact_parcel_deliveries", "accepted_values", "event_type", ("DELIVERED",)),
    *_nn("fact_parcel_deliveries", "event_date"),
    _rel("fact_parcel_deliveries", "dim_merchant", "merchant_id", "warn"),
    _rel("fact_parcel_deliveries", "dim_courier", "courier_id", "warn"),
    _rel("fact_parcel_deliveries", "dim_route", "route_id", "warn"),
    *_nn("fact_eta_events", "parcel_id", "generated_ts", "predicted_delivery_ts"),
    Check("fact_eta_events", "accepted_values", "event_type", ETA_EVENT_TYPES),
    *_nn("fact_eta_events", "event_date"),
    Check("fact_eta_events", "unique", "concat(cast(parcel_id as string), '-', cast(generated_ts as string))"),
    _rel("fact_eta_events", "dim_route", "route_id", "warn"),
    *_nn("fact_depot_visits", "parcel_id", "depot_id", "in_depot_ts", "event_date"),
    Check("fact_depot_visits", "unique",
          "concat(cast(parcel_id as string), '-', cast(depot_id as string), '-', cast(visit_seq as string))"),
    _rel("fact_depot_visits", "dim_depot", "depot_id", "warn"),
    # helper views
    *_nn("vw_eta_error_p95", "event_date", "eta_p95_error_min"),
    Check("vw_eta_error_p95", "unique",
          "concat(cast(event_date as string), '|', coalesce(cast(depot_id as string), ''), '|', "
          "coalesce(cast(courier_id as string), ''), '|', coalesce(cast(merchant_id as string), ''))"),
    *_nn("vw_depot_dwell_p95", "event_date", "depot_id", "depot_dwell_p95_min"),
    Check("vw_depot_dwell_p95", "unique", "concat(cast(event_date as string), '|', cast(depot_id as string))"),
    *_nn("vw_first_attempt_success", "parcel_id"), *_uq("vw_first_attempt_success", "parcel_id"),
    Check("vw_first_attempt_success", "accepted_values", "delivered_any", (0, 1), quote=False),
    Check("vw_first_attempt_success", "accepted_values", "first_attempt_success", (0, 1), quote=False),
]

assert len(REFERENCE_TESTS) == 81, len(REFERENCE_TESTS)


def model_tables(spark: SparkSession, sf_dir: str, as_of: str = "2024-01-31", days: int = 30,
                 snap1_as_of: str = "2024-01-15", snap1_run_ts: str = "2024-01-16 00:00:00",
                 snap2_run_ts: str = "2024-02-01 00:00:00") -> dict[str, DataFrame]:
    """Every model of the build, from the fixture, keyed by model name."""
    bronze = bronze_from_dir(spark, sf_dir)
    # Silver feeds every other model: cut its lineage once with a reliable
    # checkpoint in the shared folder, so the many test actions do not
    # recompute it.
    s = silver.silver_parcel_events(bronze, as_of, days).checkpoint()
    s1 = silver.silver_parcel_events(bronze, snap1_as_of, days)
    snap_c = snapshots.snap_courier_scd2(snapshots.snap_courier_scd2(None, s1, snap1_run_ts), s, snap2_run_ts)
    snap_m = snapshots.snap_merchant_scd2(snapshots.snap_merchant_scd2(None, s1, snap1_run_ts), s, snap2_run_ts)
    t = {
        "parcel_events": bronze,
        "silver_parcel_events": s,
        "silver_parcel_latest": silver.silver_parcel_latest(s),
        "fact_depot_visits": facts.fact_depot_visits(s, as_of, days),
        "fact_eta_events": facts.fact_eta_events(s, as_of, days),
        "fact_parcel_deliveries": facts.fact_parcel_deliveries(s, as_of, days),
        "fact_parcel_delivery_attempts": facts.fact_parcel_delivery_attempts(s, as_of, days),
        "dim_courier": gold.dim_courier(snap_c),
        "dim_merchant": gold.dim_merchant(snap_m),
        "dim_depot": gold.dim_depot(s),
        "dim_route": gold.dim_route(s),
        "dim_exception_code": gold.dim_exception_code(s),
        "dim_service_tier": gold.dim_service_tier(s),
    }
    t["vw_depot_dwell_p95"] = gold.vw_depot_dwell_p95(t["fact_depot_visits"])
    t["vw_eta_error_p95"] = gold.vw_eta_error_p95(t["fact_eta_events"])
    t["vw_first_attempt_success"] = gold.vw_first_attempt_success(t["fact_parcel_delivery_attempts"])
    return t


def run_reference_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_suite(spark, model_tables(spark, sf_dir), REFERENCE_TESTS)
