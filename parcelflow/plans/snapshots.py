"""SCD2 snapshots of the staging attributes (Q9, Q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.scd2 import scd2_snapshot
from .gold import stg_courier_attributes, stg_merchant_attributes

COURIER_CHECK_COLS = ["sample_route_id"]
MERCHANT_CHECK_COLS = ["service_tier", "promised_window_start", "promised_window_end"]


def snap_courier_scd2(history: DataFrame | None, silver: DataFrame, run_ts,
                      invalidate_hard_deletes: bool = True) -> DataFrame:
    """Q9: courier versions, checked on ``sample_route_id``."""
    return scd2_snapshot(history, stg_courier_attributes(silver), "courier_id",
                         COURIER_CHECK_COLS, run_ts, invalidate_hard_deletes)


def snap_merchant_scd2(history: DataFrame | None, silver: DataFrame, run_ts,
                       invalidate_hard_deletes: bool = True) -> DataFrame:
    """Q10: merchant versions, checked on tier and both promise bounds."""
    return scd2_snapshot(history, stg_merchant_attributes(silver), "merchant_id",
                         MERCHANT_CHECK_COLS, run_ts, invalidate_hard_deletes)
