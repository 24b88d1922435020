"""Slowly changing dimension type 2.

``check`` strategy: a new key opens a row; a change in any checked column
(NULL-safe) closes the open row and opens a new one; an unchanged key does
nothing (unchecked columns such as ``last_seen_ts`` are not refreshed); a
key that left the source is closed when ``invalidate_hard_deletes``; a key
that comes back after a delete opens a new row.

Closed history rows never take part in the join. The open rows and the
source meet in one full outer join on the key (both sides shuffled on the
key, no broadcast); every joined row then emits its (possibly closed) old
version and/or its new version through one ``inline`` of a two-element
array, so there is no second join and no union of two scans of the join.
``valid_from`` of a new version equals ``valid_to`` of the version it
replaces: both are the run timestamp, passed in as a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def current_rows(history: DataFrame) -> DataFrame:
    """D3: open rows only."""
    return history.filter(F.col(VALID_TO).isNull())


def _changed(check_cols, h: str = "h", s: str = "s") -> Column:
    same = None
    for c in check_cols:
        e = F.col(f"{h}.{c}").eqNullSafe(F.col(f"{s}.{c}"))
        same = e if same is None else same & e
    return ~same


def scd2_diff(current: DataFrame, source: DataFrame, key: str, check_cols) -> DataFrame:
    """Classify keys as new, changed, unchanged or deleted."""
    j = current.alias("h").join(source.alias("s"), F.col(f"h.{key}") == F.col(f"s.{key}"), "full_outer")
    status = (F.when(F.col(f"h.{key}").isNull(), "new")
              .when(F.col(f"s.{key}").isNull(), "deleted")
              .when(_changed(check_cols), "changed")
              .otherwise("unchanged"))
    return j.select(F.coalesce(F.col(f"h.{key}"), F.col(f"s.{key}")).alias(key), status.alias("change"))


def scd2_snapshot(history: DataFrame | None, source: DataFrame, key: str, check_cols,
                  run_ts, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The snapshot table after one run over ``source`` at ``run_ts``.

    ``history`` is the previous snapshot (None on the first run); ``source``
    must be unique on ``key``. Output columns: the source columns, then
    ``dbt_valid_from``, ``dbt_valid_to``.
    """
    run = F.lit(run_ts).cast("timestamp")
    cols = source.columns
    if history is None:
        return source.select(*cols, run.alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO))

    closed = history.filter(F.col(VALID_TO).isNotNull()).select(*cols, VALID_FROM, VALID_TO)
    open_ = current_rows(history).select(*cols, VALID_FROM, VALID_TO)

    j = open_.alias("h").join(source.alias("s"), F.col(f"h.{key}") == F.col(f"s.{key}"), "full_outer")
    h_present = F.col(f"h.{key}").isNotNull()
    s_present = F.col(f"s.{key}").isNotNull()
    changed = h_present & s_present & _changed(check_cols)
    close_old = changed | (h_present & ~s_present & F.lit(bool(invalidate_hard_deletes)))
    open_new = s_present & (~h_present | changed)

    old_version = F.when(h_present, F.struct(
        *[F.col(f"h.{c}").alias(c) for c in cols],
        F.col(f"h.{VALID_FROM}").alias(VALID_FROM),
        F.when(close_old, run).otherwise(F.col(f"h.{VALID_TO}")).alias(VALID_TO)))
    new_version = F.when(open_new, F.struct(
        *[F.col(f"s.{c}").alias(c) for c in cols],
        run.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO)))
    versions = j.select(F.inline(F.filter(F.array(old_version, new_version), lambda v: v.isNotNull())))
    return closed.unionByName(versions)
