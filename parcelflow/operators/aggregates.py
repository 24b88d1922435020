"""Aggregations: seen-stats (A1-A3), deterministic ANY_VALUE (A4),
boolean roll-ups (A5), approximate p95 (A6), high-water max (A8), MAE (A9).

All are partial + final hash aggregates: each map task combines its rows
before the shuffle, so a key holding a third of the data costs one row per
map partition in the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accuracy of the quantile sketch; 10000 makes groups of up to ~10k values
# exact, larger groups have relative rank error <= 1/10000.
P95_ACCURACY = 10000


def any_value(c) -> Column:
    """A4: a deterministic ANY_VALUE (the minimum non-NULL value)."""
    return F.min(c)


def count_if(pred: Column) -> Column:
    """A2: COUNTIF as bigint."""
    return F.count_if(pred).cast("bigint")


def count_rows() -> Column:
    """A3: COUNT(*)."""
    return F.count(F.lit(1)).cast("bigint")


def flag_any(pred: Column) -> Column:
    """A5: MAX(CASE WHEN pred THEN 1 ELSE 0 END) as int."""
    return F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("int")


def p95(c, accuracy: int = P95_ACCURACY) -> Column:
    """Approximate 95th percentile (NULLs ignored, NULL for an empty
    group), the element at offset 95 of 100-quantiles."""
    return F.percentile_approx(c, 0.95, accuracy)


def mae(error) -> Column:
    """Mean absolute error of a signed error column."""
    return F.avg(F.abs(F.col(error) if isinstance(error, str) else error))


def seen_stats(df: DataFrame, key: str, ts: str = "event_ts", extra=()) -> DataFrame:
    """A1: per key first/last seen timestamps plus extra aggregates."""
    return (df.filter(F.col(key).isNotNull())
              .groupBy(key)
              .agg(F.min(ts).alias("first_seen_ts"), F.max(ts).alias("last_seen_ts"), *extra))


def high_water(df: DataFrame, c: str):
    """The global max of ``c`` as a Python value (one scalar per job,
    read once on the driver so the following filter is a literal and can
    prune partitions statically). Returns None for an empty table."""
    return df.agg(F.max(c).alias("m")).first()["m"]
