"""Window operators: keep-newest dedup (W1-W4) and consecutive-event
pairing (W5).

``dedup_latest`` is ``row_number() = 1`` over a keyed window. Catalyst plans
it as a partial ``WindowGroupLimit`` before the shuffle and a final one
after, so a hot key is cut to one row per map partition before it is
exchanged; no group is ever collected into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Deterministic tie-breakers (the reference orders by event_ts alone, which
# leaves ties to chance): newest event_ts, then highest sequence_no, then
# highest event_id.
DEFAULT_ORDER = ("event_ts", "sequence_no", "event_id")


def newest_first(cols=DEFAULT_ORDER) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def dedup_latest(df: DataFrame, keys, order=DEFAULT_ORDER) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (default newest)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [c for c in order if not isinstance(c, str) or c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*newest_first(order))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def pair_events(df: DataFrame, keys, ts: str = "event_ts", type_col: str = "event_type",
                start: str = "SCAN_IN_DEPOT", stop: str = "SCAN_OUT_DEPOT",
                tie_breakers=("sequence_no", "event_id"), bucket_seconds: int | None = 3600) -> DataFrame:
    """Pair each ``start`` event with the *next* event of the same keys
    when that event is a ``stop``. Adds ``next_ts``.

    Looks exactly one row ahead (IN, IN, OUT pairs the second IN only), as
    the depot-visit model does.

    Skew: with ``bucket_seconds`` the rows of a group are split into time
    buckets and LEAD runs per (keys, bucket), so even a group holding a
    third of all rows is spread over as many tasks as it spans buckets. The
    last row of a bucket takes the first row of the group's next non-empty
    bucket, from a small per-bucket table (one row per non-empty bucket,
    ``min_by`` then LEAD over buckets) joined back on (keys, bucket). The
    result equals a single LEAD over the whole group. ``bucket_seconds=None``
    runs that single LEAD (one window per group).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ties = [c for c in tie_breakers if c in df.columns]
    order = [F.col(ts).asc()] + [F.col(c).asc() for c in ties]
    if bucket_seconds is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return (df.withColumn("next_ts", F.lead(ts, 1).over(w))
                  .withColumn("__next_type", F.lead(type_col, 1).over(w))
                  .filter((F.col(type_col) == start) & (F.col("__next_type") == stop)
                          & F.col("next_ts").isNotNull())
                  .drop("__next_type"))

    b = df.withColumn("__b", F.floor(F.unix_micros(ts) / (int(bucket_seconds) * 1_000_000)))
    wb = Window.partitionBy(*keys, "__b").orderBy(*order)
    inb = (b.withColumn("__nts", F.lead(ts, 1).over(wb))
            .withColumn("__ntype", F.lead(type_col, 1).over(wb)))
    # First row of every non-empty bucket, then the next bucket's first row.
    first = (b.groupBy(*keys, "__b")
              .agg(F.min_by(F.struct(F.col(ts).alias("t"), F.col(type_col).alias("y")),
                            F.struct(F.col(ts), *[F.col(c) for c in ties])).alias("__f")))
    wn = Window.partitionBy(*keys).orderBy("__b")
    nxt = first.select(*keys, "__b", F.lead("__f", 1).over(wn).alias("__nf"))
    j = inb.join(nxt, [*keys, "__b"], "left")
    next_ts = F.coalesce(F.col("__nts"), F.col("__nf")["t"])
    next_type = F.when(F.col("__nts").isNotNull(), F.col("__ntype")).otherwise(F.col("__nf")["y"])
    return (j.withColumn("next_ts", next_ts).withColumn("__next_type", next_type)
             .filter((F.col(type_col) == start) & (F.col("__next_type") == stop) & F.col("next_ts").isNotNull())
             .drop("__b", "__nts", "__ntype", "__nf", "__next_type"))
