"""Adapter: the driver's generic ``events`` table -> bronze parcel events.

The driver tables hold no parcel data, so the adapter defines one parcel
per twelve consecutive events (FIXTURES.md §3):

* slot 0 PARCEL_CREATED, 1/2 and 3/4 two depot stays (IN, OUT), 5 LOADED_TO_VAN,
  6 OUT_FOR_DELIVERY, 7 ETA_SET, 8 ETA_UPDATED, 9 EXCEPTION, 10 and 11 delivery
  attempts (the second only for half of the parcels);
* every seventh event is delivered twice, the copy one second later
  (at-least-once redelivery).

It is a single scan with a per-row projection; the redelivered copy is
produced by ``explode`` of a one- or two-element array rather than a second
scan plus ``UNION ALL``, so the adapter is one narrow stage at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contracts import BRONZE_COLUMNS

# Fixed values of the fixture rule (FIXTURES.md §3).
SLOT_TYPES = [
    "PARCEL_CREATED", "SCAN_IN_DEPOT", "SCAN_OUT_DEPOT", "SCAN_IN_DEPOT", "SCAN_OUT_DEPOT",
    "LOADED_TO_VAN", "OUT_FOR_DELIVERY", "ETA_SET", "ETA_UPDATED", "EXCEPTION",
    "DELIVERED", "DELIVERED",
]
EXCEPTION_BY_PID_MOD5 = ["MISSORT", "ADDRESS_ISSUE", "DEPOT_CAPACITY", "VEHICLE_BREAKDOWN", "CUSTOMER_NOT_HOME"]


def _tag(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _mins(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("int"), ts)


def events_to_bronze(events: DataFrame) -> DataFrame:
    """Turn ``events(event_id, ts, ...)`` into the 36 bronze columns."""
    n = F.col("event_id")
    slot = n % 12
    base = (events
            .select(n.alias("n"), F.col("ts").cast("timestamp").alias("ts0"),
                    slot.alias("slot"), F.expr("(event_id - event_id % 12) div 12").alias("pid"))
            .filter(~((F.col("slot") == 11) & (F.col("pid") % 4 >= 2)))
            .withColumn("copy", F.explode(F.when(F.col("n") % 7 == 0, F.array(F.lit(0), F.lit(1)))
                                          .otherwise(F.array(F.lit(0)))))
            .withColumn("ts", F.timestamp_add("SECOND", F.col("copy"), F.col("ts0"))))

    n, ts, s, pid = F.col("n"), F.col("ts"), F.col("slot"), F.col("pid")

    def on(*slots):
        return s.isin(*slots) if len(slots) > 1 else (s == slots[0])

    etype = F.element_at(F.array(*[F.lit(t) for t in SLOT_TYPES]), (s + 1).cast("int"))
    tier = (F.when(pid % 10 < 6, "NEXT_DAY").when(pid % 10 < 9, "TWO_DAY").otherwise("ECONOMY"))
    exc = F.element_at(F.array(*[F.lit(t) for t in EXCEPTION_BY_PID_MOD5]), (pid % 5 + 1).cast("int"))
    first_outcome = F.when(pid % 4 == 0, "CARDED").when(pid % 4 == 1, "FAILED").otherwise("SUCCESS")
    cols = {
        "schema_version": F.lit("1.0.0"),
        "event_version": F.lit("1.0.0"),
        "event_id": _tag("e", n),
        "parcel_id": _tag("p", pid),
        "event_type": etype,
        "event_ts": ts,
        "producer": F.lit("fixture"),
        "sequence_no": s.cast("bigint"),
        "trace_id": F.lit(None).cast("string"),
        "merchant_id": F.when(on(0), _tag("m", pid % 40)),
        "origin_address_id": F.when(on(0), _tag("o", pid)),
        "destination_address_id": F.when(on(0), _tag("a", pid)),
        "service_tier": F.when(on(0), tier),
        "created_ts": F.when(on(0), F.timestamp_add("MINUTE", F.lit(-2), ts)),
        "promised_window_start": F.when(on(0), F.timestamp_add("MINUTE", F.lit(5), ts)),
        "promised_window_end": F.when(on(0), _mins(ts, 5 + pid % 90)),
        "weight_grams": F.when(on(0), (100 + n % 5000).cast("bigint")),
        "volume_cm3": F.when(on(0), (500 + n % 9000).cast("bigint")),
        "depot_id": F.when(on(1, 2), _tag("d", pid % 10)).when(on(3, 4), _tag("d", (pid + 3) % 10)),
        "scanner_id": F.when(on(1, 2, 3, 4), _tag("s", n % 99)),
        "area_code": F.when(on(1, 3), "INBOUND-A").when(on(2, 4), "OUTBOUND-B"),
        "belt_no": F.when(on(1, 2, 3, 4), (1 + n % 5).cast("bigint")),
        "route_id": F.when(on(5, 6, 7, 8, 10, 11), _tag("r", pid % 60)),
        "courier_id": F.when(on(5, 10, 11), _tag("c", pid % 30)),
        "planned_stop_seq": F.when(on(5), (1 + n % 200).cast("bigint")),
        "exception_code": F.when(on(9), exc),
        "stage_hint": F.when(on(9), F.when(pid % 2 == 0, "DEPOT").otherwise("LAST_MILE")),
        "details": F.lit(None).cast("string"),
        "first_planned_eta_ts": F.when(on(6), _mins(ts, 15 + n % 120)),
        "predicted_delivery_ts": F.when(on(7, 8), _mins(ts, 10 + n % 90)),
        "generated_ts": F.when(on(7, 8), ts),
        "source": F.when(on(7), "PLANNER").when(on(8), "RECOMPUTE"),
        "delivered_ts": F.when(on(10, 11), ts),
        "attempt_number": F.when(on(10), F.lit(1).cast("bigint")).when(on(11), F.lit(2).cast("bigint")),
        "outcome": F.when(on(10), first_outcome).when(on(11), "SUCCESS"),
        "failure_reason": F.when(on(10) & (pid % 4 == 1), "ADDRESS_ISSUE"),
    }
    return base.select(*[cols[c].alias(c) for c in BRONZE_COLUMNS])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze parcel events derived from ``{sf_dir}/events.parquet``."""
    return events_to_bronze(read_table(spark, sf_dir, "events"))


# The same rule as portable SQL (runs unchanged in Spark and DuckDB); the
# oracle queries use it as their bronze CTE.
BRONZE_SQL = """
WITH e AS (
  SELECT event_id AS n, CAST(ts AS TIMESTAMP) AS ts, event_id % 12 AS slot,
         CAST((event_id - event_id % 12) / 12 AS BIGINT) AS pid
  FROM events
), once AS (
  SELECT * FROM e WHERE NOT (slot = 11 AND pid % 4 >= 2)
), d AS (
  SELECT n, ts, slot, pid FROM once
  UNION ALL
  SELECT n, ts + INTERVAL '1' SECOND, slot, pid FROM once WHERE n % 7 = 0
)
SELECT
  '1.0.0' AS schema_version, '1.0.0' AS event_version,
  concat('e', CAST(n AS STRING)) AS event_id,
  concat('p', CAST(pid AS STRING)) AS parcel_id,
  CASE slot WHEN 0 THEN 'PARCEL_CREATED' WHEN 1 THEN 'SCAN_IN_DEPOT' WHEN 2 THEN 'SCAN_OUT_DEPOT'
    WHEN 3 THEN 'SCAN_IN_DEPOT' WHEN 4 THEN 'SCAN_OUT_DEPOT' WHEN 5 THEN 'LOADED_TO_VAN'
    WHEN 6 THEN 'OUT_FOR_DELIVERY' WHEN 7 THEN 'ETA_SET' WHEN 8 THEN 'ETA_UPDATED'
    WHEN 9 THEN 'EXCEPTION' ELSE 'DELIVERED' END AS event_type,
  ts AS event_ts, 'fixture' AS producer, CAST(slot AS BIGINT) AS sequence_no, CAST(NULL AS STRING) AS trace_id,
  CASE WHEN slot = 0 THEN concat('m', CAST(pid % 40 AS STRING)) END AS merchant_id,
  CASE WHEN slot = 0 THEN concat('o', CAST(pid AS STRING)) END AS origin_address_id,
  CASE WHEN slot = 0 THEN concat('a', CAST(pid AS STRING)) END AS destination_address_id,
  CASE WHEN slot = 0 THEN CASE WHEN pid % 10 < 6 THEN 'NEXT_DAY' WHEN pid % 10 < 9 THEN 'TWO_DAY' ELSE 'ECONOMY' END END AS service_tier,
  CASE WHEN slot = 0 THEN ts - INTERVAL '2' MINUTE END AS created_ts,
  CASE WHEN slot = 0 THEN ts + INTERVAL '5' MINUTE END AS promised_window_start,
  CASE WHEN slot = 0 THEN ts + INTERVAL '1' MINUTE * CAST(5 + pid % 90 AS INT) END AS promised_window_end,
  CASE WHEN slot = 0 THEN CAST(100 + n % 5000 AS BIGINT) END AS weight_grams,
  CASE WHEN slot = 0 THEN CAST(500 + n % 9000 AS BIGINT) END AS volume_cm3,
  CASE WHEN slot IN (1, 2) THEN concat('d', CAST(pid % 10 AS STRING))
       WHEN slot IN (3, 4) THEN concat('d', CAST((pid + 3) % 10 AS STRING)) END AS depot_id,
  CASE WHEN slot IN (1, 2, 3, 4) THEN concat('s', CAST(n % 99 AS STRING)) END AS scanner_id,
  CASE WHEN slot IN (1, 3) THEN 'INBOUND-A' WHEN slot IN (2, 4) THEN 'OUTBOUND-B' END AS area_code,
  CASE WHEN slot IN (1, 2, 3, 4) THEN CAST(1 + n % 5 AS BIGINT) END AS belt_no,
  CASE WHEN slot IN (5, 6, 7, 8, 10, 11) THEN concat('r', CAST(pid % 60 AS STRING)) END AS route_id,
  CASE WHEN slot IN (5, 10, 11) THEN concat('c', CAST(pid % 30 AS STRING)) END AS courier_id,
  CASE WHEN slot = 5 THEN CAST(1 + n % 200 AS BIGINT) END AS planned_stop_seq,
  CASE WHEN slot = 9 THEN CASE pid % 5 WHEN 0 THEN 'MISSORT' WHEN 1 THEN 'ADDRESS_ISSUE' WHEN 2 THEN 'DEPOT_CAPACITY'
    WHEN 3 THEN 'VEHICLE_BREAKDOWN' ELSE 'CUSTOMER_NOT_HOME' END END AS exception_code,
  CASE WHEN slot = 9 THEN CASE pid % 2 WHEN 0 THEN 'DEPOT' ELSE 'LAST_MILE' END END AS stage_hint,
  CAST(NULL AS STRING) AS details,
  CASE WHEN slot = 6 THEN ts + INTERVAL '1' MINUTE * CAST(15 + n % 120 AS INT) END AS first_planned_eta_ts,
  CASE WHEN slot IN (7, 8) THEN ts + INTERVAL '1' MINUTE * CAST(10 + n % 90 AS INT) END AS predicted_delivery_ts,
  CASE WHEN slot IN (7, 8) THEN ts END AS generated_ts,
  CASE WHEN slot = 7 THEN 'PLANNER' WHEN slot = 8 THEN 'RECOMPUTE' END AS source,
  CASE WHEN slot IN (10, 11) THEN ts END AS delivered_ts,
  CASE WHEN slot = 10 THEN CAST(1 AS BIGINT) WHEN slot = 11 THEN CAST(2 AS BIGINT) END AS attempt_number,
  CASE WHEN slot = 10 THEN CASE pid % 4 WHEN 0 THEN 'CARDED' WHEN 1 THEN 'FAILED' ELSE 'SUCCESS' END
       WHEN slot = 11 THEN 'SUCCESS' END AS outcome,
  CASE WHEN slot = 10 AND pid % 4 = 1 THEN 'ADDRESS_ISSUE' END AS failure_reason
FROM d
"""
