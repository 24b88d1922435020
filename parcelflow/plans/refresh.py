"""Late rows, by the set of parcels they touch.

High-water marks drop what comes late. Here a micro-batch of bronze rows, old or
new, says which parcels are dirty, and this set is carried through the layers:

* silver: the rows of dirty parcels meet the batch and are deduplicated anew
  (newest copy of an event, newest event per type), so an older row that comes
  late never replaces a newer one;
* facts: computed from silver's rows of dirty parcels and put in the place of
  all their rows, so a stay that a late scan breaks or closes is corrected;
* views by day: computed again for the days whose facts changed.

So a batch costs its parcels and their days, and any number of batches in any
order gives what a full refresh gives. Every step replaces whole groups or days
by what they have to be, so a batch repeated after a stop changes nothing more.

An event_id is taken to stay with its parcel (one that moves is corrected in
the parcel that has the newest copy only). Null parcel ids are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import dedup_latest
from ..session import scratch_path
from ..sources.tables import read_table, replace_days, replace_groups
from . import facts, gold
from .build import FACT_CLUSTER
from .silver import SILVER_COLUMNS, typed_columns

FACTS = ("fact_depot_visits", "fact_eta_events", "fact_parcel_deliveries", "fact_parcel_delivery_attempts")
#: Views by day: name -> (fact, function).
DAY_VIEWS = {"vw_depot_dwell_p95": ("fact_depot_visits", gold.vw_depot_dwell_p95)}


def refresh(spark: SparkSession, base: str, batch: DataFrame, as_of, days: int, fact_names=FACTS, keep_latest_per_type: bool = True) -> dict[str, list]:
    """Bring the tables below ``base`` up to date with one batch of bronze
    rows; returns the days each table was rewritten for."""
    work = scratch_path(spark, "refresh")
    typed_columns(batch).write.parquet(f"{work}/batch")
    rows = spark.read.parquet(f"{work}/batch")
    rows.select("parcel_id").distinct().write.parquet(f"{work}/dirty")
    dirty = spark.read.parquet(f"{work}/dirty")
    if not dirty.where("parcel_id is null").isEmpty():
        raise ValueError("refresh: NULL parcel_id")
    old = read_table(spark, f"{base}/silver_parcel_events")
    if old is not None:
        rows = old.join(dirty, "parcel_id", "left_semi").select(*SILVER_COLUMNS).unionByName(rows)
    rows = dedup_latest(rows, ["event_id"])
    if keep_latest_per_type:
        rows = dedup_latest(rows, ["parcel_id", "event_type"])
    rows.select(*SILVER_COLUMNS).write.parquet(f"{work}/silver")
    silver = spark.read.parquet(f"{work}/silver")
    touched = {"silver_parcel_events": replace_groups(spark, f"{base}/silver_parcel_events", dirty, silver, "parcel_id", cluster_by=["parcel_id", "event_type"])}
    for name in fact_names:
        fact = getattr(facts, name)(silver, as_of, days)
        touched[name] = replace_groups(spark, f"{base}/{name}", dirty, fact, "parcel_id", cluster_by=FACT_CLUSTER[name])
    for name, (fact, view) in DAY_VIEWS.items():
        if touched.get(fact):
            changed = read_table(spark, f"{base}/{fact}").where(F.col("event_date").isin(touched[fact]))
            replace_days(spark, f"{base}/{name}", touched[fact], view(changed))
            touched[name] = touched[fact]
    return touched


def start_refresh(bronze_stream: DataFrame, base: str, checkpoint: str, as_of, days: int, fact_names=FACTS, available_now: bool = True):
    """Each micro-batch of a bronze stream through :func:`refresh`."""
    spark = bronze_stream.sparkSession
    w = (bronze_stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, _: refresh(spark, base, batch, as_of, days, fact_names) and None))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()
