"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` (the parcel models read
``events`` through the fixtures adapter) over the whole table: the model
lookback is 30 days back from 2024-01-31, which covers all of ``events``.
Stateful entries (incremental builds, SCD2 runs, streaming) write their
intermediate tables under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .functions.contracts import BRONZE_COLUMNS
from .functions.validate import infer_extras, split_valid, validate, with_variant
from .operators.repair import inject_context, parcel_context, repair_event_time
from .plans import build, facts, gold, refresh, silver, snapshots
from .session import configure, scratch_path
from .sources.fixtures import bronze_from_dir
from .sources.bronze import read_cold
from .sources.messages import bronze_to_messages
from .functions.contracts import bronze_schema
from .streaming import ingest as streaming
from .streaming import redelivery, reorder
from .operators.quality import Check, freshness, run_suite
from .plans import kpi, suite
from .sources import bronze as bronze_io
from .sources import history, published, schema_log
from .sources import tables as stored_tables
from .sources.fixtures import read_table
from .session import shared_dir

AS_OF = "2024-01-31"
DAYS = 30
# SCD2 fixture: one snapshot over events up to 2024-01-15, then one over all.
SNAP1_AS_OF, SNAP1_RUN_TS = "2024-01-15", "2024-01-16 00:00:00"
SNAP2_AS_OF, SNAP2_RUN_TS = AS_OF, "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str, as_of=AS_OF, days=DAYS, **kw) -> DataFrame:
    configure(spark)
    return silver.silver_parcel_events(bronze_from_dir(spark, sf_dir), as_of, days, **kw)


def q01(spark, d):
    return _silver(spark, d)


def q02(spark, d):
    return silver.silver_parcel_latest(_silver(spark, d))


def q03(spark, d):
    return facts.fact_depot_visits(_silver(spark, d), AS_OF, DAYS)


def q04(spark, d):
    return facts.fact_eta_events(_silver(spark, d), AS_OF, DAYS)


def q05(spark, d):
    return facts.fact_parcel_deliveries(_silver(spark, d), AS_OF, DAYS)


def q06(spark, d):
    return facts.fact_parcel_delivery_attempts(_silver(spark, d), AS_OF, DAYS)


def q07(spark, d):
    return gold.stg_courier_attributes(_silver(spark, d))


def q08(spark, d):
    return gold.stg_merchant_attributes(_silver(spark, d))


def _two_snapshots(spark, d, snap):
    first = snap(None, _silver(spark, d, SNAP1_AS_OF), SNAP1_RUN_TS)
    return snap(first, _silver(spark, d, SNAP2_AS_OF), SNAP2_RUN_TS)


def q09(spark, d):
    return _two_snapshots(spark, d, snapshots.snap_courier_scd2)


def q10(spark, d):
    return _two_snapshots(spark, d, snapshots.snap_merchant_scd2)


def q11(spark, d):
    return gold.dim_courier(q09(spark, d))


def q12(spark, d):
    return gold.dim_merchant(q10(spark, d))


def q13(spark, d):
    return gold.dim_depot(_silver(spark, d))


def q14(spark, d):
    return gold.dim_route(_silver(spark, d))


def q15(spark, d):
    return gold.dim_exception_code(_silver(spark, d))


def q16(spark, d):
    return gold.dim_service_tier(_silver(spark, d))


def q17(spark, d):
    return gold.vw_depot_dwell_p95(q03(spark, d))


def q18(spark, d):
    return gold.vw_eta_error_p95(q04(spark, d))


def q19(spark, d):
    return gold.vw_first_attempt_success(q06(spark, d))


INC1_AS_OF = "2024-01-15"


def _incremental_silver(spark, d, name):
    """Two silver batches (as_of 2024-01-15, then 2024-01-31) merged by
    event_id into a fresh table under the shared folder."""
    configure(spark)
    base = scratch_path(spark, name)
    bronze = bronze_from_dir(spark, d)
    for as_of in (INC1_AS_OF, AS_OF):
        build.run_silver_events(spark, bronze, f"{base}/silver_parcel_events", as_of, DAYS)
    return base


def j2_silver_events(spark, d):
    base = _incremental_silver(spark, d, "j2_silver_events")
    return spark.read.parquet(f"{base}/silver_parcel_events")


def j2_silver_latest(spark, d):
    configure(spark)
    base = scratch_path(spark, "j2_silver_latest")
    bronze = bronze_from_dir(spark, d)
    for as_of in (INC1_AS_OF, AS_OF):
        build.run_silver_events(spark, bronze, f"{base}/silver_parcel_events", as_of, DAYS)
        build.run_silver_latest(spark, f"{base}/silver_parcel_events", f"{base}/silver_parcel_latest")
    return spark.read.parquet(f"{base}/silver_parcel_latest")


def _incremental_fact(name):
    """Two batches of silver and of one fact, merged by the fact's key (T5)."""
    def run(spark, d):
        configure(spark)
        base = scratch_path(spark, f"j2_{name}")
        bronze = bronze_from_dir(spark, d)
        for as_of in (INC1_AS_OF, AS_OF):
            build.run_silver_events(spark, bronze, f"{base}/silver_parcel_events", as_of, DAYS)
            build.run_fact(spark, name, f"{base}/silver_parcel_events", f"{base}/{name}", as_of, DAYS)
        return spark.read.parquet(f"{base}/{name}")

    return run


def j2_indexed_merge(spark, d):
    """J2 with the key index: three batches of ten days, merged by event_id. The
    second and the third bring events of earlier batches again, ten days later,
    so their old rows are found on days the batch does not have."""
    configure(spark)
    path = scratch_path(spark, "j2_indexed_merge")
    cols = ["event_id", "parcel_id", "event_type", "event_ts", "sequence_no"]
    b = bronze_from_dir(spark, d).select(*cols)
    turn = F.when(F.dayofmonth("event_ts") <= 10, 0).when(F.dayofmonth("event_ts") <= 20, 1).otherwise(2)
    n = F.regexp_extract("event_id", r"(\d+)$", 1).cast("long")
    for k in range(3):
        again = (b.where((turn < k) & (n % 97 == k)).withColumn("event_ts", F.expr("event_ts + INTERVAL '10' DAY")).withColumn("sequence_no", F.col("sequence_no") + 100))
        batch = b.where(turn == k).unionByName(again).withColumn("event_date", F.to_date("event_ts"))
        stored_tables.upsert(spark, path, batch, "event_id", key_index=True)
    return spark.read.parquet(path)


# The models that the reference keeps as tables, and its views over published tables.
TABLE_MODELS = {"dim_depot": gold.dim_depot, "dim_route": gold.dim_route, "dim_exception_code": gold.dim_exception_code, "dim_service_tier": gold.dim_service_tier}
VIEW_MODELS = {"vw_depot_dwell_p95": lambda s: gold.vw_depot_dwell_p95(s.read("fact_depot_visits"))}


def _publish_models(spark, d, base, as_of):
    s = _silver(spark, d, as_of)
    published.publish(spark, base, {**{name: model(s) for name, model in TABLE_MODELS.items()}, "fact_depot_visits": facts.fact_depot_visits(s, as_of, DAYS)},
                      partition_by={"fact_depot_visits": "event_date"})


def s11_published_versions(spark, d):
    """Dimensions published twice (events up to 2024-01-15, then all); one
    reader opened before the second run and one after it, both reading after it."""
    base = scratch_path(spark, "s11_published_versions")
    readers = []
    for as_of in (INC1_AS_OF, AS_OF):
        _publish_models(spark, d, base, as_of)
        readers.append(published.snapshot(spark, base))
    rows = [r.read("dim_depot").select(F.lit(as_of).alias("as_of"), "depot_id", "last_seen_ts", "scan_in_count", "scan_out_count")
            for r, as_of in zip(readers, (INC1_AS_OF, AS_OF))]
    return rows[0].unionByName(rows[1])


def s11_published_view(spark, d):
    """The depot dwell view over the published facts, read by SQL."""
    base = scratch_path(spark, "s11_published_view")
    _publish_models(spark, d, base, AS_OF)
    prefix = f"s11_{base.rstrip('/').rsplit('/', 1)[1].replace('-', '_')}_"
    published.register_views(published.snapshot(spark, base), VIEW_MODELS, prefix)
    return spark.sql(f"SELECT event_date, depot_id, depot_dwell_p95_min FROM `{prefix}vw_depot_dwell_p95`")


# -- contracts and producer rules ----------------------------------------------

def _messages(spark, d):
    """Raw messages derived from ``events``, landed once as a table in the
    shared folder (as a producer's messages would arrive), then read back."""
    configure(spark)
    path = scratch_path(spark, "messages")
    bronze_to_messages(bronze_from_dir(spark, d)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _rules_text(violations_col):
    return F.array_join(F.array_sort(F.transform(
        violations_col, lambda x: F.concat(x["path"], F.lit(":"), x["rule"]))), ",")


def c4_contract_validation(spark, d):
    """C3-C5, C4g, S3: every message validated; sorted ``path:rule`` list."""
    v = validate(_messages(spark, d))
    return v.select("msg_id", "cls", "is_valid", _rules_text(F.col("violations")).alias("rules"))


def c1_conform_bronze(spark, d):
    """Accepted messages typed into the wide bronze row."""
    m = _messages(spark, d)
    good, _ = split_valid(m, keep=("msg_id",))
    return good.select("msg_id", *BRONZE_COLUMNS)


def s6_quarantine_by_rule(spark, d):
    """Rejected messages, counted per violated (path, rule)."""
    _, rejected = split_valid(_messages(spark, d), keep=("msg_id",))
    return (rejected.select(F.inline("violations"))
            .groupBy("path", "rule").agg(F.count(F.lit(1)).alias("n")))


def c8_infer_extras(spark, d):
    """Types of producer fields outside every contract."""
    return infer_extras(with_variant(_messages(spark, d)))


def c8_extra_kinds(spark, d):
    """Extra fields of every kind, and of kinds that differ between the
    messages, typed for both layers."""
    configure(spark)
    n = F.regexp_extract("event_id", r"(\d+)$", 1).cast("long")
    raw = F.expr("""concat('{"event_id":"', event_id, '","x_flag":', if(n % 2 = 0, 'true', 'false'), ',"x_int":', n, ',"x_float":', n, '.25,"x_seen_ts":"2024-01-01T00:00:00Z"',
        ',"x_text":"t"', ',"x_number":', n, if(n % 3 = 0, '.5', ''), ',"x_any":', if(n % 4 = 0, '1', '"one"'), ',"x_maybe":', if(n % 5 = 0, 'null', '7'),
        ',"x_none":null,"x_list":[1],"x_late_ts":', if(n % 2 = 0, '5', '"2024-01-01"'), if(n % 7 = 0, ',"x_rare":true', ''), '}')""")
    m = with_variant(bronze_from_dir(spark, d).withColumn("n", n).select(raw.alias("raw")))
    each = [infer_extras(m, layer).select(F.lit(layer).alias("layer"), "key", "type", "n") for layer in ("hot", "cold")]
    return each[0].unionByName(each[1])


def c10_inject_context(spark, d):
    """Parcel context copied into events that allow but lack it."""
    configure(spark)
    b = bronze_from_dir(spark, d)
    out = inject_context(b, parcel_context(b))
    return out.select("event_id", "event_ts", "event_type", "route_id", "courier_id", "depot_id", "merchant_id")


def c11_repair_event_time(spark, d):
    """C11: event times of scan-out (seq 2) and ETA update (seq 8) moved 30
    minutes back, then repaired to be non-decreasing per parcel."""
    configure(spark)
    b = bronze_from_dir(spark, d).select("parcel_id", "event_id", "sequence_no", "event_ts")
    moved = F.when(F.col("sequence_no").isin(2, 8),
                   F.timestamp_add("MINUTE", F.lit(-30), F.col("event_ts"))).otherwise(F.col("event_ts"))
    p = b.withColumn("event_ts", moved).withColumn("orig_ts", F.col("event_ts"))
    return repair_event_time(p).select("parcel_id", "event_id", "sequence_no", "orig_ts", "event_ts")


# -- streaming ------------------------------------------------------------------

def _message_files(spark, d, base, n_files: int = 4) -> str:
    """Messages derived from ``events`` landed as JSON-lines text files."""
    src = f"{base}/source"
    (bronze_to_messages(bronze_from_dir(spark, d)).select("raw")
        .repartition(n_files).write.mode("overwrite").text(src))
    return src


def r1_stream_ingest(spark, d):
    """Validated streaming ingest into bronze, one
    file per micro-batch, drained with availableNow."""
    configure(spark)
    base = scratch_path(spark, "r1_ingest")
    src = _message_files(spark, d, base)
    stream = streaming.read_event_stream(spark, src, max_files_per_trigger=1)
    q = streaming.start_ingest(stream, f"{base}/bronze", f"{base}/quarantine", f"{base}/_chk/hot")
    streaming.drain(q)
    return spark.read.parquet(f"{base}/bronze").select(*BRONZE_COLUMNS)


def s6_dead_letter(spark, d):
    """Rejected messages delivered again by a second streaming query, run
    five times from its checkpoint. Class 16 carries an ``event_ts`` that no
    warehouse can type. The contract that allows ``extra_note`` is deployed
    before the third delivery; what fails five times is set aside."""
    configure(spark)
    base = scratch_path(spark, "s6_redelivery")
    m = bronze_to_messages(bronze_from_dir(spark, d))
    untypable = F.regexp_replace("raw", '"event_ts":"[^"]*"', '"event_ts":"hello"')
    m.select(F.when(F.col("cls") == 16, untypable).otherwise(F.col("raw")).alias("raw")).write.text(f"{base}/source")
    q = streaming.start_ingest(streaming.read_event_stream(spark, f"{base}/source"), f"{base}/hot/bronze", f"{base}/hot/quarantine",
                               f"{base}/_chk/hot", nack_path=f"{base}/nack")
    streaming.drain(q)
    start = 1_706_745_600
    for seconds in (0, 10, 30, 70, 150):
        redelivery.start_redelivery(spark, f"{base}/nack", f"{base}/again", f"{base}/_chk/again", now=F.timestamp_seconds(F.lit(start + seconds)),
                                    also_allowed=["extra_note"] if seconds >= 30 else []).awaitTermination()
    dead = redelivery.read_dead_letters(spark, f"{base}/again")
    dead = dead.select(F.lit("dead").alias("outcome"), "attempts", F.array_join("reasons", ",").alias("rules"), "copies")
    passed = redelivery.read_log(spark, f"{base}/again").where("outcome = 'delivered'").select("outcome", "attempts", F.lit("").alias("rules"), "copies")
    return dead.unionByName(passed).groupBy("outcome", "attempts", "rules").agg(F.sum("copies").alias("messages"))


def r3_stream_archive(spark, d):
    """The independent cold consumer of the same messages, read back
    from the archive layout."""
    configure(spark)
    base = scratch_path(spark, "r3_archive")
    src = _message_files(spark, d, base)
    stream = streaming.read_event_stream(spark, src, max_files_per_trigger=1)
    streaming.drain(streaming.start_archive(stream, f"{base}/archive", f"{base}/_chk/cold"))
    return read_cold(spark, f"{base}/archive").select(*BRONZE_COLUMNS)


def c12_ingest_counts(spark, d):
    """Messages accepted and rejected by the hot and the cold consumer
    of one source, the hot one stopped after two files and then run to its end."""
    configure(spark)
    base = scratch_path(spark, "c12_counts")
    src = _message_files(spark, d, base)
    read = lambda: streaming.read_event_stream(spark, src, max_files_per_trigger=1)
    for limit in (1, None):
        streaming.drain(streaming.start_ingest(read(), f"{base}/bronze", f"{base}/quarantine", f"{base}/_chk/hot"), max_messages=limit)
    streaming.drain(streaming.start_archive(read(), f"{base}/archive", f"{base}/_chk/cold"))
    each = [streaming.ingest_counts(spark, p).agg(F.lit(name).alias("consumer"), F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"), F.count("*").alias("batches"))
            for name, p in (("hot", f"{base}/quarantine"), ("cold", f"{base}/archive"))]
    return each[0].unionByName(each[1])


def _weeks(spark, d) -> list:
    """Bronze rows of each week of January, in time order."""
    b = bronze_from_dir(spark, d).withColumn("__wk", F.floor((F.dayofmonth("event_ts") - 1) / 7))
    return [b.filter(F.col("__wk") == wk).drop("__wk") for wk in range(5)]


def _replay(spark, src, arrivals, start) -> None:
    """Land each DataFrame in turn and let the query that ``start(stream)`` starts
    (again, from its checkpoint) take it as one micro-batch, however many files
    it is: they are written and read by all tasks."""
    for rows in arrivals:
        rows.write.mode("append").parquet(src)
        start(spark.readStream.schema(bronze_schema("hot")).parquet(src)).awaitTermination()


def r6_stream_silver(spark, d):
    """Silver built incrementally from a bronze stream (one week per
    micro-batch), merged by event_id."""
    configure(spark)
    base = scratch_path(spark, "r6_silver")
    _replay(spark, f"{base}/bronze_src", _weeks(spark, d), lambda stream: streaming.start_silver(stream, f"{base}/silver", f"{base}/_chk/silver", AS_OF, DAYS))
    return spark.read.parquet(f"{base}/silver")


def _late_tables(spark, d, name) -> str:
    """Bronze rows arriving in three batches by hash, so late by up to a month."""
    configure(spark)
    base = scratch_path(spark, name)
    b = bronze_from_dir(spark, d)
    turn = F.pmod(F.crc32(F.concat("event_id", F.col("event_ts").cast("string")).cast("binary")), F.lit(3))
    b.withColumn("_turn", turn).write.partitionBy("_turn").parquet(f"{base}/arrivals")
    arrivals = spark.read.parquet(f"{base}/arrivals")
    _replay(spark, f"{base}/source", [arrivals.where(F.col("_turn") == n).drop("_turn") for n in range(3)],
            lambda stream: refresh.start_refresh(stream, base, f"{base}/_chk", AS_OF, DAYS, ("fact_depot_visits",)))
    return base


def r6_late_rows(spark, d):
    """Silver after late rows in three batches equals a full refresh."""
    return spark.read.parquet(f"{_late_tables(spark, d, 'r6_late')}/silver_parcel_events")


def t5_late_depot_dwell(spark, d):
    """T5: the depot view by day after late rows in three batches equals a full refresh."""
    return spark.read.parquet(f"{_late_tables(spark, d, 't5_late')}/vw_depot_dwell_p95").select("event_date", "depot_id", "depot_dwell_p95_min")


def r7_stream_dedup(spark, d):
    """Redelivered copies removed in the stream (watermark 1 day)."""
    configure(spark)
    base = scratch_path(spark, "r7_dedup")
    _replay(spark, f"{base}/bronze_src", _weeks(spark, d), lambda stream: (
        streaming.dedup_stream(stream, "1 day").select("event_id", "parcel_id", "event_type", "event_ts")
        .writeStream.format("parquet").option("checkpointLocation", f"{base}/_chk/dedup")
        .outputMode("append").trigger(availableNow=True).start(f"{base}/dedup")))
    return spark.read.parquet(f"{base}/dedup").select("event_id", "parcel_id", "event_type")


def r4_ordered(spark, d):
    """Events arrive up to six days late, out of order and twice, in weekly
    batches, and every third parcel lacks its sixth event; the reorder buffer
    gives each event once, in order, with its position in the parcel."""
    configure(spark)
    base = scratch_path(spark, "r4_ordered")
    b = bronze_from_dir(spark, d).select("parcel_id", "sequence_no", "event_id", "event_type", "event_ts")
    pid = F.regexp_extract("parcel_id", r"(\d+)$", 1).cast("long")
    b = b.where(~((F.col("sequence_no") == 5) & (pid % 3 == 0)))
    late = F.timestamp_add("DAY", F.pmod(F.crc32(F.col("event_id").cast("binary")), F.lit(7)).cast("int"), F.col("event_ts"))
    b = b.withColumn("_batch", F.floor(F.datediff(late, F.lit("2024-01-01").cast("date")) / 7))
    b.write.partitionBy("_batch").parquet(f"{base}/arrivals")
    rows = spark.read.parquet(f"{base}/arrivals")
    # As many files a week as the cluster writes at once, and as many a micro-batch: the batches don't become more with the rows.
    files = max(4, spark.sparkContext.defaultParallelism)
    for n in sorted(r[0] for r in rows.select("_batch").distinct().collect()):      # weeks of the calendar
        rows.where(F.col("_batch") == n).drop("_batch").repartition(files).write.mode("append").parquet(f"{base}/source")
    # A clock's tick long after the last event lets the watermark close what is left.
    tick = rows.agg(F.lit("clock").alias("parcel_id"), F.lit(0).cast("long").alias("sequence_no"), F.lit("c0").alias("event_id"), F.lit("TICK").alias("event_type"),
                    F.timestamp_add("DAY", F.lit(60), F.max("event_ts")).alias("event_ts"))
    tick.write.mode("append").parquet(f"{base}/source")
    stream = spark.readStream.schema(rows.drop("_batch").schema).option("maxFilesPerTrigger", files).parquet(f"{base}/source")
    reorder.start_ordered(spark, stream, f"{base}/ordered", f"{base}/_chk", "14 days", partitions=files).awaitTermination()
    return spark.read.parquet(f"{base}/ordered").where("parcel_id <> 'clock'").select("parcel_id", "position", "sequence_no", "event_id")


# -- schemas and history that grow ------------------------------------------------

def c7_evolve(spark, d):
    """The second half of the month brings two new fields and sequence
    numbers as text, some of them no numbers; merged by event_id into the table
    of the first half. Refused rows are told by ``refused``."""
    configure(spark)
    base = scratch_path(spark, "c7_evolve")
    b = bronze_from_dir(spark, d).select("event_id", "parcel_id", "event_type", "event_ts", "sequence_no").withColumn("event_date", F.to_date("event_ts"))
    n = F.regexp_extract("event_id", r"(\d+)$", 1).cast("long")
    cut = F.lit("2024-01-16").cast("date")
    schema_log.upsert_evolving(spark, f"{base}/events", b.where(F.col("event_date") < cut), ["event_id"], f"{base}/refused")
    # Two days of the first half come again, changed, so that old files are merged too.
    later = b.where((F.col("event_date") >= cut) | (F.dayofmonth("event_date").isin(3, 9)))
    later = (later.withColumn("carrier", F.concat(F.lit("k"), (n % 5).cast("string"))).withColumn("handling_ms", n * 3)
             .withColumn("sequence_no", F.when(n % 11 == 0, F.lit("n/a")).otherwise(F.col("sequence_no").cast("string"))))
    schema_log.upsert_evolving(spark, f"{base}/events", later, ["event_id"], f"{base}/refused")
    good = schema_log.read_evolved(spark, f"{base}/events").withColumn("refused", F.lit(False))
    bad = spark.read.parquet(f"{base}/refused").select(F.from_json("row", "event_id string, event_type string, event_date date, carrier string, handling_ms long").alias("r"))
    bad = bad.select("r.*", F.lit(None).cast("long").alias("sequence_no"), F.lit(True).alias("refused"))
    cols = ["event_id", "event_type", "event_date", "sequence_no", "carrier", "handling_ms", "refused"]
    return good.select(*cols).unionByName(bad.select(*cols))


# Three runs of a stored history: parcels of the first third of the month, of the second, and of the first and last.
HISTORY_RUNS = [("2024-02-01 00:00:00", "day <= 10"), ("2024-02-02 00:00:00", "day between 11 and 20"), ("2024-02-03 00:00:00", "day <= 10 or day > 20")]


def _parcel_history(spark, d, name):
    configure(spark)
    path = scratch_path(spark, name)
    b = bronze_from_dir(spark, d).withColumn("day", F.dayofmonth("event_ts"))
    for run_ts, days in HISTORY_RUNS:
        state = b.where(days).groupBy("parcel_id").agg(F.max("sequence_no").alias("last_no"), F.max("event_ts").alias("last_seen_ts"))
        history.run_snapshot(spark, path, state, "parcel_id", ["last_no"], run_ts)
    return path


def d2_delete_return(spark, d):
    """A stored history over three runs; parcels leave and return."""
    return history.read_history(spark, _parcel_history(spark, d, "d2_history"))


def j5_change_feed(spark, d):
    """What each of the three runs found new, returned, changed or deleted."""
    return history.read_changes(spark, _parcel_history(spark, d, "j5_history"))


# -- data tests -----------------------------------------------------------------

def e8_reference_suite(spark, d):
    """The reference's 81 data tests over every model of the build."""
    configure(spark)
    shared_dir(spark)
    return suite.run_reference_tests(spark, d)


# Fixed checks over the driver tables (TPC-H-like keys), one per test kind.
DRIVER_CHECKS = [
    Check("orders", "not_null", "o_orderkey"),
    Check("orders", "unique", "o_orderkey"),
    Check("orders", "accepted_values", "o_orderstatus", ("F", "O")),
    Check("orders", "relationships", "o_custkey", to="customer", field="c_custkey"),
    Check("lineitem", "not_null", "l_shipdate"),
    Check("lineitem", "unique", "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))"),
    Check("lineitem", "accepted_values", "l_returnflag", ("A", "N", "R"), severity="warn"),
    Check("lineitem", "relationships", "l_orderkey", to="orders", field="o_orderkey"),
    Check("lineitem", "relationships", "l_partkey", to="part", field="p_partkey"),
    Check("lineitem", "relationships", "l_suppkey", to="supplier", field="s_suppkey", severity="warn"),
    Check("orders", "not_null", "o_comment"),
]


def e8_driver_table_suite(spark, d):
    """E1-E6, E8 on the driver tables: not_null, unique (column and
    expression), accepted_values, relationships, severities, missing column."""
    tables = {t: read_table(spark, d, t) for t in ("orders", "lineitem", "customer", "part", "supplier")}
    return run_suite(spark, tables, DRIVER_CHECKS)


def e7_source_freshness(spark, d):
    """Bronze freshness at 2024-01-31 00:00 over the last 3 days."""
    configure(spark)
    return freshness(bronze_from_dir(spark, d), "event_ts", "2024-01-31 00:00:00", 30, 120, 3)


# -- KPIs ---------------------------------------------------------------------------

def _silver_all(spark, d):
    return _silver(spark, d, keep_latest_per_type=False)


def m1_on_time_rate(spark, d):
    return kpi.on_time_rate(kpi.parcel_summary(_silver_all(spark, d)))


def m2_first_attempt_success_rate(spark, d):
    return kpi.first_attempt_success_rate(facts.fact_parcel_delivery_attempts(_silver_all(spark, d), AS_OF, DAYS))


def m3_eta_mae(spark, d):
    s = _silver_all(spark, d)
    return kpi.eta_mae(s, kpi.parcel_summary(s))


def m4_eta_p95_enriched(spark, d):
    s = _silver_all(spark, d)
    eta = kpi.eta_events_enriched(facts.fact_eta_events(s, AS_OF, DAYS), kpi.parcel_summary(s))
    return gold.vw_eta_error_p95(eta)


def m5_sla_breach(spark, d):
    return kpi.sla_breach(kpi.parcel_summary(_silver_all(spark, d)), "2024-02-01 00:00:00")


# -- bronze layout --------------------------------------------------------------

def _bronze_table(spark, d, name):
    configure(spark)
    path = scratch_path(spark, name)
    bronze_io.append_bronze(bronze_from_dir(spark, d), path)
    return path


def s7_read_bronze_bounded(spark, d):
    """S4 + S7: day-partitioned bronze, read with a mandatory date range
    (partition pruning on event_date)."""
    path = _bronze_table(spark, d, "s7_bronze")
    return bronze_io.read_bronze(spark, path, "2024-01-08", "2024-01-14").select(*BRONZE_COLUMNS)


def s8_expire_partitions(spark, d):
    """Day partitions older than 10 days before 2024-01-31 dropped."""
    path = _bronze_table(spark, d, "s8_bronze")
    bronze_io.expire_partitions(spark, path, "2024-01-31", 10)
    return spark.read.parquet(path).select(*BRONZE_COLUMNS)


def s9_union_hot_cold(spark, d):
    """Hot rows (before 2024-01-16) + cold archive rows (from then on,
    archived by one backfill run at 2024-02-01 03:00), typed to one bronze
    schema."""
    configure(spark)
    base = scratch_path(spark, "s9_union")
    b = bronze_from_dir(spark, d)
    cut = F.lit("2024-01-16").cast("timestamp")
    bronze_io.archive_cold(b.filter(F.col("event_ts") >= cut)
                           .withColumn("ingest_ts", F.lit("2024-02-01 03:00:00").cast("timestamp")),
                           f"{base}/archive")
    cold = bronze_io.read_cold(spark, f"{base}/archive")
    return bronze_io.union_bronze(b.filter(F.col("event_ts") < cut), cold).select(*BRONZE_COLUMNS)


def s10_publish_events(spark, d):
    """Keyed JSON messages, read back from the value."""
    configure(spark)
    m = bronze_io.publish_events(bronze_from_dir(spark, d))
    return m.select("key", F.get_json_object("value", "$.event_id").alias("event_id"),
                    F.get_json_object("value", "$.event_ts").cast("timestamp").alias("event_ts"),
                    "sequence_no")


QUERIES: dict[str, Query] = {
    "q01_silver_parcel_events": q01,
    "q02_silver_parcel_latest": q02,
    "q03_fact_depot_visits": q03,
    "q04_fact_eta_events": q04,
    "q05_fact_parcel_deliveries": q05,
    "q06_fact_parcel_delivery_attempts": q06,
    "q07_stg_courier_attributes": q07,
    "q08_stg_merchant_attributes": q08,
    "q09_snap_courier_scd2": q09,
    "q10_snap_merchant_scd2": q10,
    "q11_dim_courier": q11,
    "q12_dim_merchant": q12,
    "q13_dim_depot": q13,
    "q14_dim_route": q14,
    "q15_dim_exception_code": q15,
    "q16_dim_service_tier": q16,
    "q17_vw_depot_dwell_p95": q17,
    "q18_vw_eta_error_p95": q18,
    "q19_vw_first_attempt_success": q19,
    "j2_silver_events_incremental": j2_silver_events,
    "j2_silver_latest_incremental": j2_silver_latest,
    **{f"j2_{name}_incremental": _incremental_fact(name) for name in build.FACT_KEYS},
    "j2_indexed_merge": j2_indexed_merge,
    "s11_published_versions": s11_published_versions,
    "s11_published_view": s11_published_view,
    "c4_contract_validation": c4_contract_validation,
    "c1_conform_bronze": c1_conform_bronze,
    "s6_quarantine_by_rule": s6_quarantine_by_rule,
    "s6_dead_letter": s6_dead_letter,
    "c8_infer_extras": c8_infer_extras,
    "c8_extra_kinds": c8_extra_kinds,
    "c7_evolve": c7_evolve,
    "d2_delete_return": d2_delete_return,
    "j5_change_feed": j5_change_feed,
    "c10_inject_context": c10_inject_context,
    "c11_repair_event_time": c11_repair_event_time,
    "r1_stream_ingest_bronze": r1_stream_ingest,
    "r3_stream_archive_cold": r3_stream_archive,
    "c12_ingest_counts": c12_ingest_counts,
    "r4_ordered": r4_ordered,
    "r6_stream_silver": r6_stream_silver,
    "r6_late_rows": r6_late_rows,
    "t5_late_depot_dwell": t5_late_depot_dwell,
    "r7_stream_dedup": r7_stream_dedup,
    "e8_reference_suite": e8_reference_suite,
    "e8_driver_table_suite": e8_driver_table_suite,
    "e7_source_freshness": e7_source_freshness,
    "m1_on_time_rate": m1_on_time_rate,
    "m2_first_attempt_success_rate": m2_first_attempt_success_rate,
    "m3_eta_mae": m3_eta_mae,
    "m4_eta_p95_enriched": m4_eta_p95_enriched,
    "m5_sla_breach": m5_sla_breach,
    "s7_read_bronze_bounded": s7_read_bronze_bounded,
    "s8_expire_partitions": s8_expire_partitions,
    "s9_union_hot_cold": s9_union_hot_cold,
    "s10_publish_events": s10_publish_events,
}
