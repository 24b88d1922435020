"""Portable SQL for every registered query, used as an independent oracle
(DuckDB runs it on the same parquet tables, pre-registered as views).

The statements are written from the model definitions, not generated from
the Spark plans. Dialect notes: minutes use ``date_sub('minute', a, b)``
(truncating like Spark's ``timestampdiff``), p95 uses ``quantile_disc``,
NULL order is spelled out, and ``ANY_VALUE`` is ``min`` on both sides.
"""

from __future__ import annotations

import datetime as dt

from .functions.contracts import BRONZE_COLUMNS
from .sources.fixtures import BRONZE_SQL
from .sources.messages import EXPECTED, N_CLASSES

AS_OF, DAYS = "2024-01-31", 30
SNAP1_AS_OF, SNAP1_RUN_TS = "2024-01-15", "2024-01-16 00:00:00"
SNAP2_RUN_TS = "2024-02-01 00:00:00"

SILVER_COLS = BRONZE_COLUMNS + ["event_date"]
_TS = {"event_ts", "created_ts", "promised_window_start", "promised_window_end",
       "first_planned_eta_ts", "predicted_delivery_ts", "generated_ts", "delivered_ts"}
NEWEST = "event_ts DESC NULLS LAST, sequence_no DESC NULLS LAST, event_id DESC NULLS LAST"


def _start(as_of: str, days: int) -> str:
    return (dt.date.fromisoformat(as_of) - dt.timedelta(days=days)).isoformat()


def _cols(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in SILVER_COLS)


def silver_ctes(name: str = "silver", as_of: str = AS_OF, days: int = DAYS,
                latest_per_type: bool = True, extra_where: str = "") -> str:
    """CTEs ``bronze_<name>`` ... ``<name>`` computing silver_parcel_events."""
    casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" if c in _TS else c for c in BRONZE_COLUMNS)
    s = f"""
{name}_bronze AS ({BRONZE_SQL}),
{name}_src AS (
  SELECT {casts}, CAST(CAST(event_ts AS TIMESTAMP) AS DATE) AS event_date
  FROM {name}_bronze
  WHERE CAST(CAST(event_ts AS TIMESTAMP) AS DATE) BETWEEN DATE '{_start(as_of, days)}' AND DATE '{as_of}'
  {extra_where}
),
{name}_d1 AS (
  SELECT {_cols()} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY {NEWEST}) AS rn FROM {name}_src
  ) t WHERE rn = 1
)"""
    if latest_per_type:
        s += f""",
{name} AS (
  SELECT {_cols()} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY parcel_id, event_type ORDER BY {NEWEST}) AS rn FROM {name}_d1
  ) t WHERE rn = 1
)"""
    else:
        s += f""",
{name} AS (SELECT * FROM {name}_d1)"""
    return s


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def _window_where(as_of=AS_OF, days=DAYS) -> str:
    return f"CAST(event_ts AS DATE) BETWEEN DATE '{_start(as_of, days)}' AND DATE '{as_of}'"


def depot_visits_cte(name: str = "depot_visits", src: str = "silver", as_of: str = AS_OF,
                     days: int = DAYS, extra_where: str = "") -> str:
    return f"""
{name}_scans AS (
  SELECT event_id, parcel_id, depot_id, event_type, sequence_no, event_ts
  FROM {src}
  WHERE {_window_where(as_of, days)} AND event_type IN ('SCAN_IN_DEPOT', 'SCAN_OUT_DEPOT')
    AND depot_id IS NOT NULL {extra_where}
),
{name}_paired AS (
  SELECT parcel_id, depot_id, event_ts AS in_depot_ts, event_type AS curr_type,
    LEAD(event_ts) OVER (PARTITION BY parcel_id, depot_id ORDER BY event_ts, sequence_no, event_id) AS out_depot_ts,
    LEAD(event_type) OVER (PARTITION BY parcel_id, depot_id ORDER BY event_ts, sequence_no, event_id) AS next_type
  FROM {name}_scans
),
{name} AS (
  SELECT parcel_id, depot_id, in_depot_ts, out_depot_ts,
    date_sub('minute', in_depot_ts, out_depot_ts) AS dwell_minutes,
    CAST(in_depot_ts AS DATE) AS event_date
  FROM {name}_paired
  WHERE curr_type = 'SCAN_IN_DEPOT' AND next_type = 'SCAN_OUT_DEPOT' AND out_depot_ts IS NOT NULL
)"""


DEPOT_VISITS_CTE = depot_visits_cte()

ETA_CTE = f"""
eta_events AS (
  SELECT event_id, parcel_id, route_id, depot_id, courier_id, merchant_id, source,
    first_planned_eta_ts, predicted_delivery_ts, generated_ts, event_ts, event_date
  FROM silver
  WHERE {_window_where()} AND event_type IN ('ETA_SET', 'ETA_UPDATED')
    AND predicted_delivery_ts IS NOT NULL AND generated_ts IS NOT NULL
)"""

ATTEMPTS_CTE = f"""
attempts AS (
  SELECT event_id, parcel_id, route_id, courier_id, depot_id, merchant_id, attempt_number,
    outcome, failure_reason, event_ts AS attempt_ts, event_date
  FROM silver
  WHERE {_window_where()} AND event_type = 'DELIVERED' AND attempt_number IS NOT NULL
)"""

STG_COURIER = """
  SELECT courier_id, min(route_id) AS sample_route_id, max(event_ts) AS last_seen_ts
  FROM {src} WHERE courier_id IS NOT NULL GROUP BY courier_id"""

STG_MERCHANT = f"""
  SELECT merchant_id, service_tier, promised_window_start, promised_window_end, event_ts AS last_seen_ts
  FROM (
    SELECT merchant_id, service_tier, promised_window_start, promised_window_end, event_ts,
      ROW_NUMBER() OVER (PARTITION BY merchant_id ORDER BY {NEWEST}) AS rn
    FROM {{src}} WHERE merchant_id IS NOT NULL
  ) t WHERE rn = 1"""


def _snap_fragments(stg: str, key: str, check_cols, attrs, p: str = "", s1: str = "s1", s2: str = "s2") -> list:
    """CTEs of the snapshot after run 1 (all rows open) and run 2 (close
    changed or deleted keys, open new or changed keys), ending in ``{p}snap``."""
    changed = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in check_cols)
    cols = [key] + list(attrs)
    hcols = ", ".join(f"h.{c}" for c in cols)
    scols = ", ".join(f"s.{c}" for c in cols)
    t1, t2 = f"TIMESTAMP '{SNAP1_RUN_TS}'", f"TIMESTAMP '{SNAP2_RUN_TS}'"
    return [
        f"{p}run1 AS ({stg.format(src=s1)})", f"{p}run2 AS ({stg.format(src=s2)})",
        f"{p}h1 AS (SELECT {', '.join(cols)}, {t1} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to "
        f"FROM {p}run1)",
        f"""{p}old_rows AS (
  SELECT {hcols}, h.dbt_valid_from,
    CASE WHEN s.{key} IS NULL OR {changed} THEN {t2} ELSE h.dbt_valid_to END AS dbt_valid_to
  FROM {p}h1 h LEFT JOIN {p}run2 s ON h.{key} = s.{key})""",
        f"""{p}new_rows AS (
  SELECT {scols}, {t2} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM {p}run2 s LEFT JOIN {p}h1 h ON h.{key} = s.{key}
  WHERE h.{key} IS NULL OR {changed})""",
        f"{p}snap AS (SELECT * FROM {p}old_rows UNION ALL SELECT * FROM {p}new_rows)",
    ]


def _scd2_two_runs(stg: str, key: str, check_cols, attrs) -> str:
    return _with(silver_ctes("s1", SNAP1_AS_OF, DAYS), silver_ctes("s2", AS_OF, DAYS),
                 *_snap_fragments(stg, key, check_cols, attrs))


COURIER_SNAP = _scd2_two_runs(STG_COURIER, "courier_id", ["sample_route_id"],
                              ["sample_route_id", "last_seen_ts"])
MERCHANT_SNAP = _scd2_two_runs(STG_MERCHANT, "merchant_id",
                               ["service_tier", "promised_window_start", "promised_window_end"],
                               ["service_tier", "promised_window_start", "promised_window_end", "last_seen_ts"])

S = silver_ctes()

ORACLE: dict[str, str] = {
    "q01_silver_parcel_events": _with(S) + f"\nSELECT {_cols()} FROM silver",
    "q02_silver_parcel_latest": _with(S) + f"""
SELECT {_cols()} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY parcel_id ORDER BY {NEWEST}) AS rn FROM silver
) t WHERE rn = 1""",
    "q03_fact_depot_visits": _with(S, DEPOT_VISITS_CTE) + "\nSELECT * FROM depot_visits",
    "q04_fact_eta_events": _with(S, ETA_CTE) + "\nSELECT * FROM eta_events",
    "q05_fact_parcel_deliveries": _with(S) + f"""
SELECT event_id, parcel_id, route_id, courier_id, attempt_number, outcome, failure_reason,
  delivered_ts, event_date
FROM silver
WHERE {_window_where()} AND event_type = 'DELIVERED' AND delivered_ts IS NOT NULL""",
    "q06_fact_parcel_delivery_attempts": _with(S, ATTEMPTS_CTE) + "\nSELECT * FROM attempts",
    "q07_stg_courier_attributes": _with(S) + STG_COURIER.format(src="silver"),
    "q08_stg_merchant_attributes": _with(S) + STG_MERCHANT.format(src="silver"),
    "q09_snap_courier_scd2": COURIER_SNAP + "\nSELECT * FROM snap",
    "q10_snap_merchant_scd2": MERCHANT_SNAP + "\nSELECT * FROM snap",
    "q11_dim_courier": COURIER_SNAP + """
SELECT courier_id, sample_route_id, last_seen_ts, dbt_valid_from, dbt_valid_to
FROM snap WHERE dbt_valid_to IS NULL""",
    "q12_dim_merchant": MERCHANT_SNAP + """
SELECT merchant_id, service_tier, promised_window_start, promised_window_end, last_seen_ts,
  dbt_valid_from, dbt_valid_to
FROM snap WHERE dbt_valid_to IS NULL""",
    "q13_dim_depot": _with(S) + """
SELECT depot_id, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts,
  COUNT(*) FILTER (WHERE event_type = 'SCAN_IN_DEPOT') AS scan_in_count,
  COUNT(*) FILTER (WHERE event_type = 'SCAN_OUT_DEPOT') AS scan_out_count
FROM silver WHERE depot_id IS NOT NULL GROUP BY depot_id""",
    "q14_dim_route": _with(S) + """
SELECT route_id AS route_sk, route_id, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts,
  COUNT(*) AS event_count
FROM silver WHERE route_id IS NOT NULL GROUP BY route_id""",
    "q15_dim_exception_code": _with(S) + """
SELECT exception_code, min(stage_hint) AS stage_hint_example, COUNT(*) AS occurrences
FROM silver WHERE exception_code IS NOT NULL GROUP BY exception_code""",
    "q16_dim_service_tier": _with(S) + """
SELECT service_tier AS service_tier_sk, service_tier,
  min(promised_window_start) AS sample_promised_start, min(promised_window_end) AS sample_promised_end
FROM silver WHERE service_tier IS NOT NULL GROUP BY service_tier""",
    "q17_vw_depot_dwell_p95": _with(S, DEPOT_VISITS_CTE) + """
SELECT event_date, depot_id, quantile_disc(dwell_minutes, 0.95) AS depot_dwell_p95_min
FROM depot_visits GROUP BY event_date, depot_id""",
    "q18_vw_eta_error_p95": _with(S, ETA_CTE) + """
SELECT CAST(generated_ts AS DATE) AS event_date, depot_id, courier_id, merchant_id,
  quantile_disc(abs(date_sub('minute', predicted_delivery_ts, first_planned_eta_ts)), 0.95) AS eta_p95_error_min
FROM eta_events
WHERE event_ts IS NOT NULL AND predicted_delivery_ts IS NOT NULL
GROUP BY CAST(generated_ts AS DATE), depot_id, courier_id, merchant_id""",
    "q19_vw_first_attempt_success": _with(S, ATTEMPTS_CTE) + """
SELECT parcel_id, min(depot_id) AS depot_id, min(courier_id) AS courier_id, min(merchant_id) AS merchant_id,
  min(COALESCE(CAST(attempt_ts AS DATE), event_date)) AS event_date,
  CAST(MAX(CASE WHEN UPPER(outcome) = 'DELIVERED' THEN 1 ELSE 0 END) AS INTEGER) AS delivered_any,
  CAST(MAX(CASE WHEN attempt_number = 1 AND UPPER(outcome) = 'DELIVERED' THEN 1 ELSE 0 END) AS INTEGER)
    AS first_attempt_success
FROM attempts GROUP BY parcel_id""",
}


# -- incremental builds (two batches: as_of 2024-01-15, then 2024-01-31) -----

INC1_AS_OF = "2024-01-15"


def _latest_all(src: str) -> str:
    return f"""SELECT {_cols()} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY parcel_id ORDER BY {NEWEST}) AS rn FROM {src}
  ) t WHERE rn = 1"""


_INC_SILVER = (
    silver_ctes("b1", INC1_AS_OF, DAYS),
    "hw1 AS (SELECT max(event_ts) AS hw FROM b1)",
    silver_ctes("b2", AS_OF, DAYS, extra_where="AND event_ts > (SELECT hw FROM hw1)"),
    f"""silver_final AS (
  SELECT {_cols()} FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.event_id = b1.event_id)
  UNION ALL SELECT {_cols()} FROM b2)""",
)

ORACLE["j2_silver_events_incremental"] = _with(*_INC_SILVER) + "\nSELECT * FROM silver_final"

ORACLE["j2_indexed_merge"] = _with(f"bronze AS ({BRONZE_SQL})", """b AS (
  SELECT event_id, parcel_id, event_type, event_ts, sequence_no, CAST(regexp_extract(event_id, '(\\d+)$', 1) AS BIGINT) AS n,
    CASE WHEN dayofmonth(event_ts) <= 10 THEN 0 WHEN dayofmonth(event_ts) <= 20 THEN 1 ELSE 2 END AS turn FROM bronze)""",
    """brought AS (SELECT event_id, parcel_id, event_type, event_ts, sequence_no, turn FROM b
  UNION ALL SELECT event_id, parcel_id, event_type, event_ts + INTERVAL '10' DAY, sequence_no + 100, r.k
  FROM b JOIN (VALUES (1), (2)) r(k) ON b.turn < r.k AND b.n % 97 = r.k)""",
    f"newest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY turn DESC, {NEWEST}) AS k FROM brought)") + """
SELECT event_id, parcel_id, event_type, event_ts, sequence_no, CAST(event_ts AS DATE) AS event_date FROM newest WHERE k = 1"""

_DEPOTS = """SELECT '{as_of}' AS as_of, depot_id, max(event_ts) AS last_seen_ts, COUNT(*) FILTER (WHERE event_type = 'SCAN_IN_DEPOT') AS scan_in_count,
  COUNT(*) FILTER (WHERE event_type = 'SCAN_OUT_DEPOT') AS scan_out_count FROM {src} WHERE depot_id IS NOT NULL GROUP BY depot_id"""
ORACLE["s11_published_versions"] = _with(silver_ctes("p1", INC1_AS_OF, DAYS), silver_ctes("p2", AS_OF, DAYS)) + "\n" + "\nUNION ALL\n".join(
    _DEPOTS.format(as_of=a, src=s) for a, s in ((INC1_AS_OF, "p1"), (AS_OF, "p2")))
ORACLE["s11_published_view"] = ORACLE["q17_vw_depot_dwell_p95"]

ORACLE["j2_silver_latest_incremental"] = _with(
    *_INC_SILVER,
    f"latest1 AS ({_latest_all('b1')})",
    """changed AS (SELECT DISTINCT parcel_id FROM silver_final
  WHERE event_ts > COALESCE((SELECT max(event_ts) FROM latest1), TIMESTAMP '1970-01-01 00:00:00'))""",
    f"latest2 AS ({_latest_all('(SELECT * FROM silver_final WHERE parcel_id IN (SELECT parcel_id FROM changed))')})",
) + f"""
SELECT {_cols()} FROM latest1 WHERE parcel_id NOT IN (SELECT parcel_id FROM latest2)
UNION ALL SELECT {_cols()} FROM latest2"""

ORACLE["j2_fact_depot_visits_incremental"] = _with(
    *_INC_SILVER,
    depot_visits_cte("f1", "b1", INC1_AS_OF, DAYS),
    depot_visits_cte("f2", "silver_final", AS_OF, DAYS,
                     "AND CAST(event_ts AS DATE) > (SELECT COALESCE(max(event_date), DATE '1970-01-01') FROM f1)"),
) + """
SELECT * FROM f1 WHERE NOT EXISTS (
  SELECT 1 FROM f2 WHERE f2.parcel_id = f1.parcel_id AND f2.depot_id = f1.depot_id AND f2.in_depot_ts = f1.in_depot_ts)
UNION ALL SELECT * FROM f2"""


# Q4-Q6: later days only (T5), merged by event_id.
_EVENT_FACTS = {
    "fact_eta_events": ("event_id, parcel_id, route_id, depot_id, courier_id, merchant_id, source, first_planned_eta_ts, predicted_delivery_ts, generated_ts, event_ts, event_date",
                        "event_type IN ('ETA_SET', 'ETA_UPDATED') AND predicted_delivery_ts IS NOT NULL AND generated_ts IS NOT NULL"),
    "fact_parcel_deliveries": ("event_id, parcel_id, route_id, courier_id, attempt_number, outcome, failure_reason, delivered_ts, event_date",
                               "event_type = 'DELIVERED' AND delivered_ts IS NOT NULL"),
    "fact_parcel_delivery_attempts": ("event_id, parcel_id, route_id, courier_id, depot_id, merchant_id, attempt_number, outcome, failure_reason, event_ts AS attempt_ts, event_date",
                                      "event_type = 'DELIVERED' AND attempt_number IS NOT NULL"),
}
for _name, (_columns, _where) in _EVENT_FACTS.items():
    ORACLE[f"j2_{_name}_incremental"] = _with(
        *_INC_SILVER,
        f"f1 AS (SELECT {_columns} FROM b1 WHERE {_window_where(INC1_AS_OF)} AND {_where})",
        f"f2 AS (SELECT {_columns} FROM silver_final WHERE {_window_where()} AND {_where} AND event_date > (SELECT COALESCE(max(event_date), DATE '1970-01-01') FROM f1))",
    ) + "\nSELECT * FROM f1 WHERE event_id NOT IN (SELECT event_id FROM f2)\nUNION ALL SELECT * FROM f2"


# -- contracts: expected outcome per defect class (independent of parsing) ----

_EXPECTED_CASE = "CASE cls " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in EXPECTED.items()) + " ELSE '' END"
_MSG = (
    f"bronze AS ({BRONZE_SQL})",
    f"""msgs AS (
  SELECT *, concat(event_id, '#', CAST(epoch_us(event_ts) AS VARCHAR)) AS msg_id,
    CAST(CAST(regexp_extract(event_id, '(\\d+)$', 1) AS BIGINT) % {N_CLASSES} AS INTEGER) AS cls
  FROM bronze)""",
    f"expected AS (SELECT *, {_EXPECTED_CASE} AS rules FROM msgs)",
)

ORACLE["c4_contract_validation"] = _with(*_MSG) + """
SELECT msg_id, cls, rules = '' AS is_valid, rules FROM expected"""

ORACLE["c1_conform_bronze"] = _with(*_MSG) + "\nSELECT msg_id, " + ", ".join(
    "CASE WHEN cls = 14 THEN CAST(1 AS BIGINT) ELSE sequence_no END AS sequence_no" if c == "sequence_no" else c
    for c in BRONZE_COLUMNS) + "\nFROM expected WHERE rules = ''"

ORACLE["s6_quarantine_by_rule"] = _with(*_MSG) + """,
v AS (SELECT unnest(string_split(rules, ',')) AS pr FROM expected WHERE rules <> '')
SELECT split_part(pr, ':', 1) AS path, split_part(pr, ':', 2) AS rule, COUNT(*) AS n
FROM v GROUP BY 1, 2"""

ORACLE["s6_dead_letter"] = _with(*_MSG) + """,
f AS (SELECT CASE WHEN cls = 16 THEN 'event_ts:typing' ELSE rules END AS rules, cls FROM expected)
SELECT CASE WHEN cls = 12 THEN 'delivered' ELSE 'dead' END AS outcome, CASE WHEN cls = 12 THEN 3 ELSE 5 END AS attempts,
  CASE WHEN cls = 12 THEN '' ELSE rules END AS rules, CAST(COUNT(*) AS BIGINT) AS messages
FROM f WHERE rules <> '' GROUP BY 1, 2, 3"""

ORACLE["c8_infer_extras"] = _with(*_MSG) + """
SELECT 'extra_note' AS key, 'string' AS type, COUNT(*) AS n FROM expected WHERE cls = 12 HAVING COUNT(*) > 0"""

_EXTRA_TYPES = {"x_flag": "boolean", "x_int": "bigint", "x_float": "number", "x_seen_ts": "timestamp", "x_text": "string", "x_number": "number", "x_any": "string", "x_maybe": "bigint",
                "x_none": "string", "x_list": "string", "x_late_ts": "string", "x_rare": "boolean"}
ORACLE["c8_extra_kinds"] = _with(f"bronze AS ({BRONZE_SQL})", """c AS (SELECT CAST(COUNT(*) AS BIGINT) AS all_n,
  CAST(count_if(CAST(regexp_extract(event_id, '(\\d+)$', 1) AS BIGINT) % 7 = 0) AS BIGINT) AS rare_n FROM bronze)""") + "\nUNION ALL\n".join(
    "\nSELECT '{}' AS layer, '{}' AS key, '{}' AS type, {} AS n FROM c".format(layer, k, number if t == "number" else t, "rare_n" if k == "x_rare" else "all_n")
    for layer, number in (("hot", "decimal(38,9)"), ("cold", "double")) for k, t in _EXTRA_TYPES.items())

ORACLE["c10_inject_context"] = _with(f"bronze AS ({BRONZE_SQL})", """ctx AS (
  SELECT parcel_id, min(route_id) AS r, min(courier_id) AS c, min(depot_id) AS d, min(merchant_id) AS m
  FROM bronze GROUP BY parcel_id)""") + """
SELECT b.event_id, b.event_ts, b.event_type,
  CASE WHEN b.event_type IN ('LOADED_TO_VAN','OUT_FOR_DELIVERY','ETA_SET','ETA_UPDATED','DELIVERED')
       THEN COALESCE(b.route_id, ctx.r) ELSE b.route_id END AS route_id,
  CASE WHEN b.event_type IN ('LOADED_TO_VAN','DELIVERED') THEN COALESCE(b.courier_id, ctx.c) ELSE b.courier_id END
    AS courier_id,
  CASE WHEN b.event_type IN ('SCAN_IN_DEPOT','SCAN_OUT_DEPOT') THEN COALESCE(b.depot_id, ctx.d) ELSE b.depot_id END
    AS depot_id,
  CASE WHEN b.event_type = 'PARCEL_CREATED' THEN COALESCE(b.merchant_id, ctx.m) ELSE b.merchant_id END AS merchant_id
FROM bronze b LEFT JOIN ctx ON b.parcel_id = ctx.parcel_id"""

# Brute force: each row folds its whole ordered prefix.
ORACLE["c11_repair_event_time"] = _with(f"bronze AS ({BRONZE_SQL})", """p AS (
  SELECT parcel_id, event_id, sequence_no,
    CASE WHEN sequence_no IN (2, 8) THEN event_ts - INTERVAL 30 MINUTE ELSE event_ts END AS orig_ts
  FROM bronze)""", """w AS (
  SELECT *, list(orig_ts) OVER (PARTITION BY parcel_id ORDER BY sequence_no, orig_ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l
  FROM p)""") + """
SELECT parcel_id, event_id, sequence_no, orig_ts,
  list_reduce(l, lambda acc, x: CASE WHEN x < acc THEN acc + INTERVAL 1 SECOND ELSE x END) AS event_ts
FROM w"""


# -- streaming ----------------------------------------------------------------

ORACLE["r1_stream_ingest_bronze"] = _with(*_MSG) + "\nSELECT " + ", ".join(
    "CASE WHEN cls = 14 THEN CAST(1 AS BIGINT) ELSE sequence_no END AS sequence_no" if c == "sequence_no" else c
    for c in BRONZE_COLUMNS) + "\nFROM expected WHERE rules = ''"

ORACLE["r3_stream_archive_cold"] = ORACLE["r1_stream_ingest_bronze"]

ORACLE["c12_ingest_counts"] = _with(*_MSG) + """
SELECT consumer, CAST(count_if(rules = '') AS BIGINT) AS accepted, CAST(count_if(rules <> '') AS BIGINT) AS rejected,
  CAST(4 AS BIGINT) AS batches FROM expected, (VALUES ('hot'), ('cold')) c(consumer) GROUP BY consumer"""

# One micro-batch per week of January: W1/W2 inside each batch, then merged
# by event_id with the later batch winning. No row is below the high-water
# mark, as batches arrive in time order.
_TSC = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" if c in _TS else c for c in BRONZE_COLUMNS)
ORACLE["r6_stream_silver"] = _with(
    f"bronze AS ({BRONZE_SQL})",
    f"""src AS (SELECT {_TSC}, CAST(event_ts AS DATE) AS event_date,
  CAST(floor((dayofmonth(event_ts) - 1) / 7) AS INTEGER) AS wk FROM bronze)""",
    f"""d1 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY wk, event_id ORDER BY {NEWEST}) AS rn
  FROM src) t WHERE rn = 1)""",
    f"""d2 AS (SELECT * EXCLUDE (rn) FROM (SELECT * EXCLUDE (rn),
  ROW_NUMBER() OVER (PARTITION BY wk, parcel_id, event_type ORDER BY {NEWEST}) AS rn FROM d1) t WHERE rn = 1)""",
    """merged AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY wk DESC) AS rn2
  FROM d2) t WHERE rn2 = 1)""",
) + f"\nSELECT {_cols()} FROM merged"

# Late rows in any order come to the full refresh.
ORACLE["r6_late_rows"] = ORACLE["q01_silver_parcel_events"]
ORACLE["t5_late_depot_dwell"] = ORACLE["q17_vw_depot_dwell_p95"]

ORACLE["r4_ordered"] = _with(f"bronze AS ({BRONZE_SQL})") + """,
once AS (SELECT DISTINCT parcel_id, sequence_no, event_id FROM bronze
  WHERE NOT (sequence_no = 5 AND CAST(regexp_extract(parcel_id, '(\\d+)$', 1) AS BIGINT) % 3 = 0))
SELECT parcel_id, ROW_NUMBER() OVER (PARTITION BY parcel_id ORDER BY sequence_no) - 1 AS position, sequence_no, event_id FROM once"""

ORACLE["c7_evolve"] = _with(f"bronze AS ({BRONZE_SQL})", f"""b AS (
  SELECT event_id, parcel_id, event_type, event_ts, sequence_no, CAST(event_ts AS DATE) AS event_date,
    CAST(regexp_extract(event_id, '(\\d+)$', 1) AS BIGINT) AS n FROM bronze)""",
    "later AS (SELECT * FROM b WHERE event_date >= DATE '2024-01-16' OR dayofmonth(event_date) IN (3, 9))",
    f"""merged AS (
  SELECT *, 1 AS turn FROM b WHERE event_date < DATE '2024-01-16'
  UNION ALL SELECT *, 2 FROM later WHERE n % 11 <> 0)""",
    f"newest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY turn DESC, {NEWEST}) AS k FROM merged)") + """
SELECT event_id, event_type, event_date, sequence_no, CASE WHEN turn = 2 THEN concat('k', n % 5) END AS carrier,
  CASE WHEN turn = 2 THEN n * 3 END AS handling_ms, false AS refused FROM newest WHERE k = 1
UNION ALL SELECT event_id, event_type, event_date, NULL, concat('k', n % 5), n * 3, true FROM later WHERE n % 11 = 0"""

_HISTORY = (f"bronze AS ({BRONZE_SQL})",
    *[f"s{k} AS (SELECT parcel_id, max(sequence_no) AS last_no, max(event_ts) AS last_seen_ts FROM bronze WHERE {where} GROUP BY parcel_id)"
      for k, where in enumerate(("dayofmonth(event_ts) <= 10", "dayofmonth(event_ts) BETWEEN 11 AND 20", "dayofmonth(event_ts) <= 10 OR dayofmonth(event_ts) > 20"), 1)],
    # Every parcel's state (or none) after each run; a version lasts while the state stays.
    """v AS (SELECT p.parcel_id, r.k, r.t, s.last_no, s.last_seen_ts, s.parcel_id IS NOT NULL AS there
  FROM (SELECT DISTINCT parcel_id FROM bronze) p
  CROSS JOIN (VALUES (1, TIMESTAMP '2024-02-01'), (2, TIMESTAMP '2024-02-02'), (3, TIMESTAMP '2024-02-03')) r(k, t)
  LEFT JOIN (SELECT 1 AS k, * FROM s1 UNION ALL SELECT 2, * FROM s2 UNION ALL SELECT 3, * FROM s3) s
    ON s.k = r.k AND s.parcel_id = p.parcel_id)""",
    """w AS (SELECT *, LAG(there, 1, false) OVER o AS was, LAG(last_no) OVER o AS was_no,
  COALESCE(BOOL_OR(there) OVER (PARTITION BY parcel_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS before
  FROM v WINDOW o AS (PARTITION BY parcel_id ORDER BY k))""",
    """c AS (SELECT *, CASE WHEN there AND NOT was THEN CASE WHEN before THEN 'returned' ELSE 'new' END
  WHEN was AND NOT there THEN 'deleted' WHEN there AND last_no IS DISTINCT FROM was_no THEN 'changed' END AS change FROM w)""")
ORACLE["j5_change_feed"] = _with(*_HISTORY) + "\nSELECT parcel_id, change, t AS run_ts FROM c WHERE change IS NOT NULL"
ORACLE["d2_delete_return"] = _with(*_HISTORY, """e AS (
  SELECT *, LEAD(t) OVER (PARTITION BY parcel_id ORDER BY k) AS ends FROM c WHERE change IS NOT NULL)""") + """
SELECT parcel_id, last_no, last_seen_ts, t AS dbt_valid_from, ends AS dbt_valid_to FROM e WHERE change <> 'deleted'"""

ORACLE["r7_stream_dedup"] = _with(f"bronze AS ({BRONZE_SQL})") + """
SELECT DISTINCT event_id, parcel_id, event_type FROM bronze"""


# -- data tests on the driver tables -------------------------------------------

def _res(test, model, kind, column, severity, failures_sql, message=None):
    st = ("CASE WHEN f = 0 THEN 'pass' ELSE '" + ("warn" if severity == "warn" else "fail") + "' END"
          if failures_sql else "'error'")
    fs = failures_sql or "CAST(NULL AS BIGINT)"
    msg = f"'{message}'" if message else "CAST(NULL AS VARCHAR)"
    col = column.replace("'", "''")
    test = test.replace("'", "''")
    return (f"SELECT '{test}' AS test, '{model}' AS model, '{kind}' AS kind, '{col}' AS \"column\", "
            f"'{severity}' AS severity, f AS failures, {st} AS status, {msg} AS message "
            f"FROM (SELECT CAST(({fs}) AS BIGINT) AS f) t")


_LKEY = "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))"
ORACLE["e8_driver_table_suite"] = "\nUNION ALL\n".join([
    _res("not_null:orders.o_orderkey", "orders", "not_null", "o_orderkey", "error",
         "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"),
    _res("unique:orders.o_orderkey", "orders", "unique", "o_orderkey", "error",
         "SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL "
         "GROUP BY 1 HAVING count(*) > 1)"),
    _res("accepted_values:orders.o_orderstatus", "orders", "accepted_values", "o_orderstatus", "error",
         "SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    _res("relationships:orders.o_custkey->customer.c_custkey", "orders", "relationships", "o_custkey", "error",
         "SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN "
         "(SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)"),
    _res("not_null:lineitem.l_shipdate", "lineitem", "not_null", "l_shipdate", "error",
         "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL"),
    _res(f"unique:lineitem.{_LKEY}", "lineitem", "unique", _LKEY, "error",
         "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
         "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)"),
    _res("accepted_values:lineitem.l_returnflag", "lineitem", "accepted_values", "l_returnflag", "warn",
         "SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N', 'R')"),
    _res("relationships:lineitem.l_orderkey->orders.o_orderkey", "lineitem", "relationships", "l_orderkey",
         "error", "SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN "
         "(SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)"),
    _res("relationships:lineitem.l_partkey->part.p_partkey", "lineitem", "relationships", "l_partkey",
         "error", "SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN "
         "(SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)"),
    _res("relationships:lineitem.l_suppkey->supplier.s_suppkey", "lineitem", "relationships", "l_suppkey",
         "warn", "SELECT count(*) FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN "
         "(SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)"),
    _res("not_null:orders.o_comment", "orders", "not_null", "o_comment", "error", None,
         "missing column o_comment"),
])

ORACLE["e7_source_freshness"] = _with(f"bronze AS ({BRONZE_SQL})", """m AS (
  SELECT max(event_ts) AS max_loaded_at FROM bronze
  WHERE event_ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 DAY)""") + """
SELECT max_loaded_at, date_sub('minute', max_loaded_at, TIMESTAMP '2024-01-31 00:00:00') AS age_minutes,
  CASE WHEN max_loaded_at IS NULL OR date_sub('minute', max_loaded_at, TIMESTAMP '2024-01-31 00:00:00') >= 120
       THEN 'error'
       WHEN date_sub('minute', max_loaded_at, TIMESTAMP '2024-01-31 00:00:00') >= 30 THEN 'warn'
       ELSE 'pass' END AS status
FROM m"""

# -- KPIs ------------------------------------------------------------------------

_SA = silver_ctes("silver_all", latest_per_type=False)


def _last_sql(value, pred):
    return f"max_by(CASE WHEN {pred} THEN {value} END, CASE WHEN {pred} THEN event_ts END)"


_SUMMARY = f"""summary AS (
  SELECT parcel_id,
    min(CASE WHEN event_type = 'PARCEL_CREATED' THEN CAST(event_ts AS DATE) END) AS created_date,
    {_last_sql('promised_window_end', "event_type = 'PARCEL_CREATED'")} AS promised_window_end,
    {_last_sql('service_tier', "event_type = 'PARCEL_CREATED'")} AS service_tier,
    {_last_sql('merchant_id', "event_type = 'PARCEL_CREATED'")} AS merchant_id,
    {_last_sql('courier_id', "event_type = 'LOADED_TO_VAN'")} AS courier_id,
    {_last_sql('depot_id', "event_type IN ('SCAN_IN_DEPOT', 'SCAN_OUT_DEPOT')")} AS depot_id,
    {_last_sql('first_planned_eta_ts', "event_type = 'OUT_FOR_DELIVERY'")} AS first_planned_eta_ts,
    min(CASE WHEN event_type = 'DELIVERED' AND outcome = 'SUCCESS' THEN delivered_ts END) AS delivered_ts,
    {_last_sql('exception_code', "event_type = 'EXCEPTION'")} AS exception_code,
    {_last_sql('failure_reason', "event_type = 'DELIVERED' AND failure_reason IS NOT NULL")} AS failure_reason
  FROM silver_all GROUP BY parcel_id)"""

ORACLE["m1_on_time_rate"] = _with(_SA, _SUMMARY) + """
SELECT CAST(delivered_ts AS DATE) AS delivery_date, service_tier, COUNT(*) AS delivered,
  COUNT(*) FILTER (WHERE delivered_ts <= promised_window_end) AS on_time,
  COUNT(*) FILTER (WHERE delivered_ts <= promised_window_end) / COUNT(*) AS on_time_rate
FROM summary WHERE delivered_ts IS NOT NULL AND promised_window_end IS NOT NULL
GROUP BY 1, 2"""

ORACLE["m2_first_attempt_success_rate"] = _with(_SA, ATTEMPTS_CTE.replace("FROM silver", "FROM silver_all"), """
fas AS (
  SELECT parcel_id, min(COALESCE(CAST(attempt_ts AS DATE), event_date)) AS event_date,
    MAX(CASE WHEN attempt_number = 1 AND UPPER(outcome) = 'SUCCESS' THEN 1 ELSE 0 END) AS first_attempt_success
  FROM attempts GROUP BY parcel_id)""") + """
SELECT event_date, COUNT(*) AS parcels, CAST(SUM(first_attempt_success) AS BIGINT) AS first_attempt_successes,
  CAST(SUM(first_attempt_success) AS BIGINT) / COUNT(*) AS first_attempt_success_rate
FROM fas GROUP BY event_date"""

ORACLE["m3_eta_mae"] = _with(_SA, _SUMMARY, """
j AS (
  SELECT e.parcel_id, s.delivered_ts, e.generated_ts, e.predicted_delivery_ts
  FROM silver_all e JOIN summary s ON e.parcel_id = s.parcel_id
  WHERE e.event_type IN ('ETA_SET', 'ETA_UPDATED') AND s.delivered_ts IS NOT NULL
    AND e.generated_ts <= s.delivered_ts)""", """
last AS (
  SELECT parcel_id, delivered_ts, max_by(predicted_delivery_ts, generated_ts) AS predicted_delivery_ts
  FROM j GROUP BY parcel_id, delivered_ts)""") + """
SELECT CAST(delivered_ts AS DATE) AS delivery_date, COUNT(*) AS parcels,
  avg(abs(date_sub('minute', delivered_ts, predicted_delivery_ts))) AS eta_mae_min
FROM last GROUP BY 1"""

ORACLE["m4_eta_p95_enriched"] = _with(_SA, _SUMMARY, ETA_CTE.replace("FROM silver", "FROM silver_all"), """
enriched AS (
  SELECT e.event_ts, e.generated_ts, e.predicted_delivery_ts,
    COALESCE(e.depot_id, s.depot_id) AS depot_id, COALESCE(e.courier_id, s.courier_id) AS courier_id,
    COALESCE(e.merchant_id, s.merchant_id) AS merchant_id,
    COALESCE(e.first_planned_eta_ts, s.first_planned_eta_ts) AS first_planned_eta_ts
  FROM eta_events e LEFT JOIN summary s ON e.parcel_id = s.parcel_id)""") + """
SELECT CAST(generated_ts AS DATE) AS event_date, depot_id, courier_id, merchant_id,
  quantile_disc(abs(date_sub('minute', predicted_delivery_ts, first_planned_eta_ts)), 0.95) AS eta_p95_error_min
FROM enriched WHERE event_ts IS NOT NULL AND predicted_delivery_ts IS NOT NULL
GROUP BY 1, 2, 3, 4"""

ORACLE["m5_sla_breach"] = _with(_SA, _SUMMARY) + """
SELECT created_date, COALESCE(exception_code, failure_reason, 'NONE') AS attribution, COUNT(*) AS parcels,
  COUNT(*) FILTER (WHERE CASE WHEN delivered_ts IS NOT NULL THEN delivered_ts > promised_window_end
                              ELSE TIMESTAMP '2024-02-01 00:00:00' > promised_window_end END) AS breaches,
  COUNT(*) FILTER (WHERE CASE WHEN delivered_ts IS NOT NULL THEN delivered_ts > promised_window_end
                              ELSE TIMESTAMP '2024-02-01 00:00:00' > promised_window_end END) / COUNT(*)
    AS breach_rate
FROM summary WHERE promised_window_end IS NOT NULL
GROUP BY 1, 2"""

# -- bronze layout ---------------------------------------------------------------

_BR = f"bronze AS ({BRONZE_SQL})"
_BCOLS = ", ".join(BRONZE_COLUMNS)
ORACLE["s7_read_bronze_bounded"] = _with(_BR) + f"""
SELECT {_BCOLS} FROM bronze WHERE CAST(event_ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"""
ORACLE["s8_expire_partitions"] = _with(_BR) + f"""
SELECT {_BCOLS} FROM bronze WHERE CAST(event_ts AS DATE) >= DATE '2024-01-21'"""
ORACLE["s9_union_hot_cold"] = _with(_BR) + f"\nSELECT {_BCOLS} FROM bronze"
ORACLE["s10_publish_events"] = _with(_BR) + """
SELECT parcel_id AS key, event_id, event_ts, sequence_no FROM bronze"""


# -- the reference's 81 data tests -------------------------------------------------
# Models as CTEs named like the tables, then one result row per test.

_COURIER_ATTRS = ["sample_route_id", "last_seen_ts"]
_MERCHANT_ATTRS = ["service_tier", "promised_window_start", "promised_window_end", "last_seen_ts"]
MODEL_SQL = [
    f"parcel_events AS ({BRONZE_SQL})",
    silver_ctes(),
    silver_ctes("snap_s1", SNAP1_AS_OF, DAYS),
    "silver_parcel_events AS (SELECT * FROM silver)",
    f"silver_parcel_latest AS ({_latest_all('silver')})",
    DEPOT_VISITS_CTE, ETA_CTE, ATTEMPTS_CTE,
    "fact_depot_visits AS (SELECT * FROM depot_visits)",
    "fact_eta_events AS (SELECT * FROM eta_events)",
    "fact_parcel_delivery_attempts AS (SELECT * FROM attempts)",
    f"""fact_parcel_deliveries AS (
  SELECT event_id, parcel_id, route_id, courier_id, attempt_number, outcome, failure_reason, delivered_ts, event_date
  FROM silver WHERE {_window_where()} AND event_type = 'DELIVERED' AND delivered_ts IS NOT NULL)""",
    *_snap_fragments(STG_COURIER, "courier_id", ["sample_route_id"], _COURIER_ATTRS, "c_", "snap_s1", "silver"),
    *_snap_fragments(STG_MERCHANT, "merchant_id", ["service_tier", "promised_window_start", "promised_window_end"],
                     _MERCHANT_ATTRS, "m_", "snap_s1", "silver"),
    "dim_courier AS (SELECT * FROM c_snap WHERE dbt_valid_to IS NULL)",
    "dim_merchant AS (SELECT * FROM m_snap WHERE dbt_valid_to IS NULL)",
    """dim_depot AS (SELECT depot_id, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts,
  COUNT(*) FILTER (WHERE event_type = 'SCAN_IN_DEPOT') AS scan_in_count,
  COUNT(*) FILTER (WHERE event_type = 'SCAN_OUT_DEPOT') AS scan_out_count
  FROM silver WHERE depot_id IS NOT NULL GROUP BY depot_id)""",
    """dim_route AS (SELECT route_id AS route_sk, route_id, min(event_ts) AS first_seen_ts,
  max(event_ts) AS last_seen_ts, COUNT(*) AS event_count FROM silver WHERE route_id IS NOT NULL GROUP BY route_id)""",
    """dim_exception_code AS (SELECT exception_code, min(stage_hint) AS stage_hint_example, COUNT(*) AS occurrences
  FROM silver WHERE exception_code IS NOT NULL GROUP BY exception_code)""",
    """dim_service_tier AS (SELECT service_tier AS service_tier_sk, service_tier,
  min(promised_window_start) AS sample_promised_start, min(promised_window_end) AS sample_promised_end
  FROM silver WHERE service_tier IS NOT NULL GROUP BY service_tier)""",
    """vw_depot_dwell_p95 AS (SELECT event_date, depot_id, quantile_disc(dwell_minutes, 0.95) AS depot_dwell_p95_min
  FROM depot_visits GROUP BY event_date, depot_id)""",
    """vw_eta_error_p95 AS (SELECT CAST(generated_ts AS DATE) AS event_date, depot_id, courier_id, merchant_id,
  quantile_disc(abs(date_sub('minute', predicted_delivery_ts, first_planned_eta_ts)), 0.95) AS eta_p95_error_min
  FROM eta_events WHERE event_ts IS NOT NULL AND predicted_delivery_ts IS NOT NULL
  GROUP BY CAST(generated_ts AS DATE), depot_id, courier_id, merchant_id)""",
    """vw_first_attempt_success AS (SELECT parcel_id, min(depot_id) AS depot_id, min(courier_id) AS courier_id,
  min(merchant_id) AS merchant_id, min(COALESCE(CAST(attempt_ts AS DATE), event_date)) AS event_date,
  CAST(MAX(CASE WHEN UPPER(outcome) = 'DELIVERED' THEN 1 ELSE 0 END) AS INTEGER) AS delivered_any,
  CAST(MAX(CASE WHEN attempt_number = 1 AND UPPER(outcome) = 'DELIVERED' THEN 1 ELSE 0 END) AS INTEGER)
    AS first_attempt_success
  FROM attempts GROUP BY parcel_id)""",
]

# Output columns of each model, as the model SQL defines them.
MODEL_COLUMNS = {
    "parcel_events": BRONZE_COLUMNS,
    "silver_parcel_events": SILVER_COLS,
    "silver_parcel_latest": SILVER_COLS,
    "fact_depot_visits": ["parcel_id", "depot_id", "in_depot_ts", "out_depot_ts", "dwell_minutes", "event_date"],
    "fact_eta_events": ["event_id", "parcel_id", "route_id", "depot_id", "courier_id", "merchant_id", "source",
                        "first_planned_eta_ts", "predicted_delivery_ts", "generated_ts", "event_ts", "event_date"],
    "fact_parcel_deliveries": ["event_id", "parcel_id", "route_id", "courier_id", "attempt_number", "outcome",
                               "failure_reason", "delivered_ts", "event_date"],
    "fact_parcel_delivery_attempts": ["event_id", "parcel_id", "route_id", "courier_id", "depot_id", "merchant_id",
                                      "attempt_number", "outcome", "failure_reason", "attempt_ts", "event_date"],
    "dim_courier": ["courier_id"] + _COURIER_ATTRS + ["dbt_valid_from", "dbt_valid_to"],
    "dim_merchant": ["merchant_id"] + _MERCHANT_ATTRS + ["dbt_valid_from", "dbt_valid_to"],
    "dim_depot": ["depot_id", "first_seen_ts", "last_seen_ts", "scan_in_count", "scan_out_count"],
    "dim_route": ["route_sk", "route_id", "first_seen_ts", "last_seen_ts", "event_count"],
    "dim_exception_code": ["exception_code", "stage_hint_example", "occurrences"],
    "dim_service_tier": ["service_tier_sk", "service_tier", "sample_promised_start", "sample_promised_end"],
    "vw_depot_dwell_p95": ["event_date", "depot_id", "depot_dwell_p95_min"],
    "vw_eta_error_p95": ["event_date", "depot_id", "courier_id", "merchant_id", "eta_p95_error_min"],
    "vw_first_attempt_success": ["parcel_id", "depot_id", "courier_id", "merchant_id", "event_date",
                                 "delivered_any", "first_attempt_success"],
}


def _suite_sql(checks) -> str:
    import re
    words = {"cast", "as", "string", "concat", "coalesce"}
    rows = []
    for c in checks:
        cols = MODEL_COLUMNS[c.model]
        msg, fsql = None, None
        if c.kind in ("not_null", "accepted_values", "relationships") and c.column not in cols:
            msg = f"missing column {c.column}"
        elif c.kind == "unique":
            ids = [n for n in re.findall(r"[A-Za-z_][A-Za-z0-9_]*", re.sub(r"'[^']*'", "", c.column))
                   if n.lower() not in words and n not in cols]
            if ids:
                msg = f"missing column {ids[0]}"
        elif c.kind == "relationships" and (c.field or c.column) not in MODEL_COLUMNS.get(c.to, []):
            msg = f"missing parent {c.to}.{c.field}"
        if msg is None:
            m, col = c.model, c.column
            if c.kind == "not_null":
                fsql = f"SELECT count(*) FROM {m} WHERE {col} IS NULL"
            elif c.kind == "unique":
                fsql = (f"SELECT count(*) FROM (SELECT {col} AS v FROM {m}) t WHERE v IS NOT NULL "
                        f"GROUP BY v HAVING count(*) > 1")
                fsql = f"SELECT count(*) FROM ({fsql}) u"
            elif c.kind == "accepted_values":
                vals = ", ".join(f"'{v}'" if c.quote else str(v) for v in c.values)
                fsql = f"SELECT count(DISTINCT {col}) FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
            else:
                f = c.field or col
                fsql = (f"SELECT count(*) FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN "
                        f"(SELECT {f} FROM {c.to} WHERE {f} IS NOT NULL)")
        rows.append(_res(c.name, c.model, c.kind, c.column, c.severity, fsql, msg))
    return _with(*MODEL_SQL) + "\n" + "\nUNION ALL\n".join(rows)


def _reference_suite_sql() -> str:
    from .plans.suite import REFERENCE_TESTS
    return _suite_sql(REFERENCE_TESTS)


ORACLE["e8_reference_suite"] = _reference_suite_sql()
