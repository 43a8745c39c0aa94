"""Oracle SQL for the ingestion and publish queries."""

from loadlens.plans.oracle import (BAND, BOUNDS, CLEAN, DAILY_OBS, DUPS, GAPS, LEDGER, MISSING, SPINE, WIDE, HALF, HOURLY_QUALITY, OBS, OBS_HOUR, ORDERS_OBS, SQL,
                                   TOLERANT, _avg, _marks, with_)

Q15 = f"""q15 AS (
  SELECT date_trunc('hour', time_utc) + to_minutes(CAST(minute(time_utc) // 15 * 15 AS BIGINT)) AS time_utc,
         country_code, bidding_zone, {_avg('load_mw')} AS load_mw
  FROM obs WHERE load_mw IS NOT NULL AND load_mw >= 0 GROUP BY 1, 2, 3)"""

RULE = """CASE WHEN bidding_zone = 'Z0' THEN 'PT60M' WHEN bidding_zone = 'Z1' THEN 'PT15M'
            WHEN day(time_utc) % 2 = 1 THEN 'PT60M' ELSE 'PT15M' END"""

POINTS = f"""points AS (
  SELECT time_utc, country_code, bidding_zone, load_mw, 'PT60M' AS resolution
  FROM clean WHERE {RULE} = 'PT60M'
  UNION ALL
  SELECT time_utc, country_code, bidding_zone, load_mw, 'PT15M' AS resolution
  FROM q15 WHERE {RULE} = 'PT15M')"""

PERIODS = """periods AS (
  SELECT DISTINCT country_code, bidding_zone, date_trunc('day', time_utc) AS period_start, resolution,
         CASE resolution WHEN 'PT60M' THEN 60 ELSE 15 END AS step_minutes
  FROM points)"""

LANDED = [OBS, CLEAN, Q15, POINTS, PERIODS]

SQL["ingest_xml_points"] = with_(*LANDED) + \
    "SELECT time_utc, country_code, bidding_zone, load_mw FROM points"

SQL["resolution_step"] = with_(*LANDED) + "SELECT * FROM periods"

SQL["resolutions_seen"] = with_(*LANDED) + """
SELECT country_code, bidding_zone,
       nullif(array_to_string(list_sort(list_distinct(list(resolution))), ','), '') AS resolution_detected
FROM periods GROUP BY 1, 2"""

SQL["run_stats"] = with_(*LANDED) + """
SELECT p.country_code, p.bidding_zone, p.rows_seen, p.min_event_time_utc, p.max_event_time_utc,
       s.source_timeseries_count
FROM (SELECT country_code, bidding_zone, COUNT(*) AS rows_seen, MIN(time_utc) AS min_event_time_utc,
             MAX(time_utc) AS max_event_time_utc FROM points GROUP BY 1, 2) p
JOIN (SELECT country_code, bidding_zone, COUNT(*) AS source_timeseries_count FROM periods GROUP BY 1, 2) s
  USING (country_code, bidding_zone)"""

REQUESTS = """requests AS (
  SELECT country_code, bidding_zone, strftime(MIN(time_utc), '%Y-%m-%d') AS start_date,
         strftime(MAX(time_utc), '%Y-%m-%d') AS end_date,
         'load_batch_ingestion' AS pipeline_name
  FROM {src} GROUP BY 1, 2),
windows AS (
  SELECT *, CAST(strptime(start_date, '%Y-%m-%d') AS TIMESTAMP) AS requested_start_utc,
         CAST(strptime(end_date, '%Y-%m-%d') AS TIMESTAMP) + INTERVAL 23 HOUR AS requested_end_utc
  FROM requests)"""

EFFECTIVE = """effective AS (
  SELECT w.*, m.last_ingested_at_utc,
         greatest(w.requested_start_utc,
                  coalesce(m.last_ingested_at_utc + INTERVAL {step}, w.requested_start_utc))
           AS effective_start_utc,
         w.requested_end_utc AS effective_end_utc
  FROM windows w LEFT JOIN {marks} m USING (pipeline_name, country_code, bidding_zone))"""

SQL["request_window"] = with_(OBS, OBS_HOUR, REQUESTS.format(src="obs_hour")) + "SELECT * FROM windows"

SQL["effective_window"] = with_(OBS, OBS_HOUR, REQUESTS.format(src="obs_hour"), _marks("marks", HALF),
                                EFFECTIVE.format(step="1 HOUR", marks="marks")) + "SELECT * FROM effective"

SQL["noop_runs"] = with_(OBS, OBS_HOUR, REQUESTS.format(src="obs_hour"), _marks("marks", "TRUE"),
                         EFFECTIVE.format(step="1 HOUR", marks="marks")) + """
SELECT sha256(concat_ws('|', pipeline_name, country_code, bidding_zone,
                        CAST(effective_start_utc AS VARCHAR))) AS run_id,
       pipeline_name, 'actual_total_load' AS source_name, country_code, bidding_zone,
       effective_start_utc AS requested_start_utc, effective_end_utc AS requested_end_utc,
       TIMESTAMP '2025-06-01 00:00:00' AS started_at_utc, TIMESTAMP '2025-06-01 00:00:00' AS finished_at_utc,
       'success' AS status, 0 AS rows_seen, 0 AS rows_inserted,
       CAST(NULL AS TIMESTAMP) AS min_event_time_utc, CAST(NULL AS TIMESTAMP) AS max_event_time_utc,
       CAST(NULL AS VARCHAR) AS resolution_detected, 0 AS source_timeseries_count,
       CAST(NULL AS VARCHAR) AS error_message, 1 AS event_seq
FROM effective WHERE effective_start_utc > effective_end_utc"""

ORDER_MARKS = """order_marks AS (
  SELECT 'load_batch_ingestion' AS pipeline_name, o_orderpriority AS country_code,
         o_orderstatus AS bidding_zone, MAX(o_orderdate) AS last_ingested_at_utc
  FROM orders WHERE 2 * o_orderkey < (SELECT COUNT(*) FROM orders) GROUP BY 2, 3)"""

SQL["quarter_chunks"] = with_(ORDERS_OBS, REQUESTS.format(src="orders_obs"), ORDER_MARKS,
                              EFFECTIVE.format(step="1 DAY", marks="order_marks"), """quarters AS (
  SELECT *, unnest(generate_series(date_trunc('quarter', effective_start_utc), effective_end_utc,
                                   INTERVAL 3 MONTH)) AS quarter_start
  FROM effective WHERE effective_start_utc <= effective_end_utc)""", """chunks AS (
  SELECT pipeline_name, country_code, bidding_zone, effective_start_utc, effective_end_utc,
         greatest(quarter_start, effective_start_utc) AS chunk_start_utc,
         least(quarter_start + INTERVAL 3 MONTH - INTERVAL 1 HOUR, effective_end_utc) AS chunk_end_utc
  FROM quarters)""") + """
SELECT *, strftime(chunk_start_utc, '%Y%m%d%H%M') AS period_start,
       strftime(chunk_end_utc + INTERVAL 1 HOUR, '%Y%m%d%H%M') AS period_end
FROM chunks"""

_DAILY = f"""
SELECT country_code, bidding_zone, CAST(time_utc AS DATE) AS load_date,
       {_avg('load_mw')} AS avg_load_mw, MAX(load_mw) AS peak_load_mw, MIN(load_mw) AS min_load_mw,
       COUNT(*) AS hourly_points
FROM clean GROUP BY 1, 2, 3"""

SQL["publish_select"] = with_(OBS, CLEAN) + "SELECT * FROM clean ORDER BY time_utc"
SQL["publish_roundtrip"] = with_(OBS, CLEAN) + _DAILY
SQL["stg_clean"] = with_(OBS, CLEAN) + "SELECT * FROM clean"
SQL["stg_assertions"] = with_(*HOURLY_QUALITY, TOLERANT) + "SELECT * FROM assertions"

# ------------------------------------------------------------------ streaming (batch equivalents)

SQL["stream_clean_hourly"] = with_(OBS, CLEAN) + "SELECT * FROM clean"
SQL["stream_late_hours"] = SQL["stream_clean_hourly"]
SQL["stream_xml_points"] = SQL["ingest_xml_points"]
SQL["stream_dedupe_keys"] = with_(OBS, OBS_HOUR) + \
    """SELECT time_utc, country_code, bidding_zone, arg_min(load_mw, event_id) AS load_mw, min(event_id) AS event_id
FROM obs_hour GROUP BY ALL"""
SQL["stream_time_gaps"] = "WITH " + OBS + """, lagged AS (
  SELECT country_code, bidding_zone, time_utc,
         LAG(time_utc) OVER (PARTITION BY country_code, bidding_zone ORDER BY time_utc) AS previous_time
  FROM obs)
SELECT country_code, bidding_zone, previous_time, time_utc,
       (epoch_us(time_utc) - epoch_us(previous_time)) // 1000000 AS gap_seconds
FROM lagged
WHERE previous_time IS NOT NULL AND epoch_us(time_utc) - epoch_us(previous_time) > 3600000000"""

SQL["zone_metrics_published"] = SQL["zone_metrics"]

SQL["reconciliation_by_zone"] = with_(OBS, OBS_HOUR, CLEAN, BOUNDS.format(src="clean"),
                                      SPINE.format(step="1 HOUR", col="expected_time"),
                                      MISSING.format(src="clean"), DUPS, LEDGER, """span AS (
  SELECT country_code, bidding_zone,
         CAST(round(date_diff('second', MIN(time_utc), MAX(time_utc)) / 3600.0 + 1) AS BIGINT) AS expected_hours,
         COUNT(DISTINCT time_utc) AS actual_hours
  FROM clean GROUP BY 1, 2)""", """miss AS (
  SELECT country_code, bidding_zone, COUNT(*) AS missing_hours FROM missing GROUP BY 1, 2)""", """dz AS (
  SELECT country_code, bidding_zone, COUNT(*) AS duplicate_rows FROM dups GROUP BY 1, 2)""", """lz AS (
  SELECT country_code, bidding_zone, run_id AS last_run_id, started_at_utc AS last_run_started_at,
         finished_at_utc AS last_run_finished_at
  FROM (SELECT *, row_number() OVER (PARTITION BY country_code, bidding_zone
                                     ORDER BY started_at_utc DESC, run_id DESC) AS rn
        FROM ledger WHERE status = 'success') WHERE rn = 1)""", """zones AS (
  SELECT country_code, bidding_zone FROM span UNION SELECT country_code, bidding_zone FROM miss
  UNION SELECT country_code, bidding_zone FROM dz UNION SELECT country_code, bidding_zone FROM lz)""") + """
SELECT z.country_code, z.bidding_zone, s.expected_hours, s.actual_hours,
       coalesce(m.missing_hours, 0) AS missing_hours, coalesce(d.duplicate_rows, 0) AS duplicate_rows,
       l.last_run_id, l.last_run_started_at, l.last_run_finished_at
FROM zones z LEFT JOIN span s USING (country_code, bidding_zone)
LEFT JOIN miss m USING (country_code, bidding_zone) LEFT JOIN dz d USING (country_code, bidding_zone)
LEFT JOIN lz l USING (country_code, bidding_zone)"""

SQL["export_ndjson_roundtrip"] = SQL["anomalies"]

SQL["ingest_incremental"] = with_(*LANDED, """zr AS (
  SELECT country_code, bidding_zone, CAST(CAST(MIN(time_utc) AS DATE) AS TIMESTAMP) AS d0
  FROM obs GROUP BY 1, 2)""") + """
SELECT p.time_utc, p.country_code, p.bidding_zone, p.load_mw, CAST(NULL AS VARCHAR) AS source,
       CASE WHEN p.time_utc < z.d0 + INTERVAL 15 DAY THEN TIMESTAMP '2025-01-01 00:00:00'
            ELSE TIMESTAMP '2025-01-02 00:00:00' END AS ingested_at
FROM points p JOIN zr z USING (country_code, bidding_zone)"""

SQL["time_gaps_published"] = with_(ORDERS_OBS, DAILY_OBS, GAPS.format(src="daily_obs", step="1 DAY")) + """
SELECT country_code, bidding_zone, previous_time, time_utc,
       CASE WHEN gap_seconds // 86400 = 1 THEN '1 day '
            WHEN gap_seconds // 86400 > 1 THEN CAST(gap_seconds // 86400 AS VARCHAR) || ' days '
            ELSE '' END
       || lpad(CAST((gap_seconds % 86400) // 3600 AS VARCHAR), 2, '0') || ':'
       || lpad(CAST((gap_seconds % 3600) // 60 AS VARCHAR), 2, '0') || ':'
       || lpad(CAST(gap_seconds % 60 AS VARCHAR), 2, '0') AS gap_interval
FROM gaps"""

SQL["published_objects"] = with_(OBS, OBS_HOUR, CLEAN, BOUNDS.format(src="clean"),
                                 SPINE.format(step="1 HOUR", col="expected_time"), MISSING.format(src="clean"),
                                 GAPS.format(src="clean", step="1 HOUR"), LEDGER, WIDE, BAND) + """
SELECT 'energy_load_raw' AS object_name, COUNT(*) AS row_count FROM obs
UNION ALL SELECT 'energy_load_clean', COUNT(*) FROM clean
UNION ALL SELECT 'pipeline_runs', COUNT(*) FROM ledger
UNION ALL SELECT 'pipeline_state', COUNT(*) FROM (SELECT DISTINCT country_code, bidding_zone FROM obs_hour)
UNION ALL SELECT 'dq_time_gaps', COUNT(*) FROM gaps
UNION ALL SELECT 'dq_missing_hours', COUNT(*) FROM missing
UNION ALL SELECT 'dq_invalid_loads', COUNT(*) FROM clean WHERE load_mw IS NULL OR load_mw < 0
UNION ALL SELECT 'dq_pipeline_status', 1
UNION ALL SELECT 'dq_reconciliation_summary', 1
UNION ALL SELECT 'dq_assertions', 3
UNION ALL SELECT 'daily_load_summary', COUNT(*) FROM (SELECT DISTINCT country_code, bidding_zone,
                                                         CAST(time_utc AS DATE) FROM clean)
UNION ALL SELECT 'hourly_load_anomalies', COUNT(label) FROM labelled
UNION ALL SELECT 'daily_load_curve_profile', COUNT(*) FROM (SELECT DISTINCT country_code, bidding_zone,
                                                               extract(hour FROM time_utc) FROM clean)
UNION ALL SELECT 'mart_energy_system_metrics', COUNT(*) FROM wide
UNION ALL SELECT 'mart_energy_system_metrics_long', 12 * COUNT(*) FROM wide"""

# ------------------------------------------------------------------ three ingest runs, one after another

SQL["quarter_chunks_full"] = with_(ORDERS_OBS) + """
SELECT country_code, bidding_zone, greatest(q, lo) AS chunk_start_utc,
       least(q + INTERVAL 3 MONTH, hi + INTERVAL 1 DAY) - INTERVAL 1 HOUR AS chunk_end_utc,
       strftime(greatest(q, lo), '%Y%m%d%H%M') AS period_start,
       strftime(least(q + INTERVAL 3 MONTH, hi + INTERVAL 1 DAY), '%Y%m%d%H%M') AS period_end
FROM (SELECT country_code, bidding_zone, lo, hi, unnest(generate_series(date_trunc('quarter', lo), hi, INTERVAL 3 MONTH)) AS q
      FROM (SELECT country_code, bidding_zone, date_trunc('day', min(time_utc)) AS lo, date_trunc('day', max(time_utc)) AS hi
            FROM orders_obs GROUP BY ALL))"""

ZONES = """zones AS (
  SELECT country_code, bidding_zone, date_trunc('day', min(time_utc)) AS first_day, date_trunc('day', max(time_utc)) AS last_day
  FROM obs GROUP BY ALL),
m0 AS (SELECT country_code, bidding_zone, CAST(NULL AS TIMESTAMP) AS mark, INTERVAL 1 HOUR AS step FROM zones)"""


def run_sql(k: int, end: str) -> str:
    """Run ``k``: its window by the mark and step that run ``k - 1`` left, and what it asks for and gets."""
    inside = ("x.country_code = w.country_code AND x.bidding_zone = w.bidding_zone AND w.s <= w.e "
              "AND x.time_utc >= w.s AND x.time_utc < w.e + INTERVAL 1 HOUR")
    near = ("x.country_code = w.country_code AND x.bidding_zone = w.bidding_zone AND w.s <= w.e "
            "AND x.period_start + INTERVAL 1 DAY > w.s AND x.period_start < w.e + INTERVAL 1 HOUR")
    return f"""w{k} AS (
  SELECT z.country_code, z.bidding_zone, greatest(z.first_day, coalesce(m.mark + m.step, z.first_day)) AS s, {end} + INTERVAL 23 HOUR AS e
  FROM zones z JOIN m{k - 1} m USING (country_code, bidding_zone)),
r{k} AS (
  SELECT w.*, TIMESTAMP '2025-01-0{k} 00:00:00' AS started, (SELECT count(*) FROM points x WHERE {inside}) AS n,
         (SELECT min(x.time_utc) FROM points x WHERE {inside}) AS lo, (SELECT max(x.time_utc) FROM points x WHERE {inside}) AS hi,
         (SELECT string_agg(DISTINCT x.resolution, ',' ORDER BY x.resolution) FROM periods x WHERE {near}) AS res,
         (SELECT count(*) FROM periods x WHERE {near}) AS series
  FROM w{k} w),
m{k} AS (
  SELECT r.country_code, r.bidding_zone, coalesce(r.hi, m.mark) AS mark,
         CASE WHEN r.res LIKE '%PT15M%' THEN INTERVAL 15 MINUTE ELSE INTERVAL 1 HOUR END AS step
  FROM r{k} r JOIN m{k - 1} m USING (country_code, bidding_zone))"""


RUNS = [*LANDED, ZONES, run_sql(1, "z.first_day + INTERVAL 6 DAY"), run_sql(2, "z.first_day + INTERVAL 13 DAY"), run_sql(3, "z.last_day"),
        "runs AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)"]

SQL["ingest_ledger"] = with_(*RUNS) + """
SELECT country_code, bidding_zone, started AS started_at_utc, 'success' AS status, s AS requested_start_utc, e AS requested_end_utc,
       CAST(n AS INTEGER) AS rows_seen, CAST(n AS INTEGER) AS rows_inserted, lo AS min_event_time_utc, hi AS max_event_time_utc,
       res AS resolution_detected, CAST(series AS INTEGER) AS source_timeseries_count
FROM runs"""

SQL["ingest_marks"] = with_(*RUNS) + """
SELECT 'load_batch_ingestion' AS pipeline_name, country_code, bidding_zone, max(hi) AS last_ingested_at_utc, max(started) AS updated_at_utc
FROM runs WHERE n > 0 GROUP BY ALL"""

SQL["ingest_first_writer"] = with_(OBS, CLEAN) + "SELECT time_utc, country_code, bidding_zone, load_mw FROM clean"

SQL["upsert_table_persisted"] = with_(OBS, OBS_HOUR) + """
SELECT time_utc, country_code, bidding_zone, arg_max(load_mw, event_id) AS load_mw, max(event_id) AS event_id
FROM obs_hour GROUP BY ALL"""

SQL["clean_hourly_labelled"] = with_(OBS) + f"""
SELECT date_trunc('hour', time_utc) AS time_utc, country_code, if(event_id % 11 = 0, NULL, bidding_zone) AS bidding_zone,
       {_avg('load_mw')} AS load_mw, coalesce(max('src' || (event_id % 7)) FILTER (WHERE event_id % 3 <> 0), 'ENTSO-E') AS source,
       max(ingested_at) AS ingested_at
FROM obs WHERE load_mw >= 0 GROUP BY 1, 2, 3"""

SQL["materialised_fact"] = SQL["daily_summary"]
SQL["bootstrap_raw"] = with_(OBS) + """
SELECT time_utc, country_code, bidding_zone, load_mw, source, TIMESTAMP '2025-01-01 00:00:00' AS ingested_at FROM obs"""

SQL["catalog_fact"] = SQL["daily_summary"]
SQL["catalog_defaults"] = with_(OBS) + """
SELECT time_utc, country_code, bidding_zone, load_mw, source, TRUE AS has_ingest_time FROM obs"""
# the first event of each key: ids of the first half are the smaller ones
SQL["bucketed_append"] = with_(OBS, OBS_HOUR) + """
SELECT time_utc, country_code, bidding_zone, arg_min(load_mw, event_id) AS load_mw, CAST(NULL AS VARCHAR) AS source,
       arg_min(ingested_at, event_id) AS ingested_at
FROM obs_hour GROUP BY time_utc, country_code, bidding_zone"""

SQL["ingest_xml_split"] = SQL["ingest_xml_points"]
SQL["missing_hours_bitmaps"] = SQL["missing_hours"]
SQL["step_counts_bitmaps"] = f"SELECT expected_hours, actual_hours, missing_hours FROM ({SQL['reconciliation']}) r"
SQL["step_counts_bitmaps_by_zone"] = f"""SELECT country_code, bidding_zone, expected_hours, actual_hours, missing_hours
FROM ({SQL['reconciliation_by_zone']}) r"""

for _layer in ("daily_summary", "curve_profile", "zone_metrics", "anomalies", "system_metrics", "system_metrics_by_zone"):
    SQL[f"incremental_{_layer}"] = SQL[_layer]
