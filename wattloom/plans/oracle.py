"""The telemetry plan once more, as SQL for a single-node engine to hold the results against."""

from __future__ import annotations

from wattloom.plans.telemetry import AS_OF

ARRIVALS = """
e AS (SELECT event_id AS event_no, ts AS event_time, user_id AS u, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
n AS (SELECT *, sum(CASE WHEN kind = 'signup' THEN 1 ELSE 0 END) OVER w AS starts, row_number() OVER w AS nth,
  CASE WHEN kind = 'signup' THEN 'SESSION_START' WHEN kind = 'click' THEN 'METER_UPDATE' WHEN kind = 'view' THEN 'HEARTBEAT' WHEN kind = 'purchase' THEN 'SESSION_STOP' WHEN k < 80 THEN 'FAULT_ALERT' ELSE 'STATUS_CHANGE' END AS event_type
  FROM e WINDOW w AS (PARTITION BY u ORDER BY event_time, event_no)),
arr AS (SELECT 'evt-' || event_no AS event_id, event_no, c.copy AS copy, event_type, event_time, event_time + INTERVAL 1 SECOND AS ingest_time, event_time + to_seconds(CASE WHEN k < 90 THEN k ELSE k * 10 END) AS received_at,
  'ST-' || (u % 20) AS station_id, CAST(u AS VARCHAR) AS connector_id, 'OP-' || (u % 20 % 3) AS operator_id,
  CASE WHEN event_type <> 'HEARTBEAT' AND starts > 0 THEN u || '-' || CAST((starts + 1) // 2 AS BIGINT) END AS session_id,
  CAST(greatest(0, nth - CASE WHEN k % 10 = 0 THEN 3 ELSE 0 END) AS BIGINT) AS sequence_no,
  CASE WHEN k % 11 <> 0 THEN 'C' || (u % 20 % 6) END AS city, 'X' || (u % 20 % 2) AS country,
  CASE WHEN event_type = 'SESSION_START' THEN value * 2 END AS initial_meter_kwh,
  CASE WHEN event_type = 'SESSION_START' AND k % 3 > 0 THEN 'T' || (k % 3) END AS tariff_id,
  CASE WHEN event_type = 'SESSION_START' AND k % 3 = 1 THEN 0.3::DOUBLE WHEN event_type = 'SESSION_START' AND k % 3 = 2 THEN 0.45::DOUBLE END AS tariff_eur_per_kwh,
  CASE WHEN event_type = 'SESSION_START' AND k % 5 > 0 OR event_type = 'SESSION_STOP' AND k % 7 = 0 THEN 'B' || (k % 4) END AS vehicle_brand,
  CASE WHEN event_type = 'METER_UPDATE' THEN CASE WHEN k % 29 = 0 THEN -1.0::DOUBLE ELSE value * 2 END END AS meter_kwh,
  CASE WHEN event_type = 'METER_UPDATE' THEN CASE WHEN k % 31 = 0 THEN -1.0::DOUBLE ELSE value / 10 END END AS energy_delta_kwh,
  CASE WHEN event_type = 'METER_UPDATE' AND k % 13 <> 0 THEN value END AS power_kw,
  CASE WHEN event_type = 'SESSION_STOP' THEN value * 3 END AS final_meter_kwh,
  CASE WHEN event_type = 'SESSION_STOP' AND k % 2 = 0 THEN value END AS total_energy_kwh,
  CASE WHEN event_type = 'SESSION_STOP' THEN 'reason' || (k % 3) END AS end_reason,
  CASE WHEN event_type = 'FAULT_ALERT' THEN 'F' || (k % 5) END AS fault_code,
  CASE WHEN event_type = 'FAULT_ALERT' THEN CASE WHEN k % 2 = 0 THEN 'high' ELSE 'low' END END AS severity,
  CASE WHEN event_type = 'STATUS_CHANGE' THEN CASE WHEN k % 23 = 0 THEN '' ELSE 'charging' END END AS previous_status,
  CASE WHEN event_type = 'STATUS_CHANGE' THEN CASE WHEN k % 2 = 0 THEN ' Faulted ' ELSE 'available' END END AS new_status,
  CASE WHEN event_type = 'STATUS_CHANGE' AND k % 3 > 0 THEN 'overheat' END AS reason,
  CASE WHEN event_type = 'HEARTBEAT' THEN CASE WHEN k % 37 = 0 THEN '' WHEN k % 4 = 0 THEN 'degraded' ELSE 'available' END END AS charger_status
  FROM n JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c ON c.copy = 0 OR event_no % 50 = 0)"""

ADMITTED = ARRIVALS + """,
adm0 AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_time, event_no, copy) > 1 AS duplicate,
  list_filter([
    CASE WHEN event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') AND coalesce(session_id, '') = '' THEN 'session_id is required for ' || event_type END,
    CASE WHEN event_type = 'SESSION_START' AND initial_meter_kwh < 0 THEN 'SESSION_START payload.initial_meter_kwh must be non-negative' END,
    CASE WHEN event_type = 'SESSION_START' AND tariff_eur_per_kwh < 0 THEN 'SESSION_START payload.tariff_eur_per_kwh must be non-negative' END,
    CASE WHEN event_type = 'METER_UPDATE' AND sequence_no <= 0 THEN 'METER_UPDATE sequence_no must be > 0' END,
    CASE WHEN event_type = 'METER_UPDATE' AND meter_kwh < 0 THEN 'METER_UPDATE payload.meter_kwh must be non-negative' END,
    CASE WHEN event_type = 'METER_UPDATE' AND energy_delta_kwh < 0 THEN 'METER_UPDATE payload.energy_delta_kwh must be non-negative' END,
    CASE WHEN event_type = 'METER_UPDATE' AND power_kw < 0 THEN 'METER_UPDATE payload.power_kw must be non-negative' END,
    CASE WHEN event_type = 'SESSION_STOP' AND final_meter_kwh < 0 THEN 'SESSION_STOP payload.final_meter_kwh must be non-negative' END,
    CASE WHEN event_type = 'SESSION_STOP' AND total_energy_kwh < 0 THEN 'SESSION_STOP payload.total_energy_kwh must be non-negative' END,
    CASE WHEN event_type = 'HEARTBEAT' AND coalesce(charger_status, '') = '' THEN 'HEARTBEAT payload.charger_status must be non-empty' END,
    CASE WHEN event_type = 'STATUS_CHANGE' AND (coalesce(previous_status, '') = '' OR coalesce(new_status, '') = '') THEN 'STATUS_CHANGE previous_status and new_status must be non-empty' END,
    CASE WHEN event_type = 'FAULT_ALERT' AND coalesce(fault_code, '') = '' THEN 'FAULT_ALERT payload.fault_code must be non-empty' END,
    CASE WHEN event_type = 'FAULT_ALERT' AND coalesce(severity, '') = '' THEN 'FAULT_ALERT payload.severity must be non-empty' END], lambda x: x IS NOT NULL) AS errors,
  CAST(greatest(0, floor((epoch_us(received_at) - epoch_us(event_time)) / 1000000)) AS BIGINT) AS lateness_seconds FROM arr),
adm AS (SELECT *, CASE WHEN lateness_seconds <= 0 THEN 'on_time' WHEN lateness_seconds <= 600 THEN 'accepted_late' ELSE 'too_late_rejected' END AS lateness, NOT duplicate AND len(errors) = 0 AND lateness_seconds <= 600 AS candidate FROM adm0)"""

VERDICTS = ADMITTED + """,
v0 AS (SELECT *, coalesce(nullif(session_id, ''), chr(1) || event_id) AS session_key, coalesce(session_id, '') <> '' AS has, event_type = 'SESSION_START' AS is_start,
  event_type IN ('SESSION_STOP', 'FAULT_ALERT') OR event_type = 'STATUS_CHANGE' AND lower(trim(new_status)) = 'faulted' AS closes FROM adm),
v1 AS (SELECT *, coalesce(last_value(CASE WHEN candidate AND has AND is_start THEN 1 WHEN candidate AND has AND closes THEN 0 END IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY event_time, event_no, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS active FROM v0),
v2 AS (SELECT *, list_concat(errors, list_filter([CASE WHEN is_start AND active THEN 'SESSION_START received for already-active session_id' END, CASE WHEN event_type = 'SESSION_STOP' AND has AND NOT active THEN 'SESSION_STOP without active session context is invalid' END], lambda x: x IS NOT NULL)) AS all_errors FROM v1),
v3 AS (SELECT *, candidate AND len(all_errors) = 0 AS accepted FROM v2),
v4 AS (SELECT *, accepted AND is_start AND has AS opens, accepted AND has AND closes AND active AS ends FROM v3),
v5 AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY session_key ORDER BY event_time, event_no, copy ROWS UNBOUNDED PRECEDING) AS epoch FROM v4),
v6 AS (SELECT *, max(CASE WHEN opens OR accepted AND event_type = 'METER_UPDATE' AND active THEN sequence_no END) OVER (PARTITION BY session_key, epoch ORDER BY event_time, event_no, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_sequence FROM v5),
v7 AS (SELECT *, coalesce(accepted AND event_type = 'METER_UPDATE' AND active AND sequence_no > last_sequence, false) AS metered FROM v6),
v AS (SELECT *, opens OR ends OR metered AS applied,
  CASE WHEN NOT accepted THEN CASE WHEN duplicate THEN 'duplicate' WHEN len(all_errors) > 0 THEN 'invalid' ELSE 'too_late' END WHEN opens THEN 'session_started' WHEN metered THEN 'session_meter_updated'
    WHEN ends THEN CASE WHEN event_type = 'SESSION_STOP' THEN 'normal_stop' ELSE 'fault_termination' END WHEN event_type = 'METER_UPDATE' THEN CASE WHEN NOT active THEN 'session_not_found' ELSE 'non_increasing_sequence' END
    WHEN has AND closes THEN 'session_not_found' ELSE 'no_session_mutation_for_event_type' END AS outcome,
  CASE WHEN duplicate THEN NULL WHEN event_type = 'METER_UPDATE' AND has AND NOT active THEN 'METER_UPDATE without active session context; keep historical only' WHEN event_type = 'METER_UPDATE' AND has AND NOT sequence_no > last_sequence THEN 'METER_UPDATE sequence_no is not increasing; keep historical only' END AS warning FROM v7)"""

FACTS = VERDICTS + f""",
snap AS (SELECT session_id, epoch, max(CASE WHEN opens THEN operator_id END) AS operator_id, max(CASE WHEN opens THEN station_id END) AS station_id, max(CASE WHEN opens THEN connector_id END) AS connector_id, max(CASE WHEN opens THEN city END) AS city, max(CASE WHEN opens THEN country END) AS country,
  max(CASE WHEN opens THEN event_time END) AS started_at, max(CASE WHEN opens THEN event_id END) AS start_event_id, max(CASE WHEN ends THEN event_id END) AS stop_event_id,
  coalesce(max(CASE WHEN ends AND event_type = 'SESSION_STOP' THEN vehicle_brand END), max(CASE WHEN opens THEN vehicle_brand END)) AS vehicle_brand, coalesce(max(CASE WHEN opens THEN tariff_id END), 'default') AS tariff_id, coalesce(max(CASE WHEN opens THEN tariff_eur_per_kwh END), 0.35::DOUBLE) AS tariff,
  max(event_time) AS last_event_time, count(CASE WHEN metered THEN 1 END) AS meter_update_count, coalesce(max(CASE WHEN ends AND event_type = 'SESSION_STOP' THEN total_energy_kwh END), sum(CASE WHEN metered THEN energy_delta_kwh END), 0) AS energy,
  sum(CASE WHEN metered AND power_kw >= 0 THEN power_kw END) AS power_sum, count(CASE WHEN metered AND power_kw >= 0 THEN 1 END) AS power_samples, coalesce(max(CASE WHEN metered AND power_kw >= 0 THEN power_kw END), 0) AS power_max,
  max(CASE WHEN ends THEN CASE WHEN event_type = 'SESSION_STOP' THEN end_reason WHEN event_type = 'FAULT_ALERT' THEN 'fault:' || fault_code ELSE 'status_fault:' || coalesce(nullif(reason, ''), 'status_change') END END) AS stop_reason0,
  max(CASE WHEN ends THEN CASE WHEN event_type = 'SESSION_STOP' THEN 'normal_stop' ELSE 'fault_termination' END END) AS reason0 FROM v WHERE applied GROUP BY session_id, epoch),
fin AS (SELECT *, coalesce(reason0, 'inactivity_timeout') AS finalized_reason, coalesce(stop_reason0, reason0, 'inactivity_timeout') AS stop_reason, CAST(greatest(0, floor((epoch_us(last_event_time) - epoch_us(started_at)) / 1000000)) AS BIGINT) AS duration_seconds, greatest(0.0::DOUBLE, energy) AS energy_kwh_total FROM snap WHERE reason0 IS NOT NULL OR last_event_time <= TIMESTAMP '{AS_OF}' - INTERVAL 900 SECOND),
fact_sessions AS (SELECT session_id, operator_id, station_id, connector_id, started_at AS session_start_time, greatest(started_at, last_event_time) AS session_end_time, city AS location_city, country AS location_country, vehicle_brand, tariff_id, duration_seconds, energy_kwh_total, round(energy_kwh_total * greatest(0.0::DOUBLE, tariff), 6) AS revenue_eur_total, meter_update_count, greatest(0.0::DOUBLE, power_max) AS peak_power_kw,
  greatest(0.0::DOUBLE, CASE WHEN power_samples > 0 THEN power_sum / power_samples WHEN duration_seconds > 0 THEN energy_kwh_total / (duration_seconds / 3600.0::DOUBLE) ELSE 0 END) AS avg_power_kw,
  CASE finalized_reason WHEN 'normal_stop' THEN 'completed' WHEN 'inactivity_timeout' THEN 'timeout' WHEN 'fault_termination' THEN 'fault_terminated' ELSE 'incomplete' END AS session_completion_status, CASE finalized_reason WHEN 'fault_termination' THEN 'faulted' WHEN 'normal_stop' THEN 'available' ELSE 'unknown' END AS final_station_status, stop_reason,
  CASE WHEN finalized_reason = 'normal_stop' THEN 1 ELSE 0 END AS is_complete, CASE WHEN finalized_reason = 'inactivity_timeout' THEN 1 ELSE 0 END AS is_timeout_finalized, CASE WHEN hour(started_at) BETWEEN 16 AND 21 THEN 1 ELSE 0 END AS peak_hour_flag,
  CASE WHEN energy_kwh_total > 0 THEN round(energy_kwh_total * greatest(0.0::DOUBLE, tariff), 6) / energy_kwh_total ELSE 0 END AS revenue_per_kwh, start_event_id, stop_event_id, finalized_reason FROM fin),
raw_events AS (SELECT * FROM v WHERE accepted)"""

ROLLUPS = FACTS + """,
counted AS (SELECT *, greatest(0, sum(CASE WHEN opens THEN 1 WHEN ends THEN -1 ELSE 0 END) OVER (PARTITION BY station_id ORDER BY event_time, event_no, copy ROWS UNBOUNDED PRECEDING)) AS active_sessions FROM raw_events),
sm_rows AS (SELECT date_trunc('minute', c.event_time) AS bucket_minute, c.operator_id, c.station_id, c.city, c.country, 0 AS later, c.event_time AS t, c.event_no AS no, c.copy AS cp, 1 AS one, (event_type = 'METER_UPDATE')::INT AS m, (event_type = 'SESSION_START')::INT AS s, (event_type = 'SESSION_STOP')::INT AS e, (event_type = 'FAULT_ALERT')::INT AS f, (event_type = 'HEARTBEAT')::INT AS h,
    CASE WHEN metered THEN greatest(0.0::DOUBLE, energy_delta_kwh) ELSE 0 END AS energy, CASE WHEN metered THEN greatest(0.0::DOUBLE, energy_delta_kwh) * greatest(0.0::DOUBLE, tariff) ELSE 0 END AS revenue, CASE WHEN metered AND power_kw IS NOT NULL THEN greatest(0.0::DOUBLE, power_kw) END AS power, CASE WHEN metered AND power_kw IS NOT NULL THEN greatest(0.0::DOUBLE, power_kw) END AS peak, active_sessions AS o
  FROM counted c LEFT JOIN snap ON snap.session_id = c.session_key AND snap.epoch = c.epoch
  UNION ALL SELECT date_trunc('minute', session_end_time), operator_id, station_id, location_city, location_country, 1, session_end_time, 0, 0, 0, 0, 0, CASE WHEN finalized_reason = 'normal_stop' THEN 0 ELSE 1 END, 0, 0, 0, 0, NULL, peak_power_kw, 0 FROM fact_sessions),
agg_station_minute AS (SELECT bucket_minute, operator_id, station_id, (arg_min({'a': city}, (later, t, no, cp))).a AS city, (arg_min({'a': country}, (later, t, no, cp))).a AS country_code, CAST(sum(one) AS BIGINT) AS events_total, CAST(sum(m) AS BIGINT) AS meter_update_count, CAST(sum(s) AS BIGINT) AS session_start_count, CAST(sum(e) AS BIGINT) AS session_stop_count, CAST(sum(f) AS BIGINT) AS fault_count, CAST(sum(h) AS BIGINT) AS heartbeat_count,
  round(sum(energy), 6) AS energy_kwh_sum, round(sum(revenue), 6) AS revenue_eur_sum, round(coalesce(avg(power), 0), 6) AS avg_power_kw, round(greatest(0.0::DOUBLE, coalesce(max(peak), 0)), 6) AS max_power_kw, CAST(max(o) AS BIGINT) AS active_connector_estimate FROM sm_rows GROUP BY bucket_minute, operator_id, station_id),
agg_operator_hour AS (SELECT bucket_hour, operator_id, round(sum(energy), 6) AS energy_kwh_sum, round(sum(revenue), 6) AS revenue_eur_sum, CAST(sum(done) AS BIGINT) AS sessions_completed, CAST(sum(undone) AS BIGINT) AS sessions_incomplete, CAST(sum(fault) AS BIGINT) AS fault_count, count(DISTINCT station_id) AS distinct_station_count, round(coalesce(avg(duration), 0), 6) AS avg_session_duration_seconds FROM (
  SELECT date_trunc('hour', session_end_time) AS bucket_hour, operator_id, station_id, energy_kwh_total AS energy, revenue_eur_total AS revenue, is_complete AS done, 1 - is_complete AS undone, 0 AS fault, duration_seconds AS duration FROM fact_sessions
  UNION ALL SELECT date_trunc('hour', event_time), operator_id, station_id, 0, 0, 0, 0, 1, NULL FROM raw_events WHERE event_type = 'FAULT_ALERT') GROUP BY bucket_hour, operator_id),
faults AS (SELECT CAST(event_time AS DATE) AS bucket_day, operator_id, coalesce(nullif(country, ''), 'unknown') AS country_code, coalesce(nullif(city, ''), 'unknown') AS city, station_id, coalesce(nullif(fault_code, ''), 'unknown') AS code FROM raw_events WHERE event_type = 'FAULT_ALERT'),
agg_city_day_faults AS (SELECT f.bucket_day, f.operator_id, f.country_code, f.city, count(*) AS fault_count, count(DISTINCT station_id) AS distinct_station_count, any_value(m.code) AS most_common_fault_code FROM faults f
  JOIN (SELECT bucket_day, operator_id, country_code, city, code, row_number() OVER (PARTITION BY bucket_day, operator_id, country_code, city ORDER BY n DESC, code DESC) AS r FROM (SELECT bucket_day, operator_id, country_code, city, code, count(*) AS n FROM faults GROUP BY bucket_day, operator_id, country_code, city, code)) m ON m.r = 1 AND m.bucket_day = f.bucket_day AND m.operator_id = f.operator_id AND m.country_code = f.country_code AND m.city = f.city GROUP BY f.bucket_day, f.operator_id, f.country_code, f.city)"""


def over(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"
