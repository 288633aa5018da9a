"""The registered queries of the telemetry engine, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.operators import admission, generator, metrics, parse, serving
from wattloom.operators.sessions import finalized
from wattloom.plans import analytics
from wattloom.plans.oracle import ADMITTED, ARRIVALS, FACTS, ROLLUPS, VERDICTS, over
from wattloom.plans.telemetry import AS_OF, Telemetry, stored_views

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the reading engine has them."""
    return df.select(*(c(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else c(n) for n, t in df.dtypes))


def register(name: str, run: Callable[[Telemetry], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: naive(run(Telemetry.of(spark, sf_dir)))
    if sql:
        ORACLES[name] = sql


def register_plain(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: naive(run(spark, sf_dir))
    if sql:
        ORACLES[name] = sql


def joined(column: str, separator: str = "; ") -> F.Column:
    return F.array_join(column, separator)


#: Where the arrivals are parted into those of before and those of after.
SPLIT = "2024-01-16 00:00:00"
EARLIER = f"event_time < TIMESTAMP '{SPLIT}'"

# Sources, projection, admission ------------------------------------------------------------------
ARRIVAL_COLUMNS = "event_id, copy, event_type, event_time, ingest_time, received_at, station_id, connector_id, operator_id, session_id, sequence_no, city, country, vehicle_brand, tariff_id, tariff_eur_per_kwh, meter_kwh, energy_delta_kwh, power_kw, end_reason, fault_code, new_status, charger_status"
register("scan_arrivals", lambda t: t.arrivals.select(*ARRIVAL_COLUMNS.split(", ")), over(ARRIVALS, f"SELECT {ARRIVAL_COLUMNS} FROM arr"))
register("dedup_first_wins", lambda t: admission.first_wins(t.arrivals).where("not duplicate").select("event_id", "copy", "event_time"), over(ADMITTED, "SELECT event_id, copy, event_time FROM adm WHERE NOT duplicate"))
register("dedup_committed_anti_join", lambda t: admission.not_committed(t.arrivals, t.arrivals.where(EARLIER).select("event_id").distinct()).groupBy("event_type").agg(F.count("*").alias("n")), over(ARRIVALS, f"SELECT event_type, count(*) AS n FROM arr WHERE NOT {EARLIER} GROUP BY event_type"))
register("dedup_distinct_ids", lambda t: t.arrivals.groupBy("station_id").agg(F.sort_array(F.collect_set("event_type")).alias("a")).select("station_id", joined("a", ",").alias("types")), over(ARRIVALS, "SELECT station_id, list_aggregate(list_sort(list_distinct(list(event_type))), 'string_agg', ',') AS types FROM arr GROUP BY station_id"))
register("semantic_errors", lambda t: t.admitted.where("not duplicate and size(errors) > 0").select("event_id", "event_type", joined("errors").alias("error_reason")), over(ADMITTED, "SELECT event_id, event_type, list_aggregate(errors, 'string_agg', '; ') AS error_reason FROM adm WHERE NOT duplicate AND len(errors) > 0"))
register("lateness_classes", lambda t: t.admitted.groupBy("event_type", "lateness").agg(F.count("*").alias("n"), F.max("lateness_seconds").alias("most"), F.min("lateness_seconds").alias("least")), over(ADMITTED, "SELECT event_type, lateness, count(*) AS n, max(lateness_seconds) AS most, min(lateness_seconds) AS least FROM adm GROUP BY event_type, lateness"))
register("late_events_rejected", lambda t: t.verdicts.where("outcome = 'too_late'").select("event_id", "event_type", "event_time", "station_id", "lateness_seconds", F.lit("too_late").alias("rejection_reason")), over(VERDICTS, "SELECT event_id, event_type, event_time, station_id, lateness_seconds, 'too_late' AS rejection_reason FROM v WHERE outcome = 'too_late'"))


def _dispositions(t: Telemetry) -> DataFrame:
    rules = t.arrivals.sparkSession.createDataFrame(admission.DISPOSITIONS, admission.DISPOSITION_COLUMNS)
    of = F.when(c("outcome").isin("duplicate", "invalid", "too_late"), c("outcome")).otherwise("accepted")
    return t.verdicts.select(of.alias("disposition")).join(F.broadcast(rules), "disposition").groupBy("disposition").agg(*(F.sum(x).alias(x) for x in admission.DISPOSITION_COLUMNS[1:]))


_RULES = ", ".join(f"('{r[0]}', {', '.join(map(str, r[1:]))})" for r in admission.DISPOSITIONS)
register("dispositions", _dispositions, over(VERDICTS, f"SELECT disposition, {', '.join(f'CAST(sum({x}) AS BIGINT) AS {x}' for x in admission.DISPOSITION_COLUMNS[1:])} FROM (SELECT CASE WHEN outcome IN ('duplicate', 'invalid', 'too_late') THEN outcome ELSE 'accepted' END AS d FROM v) JOIN (VALUES {_RULES}) r({', '.join(admission.DISPOSITION_COLUMNS)}) ON d = disposition GROUP BY disposition"))


# Parsing: arrivals as JSON, some of them spoilt in known ways -----------------------------------------
def _spoilt(t: Telemetry) -> DataFrame:
    log = parse.to_log(t.arrivals)
    text, k = c("value").cast("string"), c("offset") % 60
    drop = lambda field: F.regexp_replace(text, rf'"{field}":("[^"]*"|null|\d+),', "")
    put = lambda field, value: F.regexp_replace(text, rf'"{field}":("[^"]*"|null|\d+)', f'"{field}":{value}')
    broken = (
        F.when(k == 1, F.lit("{bad-json").cast("binary")).when(k == 2, F.lit("  ").cast("binary")).when(k == 3, F.lit(None).cast("binary")).when(k == 4, F.lit("[1, 2]").cast("binary")).when(k == 5, F.unhex(F.lit("C328")))
        .when(k == 6, drop("station_id").cast("binary")).when(k == 7, put("event_type", '"NOPE"').cast("binary")).when(k == 8, put("event_time", '"yesterday"').cast("binary")).when(k == 9, put("sequence_no", "-4").cast("binary")).when(k == 10, put("sequence_no", "1.0").cast("binary"))
        .when(k == 11, put("operator_id", '"  "').cast("binary")).when(k == 12, put("session_id", "7").cast("binary")).when(k == 13, F.concat(text, F.lit(" x")).cast("binary")).when(k == 14, F.regexp_replace(text, r'"payload":\{.*\}\}$', '"payload":3}').cast("binary")).when(k == 15, F.regexp_replace(text, r'"payload":\{', '"payload":{"surprise":1,').cast("binary"))
        .when(k == 16, put("sequence_no", "true").cast("binary")).when(k == 17, F.regexp_replace(text, r'"location":\{[^}]*\}', '"location":5').cast("binary")).otherwise(c("value"))
    )
    return parse.parsed(parse.settled(parse.settled(log, "value").withColumn("value", broken), "value"))


_SPOILT = over(ARRIVALS + """,
p AS (SELECT *, CASE event_no % 60 WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'empty_json' WHEN 3 THEN 'empty_message' WHEN 4 THEN 'event_must_be_json_object' WHEN 5 THEN 'malformed_utf8' WHEN 6 THEN 'Missing required fields: station_id' WHEN 7 THEN 'Invalid event_type: NOPE' WHEN 8 THEN 'Invalid timestamp for event_time: yesterday' WHEN 9 THEN 'sequence_no must be non-negative' WHEN 10 THEN 'sequence_no must be an integer'
  WHEN 11 THEN 'operator_id must be a non-empty string' WHEN 12 THEN 'session_id must be null or string' WHEN 13 THEN 'malformed_json' WHEN 14 THEN 'payload must be an object' WHEN 15 THEN 'Invalid payload for ' || event_type || ': unexpected surprise' WHEN 16 THEN 'sequence_no must be an integer' WHEN 17 THEN 'location must be an object' END AS error_reason FROM arr)""", "")
register("parse_error_reasons", lambda t: _spoilt(t).where("error_reason is not null").groupBy("error_class", "error_reason").agg(F.count("*").alias("n")), _SPOILT + "SELECT CASE WHEN error_reason IN ('empty_message', 'malformed_utf8', 'empty_json', 'malformed_json', 'event_must_be_json_object') THEN 'parse' ELSE 'schema' END AS error_class, error_reason, count(*) AS n FROM p WHERE error_reason IS NOT NULL GROUP BY 1, 2")
register("parse_envelopes", lambda t: parse.envelopes(_spoilt(t)).select("event_id", "event_type", "event_time", "ingest_time", "station_id", "session_id", "sequence_no", "city", "energy_delta_kwh", "fault_code"), _SPOILT + "SELECT event_id, event_type, event_time, ingest_time, station_id, session_id, sequence_no, city, energy_delta_kwh, fault_code FROM p WHERE error_reason IS NULL")
register("dead_letters_salvaged", lambda t: parse.dead_letters(_spoilt(t)).select("offset", "event_id", "event_type", "station_id", "sequence_no", "error_reason"), _SPOILT + """SELECT event_no AS "offset", CASE WHEN lost THEN 'unknown' ELSE event_id END AS event_id, CASE WHEN lost THEN 'UNKNOWN' WHEN event_no % 60 = 7 THEN 'NOPE' ELSE event_type END AS event_type, CASE WHEN lost OR event_no % 60 = 6 THEN NULL ELSE station_id END AS station_id, CASE WHEN lost OR event_no % 60 = 9 THEN NULL WHEN event_no % 60 IN (10, 16) THEN 1 ELSE sequence_no END AS sequence_no, error_reason
  FROM (SELECT *, event_no % 60 IN (1, 2, 3, 4, 5, 13) AS lost FROM p WHERE error_reason IS NOT NULL)""")
register("dead_letter_topic_keys", lambda t: parse.dead_letter_messages(parse.dead_letters(_spoilt(t))).groupBy("key").agg(F.count("*").alias("n")), _SPOILT + "SELECT CASE WHEN event_no % 60 IN (1, 2, 3, 4, 5, 13) THEN 'unknown' WHEN event_no % 60 = 6 THEN event_id ELSE station_id END AS key, count(*) AS n FROM p WHERE error_reason IS NOT NULL GROUP BY 1")

# Sessions, facts, rollups ---------------------------------------------------------------------------
register("session_outcomes", lambda t: t.verdicts.select("event_id", "copy", "outcome", "active", "epoch"), over(VERDICTS, "SELECT event_id, copy, outcome, active, CAST(epoch AS BIGINT) AS epoch FROM v"))
register("session_warnings", lambda t: t.verdicts.where("warning is not null").groupBy("warning").agg(F.count("*").alias("n")), over(VERDICTS, "SELECT warning, count(*) AS n FROM v WHERE warning IS NOT NULL GROUP BY warning"))
register("session_dead_letters", lambda t: t.verdicts.where("outcome = 'invalid'").select("event_id", joined("all_errors").alias("error_reason")), over(VERDICTS, "SELECT event_id, list_aggregate(all_errors, 'string_agg', '; ') AS error_reason FROM v WHERE outcome = 'invalid'"))
register("fact_sessions", lambda t: t.facts, over(FACTS, "SELECT * FROM fact_sessions"))
register("session_timeouts", lambda t: finalized(t.snapshots, t.as_of, 86400).where("finalized_reason = 'inactivity_timeout'").select("session_id", "epoch", "last_event_time", "stop_reason"), over(FACTS, f"SELECT session_id, CAST(epoch AS BIGINT) AS epoch, last_event_time, 'inactivity_timeout' AS stop_reason FROM snap WHERE reason0 IS NULL AND last_event_time <= TIMESTAMP '{AS_OF}' - INTERVAL 86400 SECOND"))
register("active_sessions_by_station", lambda t: t.counted.select("event_id", "station_id", "active_sessions"), over(ROLLUPS, "SELECT event_id, station_id, CAST(active_sessions AS BIGINT) AS active_sessions FROM counted"))
register("agg_station_minute", lambda t: t.station_minute, over(ROLLUPS, "SELECT * FROM agg_station_minute"))
register("agg_operator_hour", lambda t: t.operator_hour, over(ROLLUPS, "SELECT * FROM agg_operator_hour"))
register("agg_city_day_faults", lambda t: t.city_day_faults, over(ROLLUPS, "SELECT * FROM agg_city_day_faults"))

# Analytical queries ----------------------------------------------------------------------------------
for _name in analytics.QUERIES:
    register_plain(_name, lambda spark, sf_dir, name=_name: analytics.run(spark, name, stored_views(spark, sf_dir), AS_OF), over(ROLLUPS + ", result AS (" + analytics.sql(_name, f"TIMESTAMP '{AS_OF}'", "TIMESTAMP") + ")", "SELECT * FROM result"))

# Windows and rankings --------------------------------------------------------------------------------
register("window_tumbling_minute", lambda t: t.raw_events.groupBy(F.window("event_time", "1 minute").alias("w"), "station_id").agg(F.count("*").alias("n")).select(c("w.start").alias("start"), c("w.end").alias("stop"), "station_id", "n"), over(VERDICTS, "SELECT date_trunc('minute', event_time) AS start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS stop, station_id, count(*) AS n FROM v WHERE accepted GROUP BY ALL"))
register("window_session_gap", lambda t: t.raw_events.groupBy(F.session_window("event_time", "1 hour").alias("w"), "connector_id").agg(F.count("*").alias("n"), F.max("event_time").alias("last_time")).select(c("w.start").alias("start"), "connector_id", "n", "last_time"), over(VERDICTS + """,
g AS (SELECT *, CASE WHEN event_time < lag(event_time) OVER (PARTITION BY connector_id ORDER BY event_time) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS f FROM v WHERE accepted), h AS (SELECT *, sum(f) OVER (PARTITION BY connector_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS no FROM g)""", "SELECT min(event_time) AS start, connector_id, count(*) AS n, max(event_time) AS last_time FROM h GROUP BY connector_id, no"))
register("window_rolling_percentile", lambda t: metrics.rolling_percentiles(metrics.latencies(t.arrivals), ["event_type"], ["event_time", "event_no", "copy"], "event_time", "end_to_end_ms", (50, 95, 99)).select("event_type", "sample_no", *(F.round(p, 6).alias(p) for p in ("p50", "p95", "p99"))), over(ARRIVALS + """,
s AS (SELECT event_type, 1000.0::DOUBLE + greatest(0, (epoch_us(received_at) - epoch_us(ingest_time)) / 1000.0::DOUBLE) AS x, row_number() OVER (PARTITION BY event_type ORDER BY event_time, event_no, copy) AS nth FROM arr),
p AS (SELECT event_type, unnest(range(1000, count(*) + 1, 1000)) AS sample_no FROM s GROUP BY event_type)""", """SELECT p.event_type, p.sample_no, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99
  FROM p JOIN s ON s.event_type = p.event_type AND s.nth <= p.sample_no AND s.nth > p.sample_no - 20000 GROUP BY ALL"""))
_span = lambda: Window.partitionBy("station_id").orderBy(F.unix_micros("event_time")).rangeBetween(-30_000_000, 0)
register("window_sliding_event_rate", lambda t: t.arrivals.select("event_id", F.round(F.count("*").over(_span()) / 30.0, 6).alias("rate")), over(ARRIVALS, "SELECT event_id, round(count(*) OVER (PARTITION BY station_id ORDER BY event_time RANGE BETWEEN INTERVAL 30 SECOND PRECEDING AND CURRENT ROW) / 30.0::DOUBLE, 6) AS rate FROM arr"))
register("latest_event_by_station", lambda t: t.arrivals.groupBy("station_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct(F.unix_millis("event_time"), "event_no", "copy")).alias("r")).select("station_id", "r.event_id", "r.event_type"), over(ARRIVALS, "SELECT station_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY epoch_ms(event_time) DESC, event_no DESC, copy DESC) AS r FROM arr) WHERE r = 1"))
_before = lambda: Window.partitionBy("connector_id").orderBy("event_time", "event_no", "copy").rowsBetween(Window.unboundedPreceding, -1)
register("running_max_sequence", lambda t: t.arrivals.select("event_id", "copy", F.max("sequence_no").over(_before()).alias("last_sequence_no")), over(ARRIVALS, "SELECT event_id, copy, max(sequence_no) OVER (PARTITION BY connector_id ORDER BY event_time, event_no, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_sequence_no FROM arr"))
register("percentiles_by_type", lambda t: metrics.latencies(t.arrivals).groupBy("event_type").agg(*(F.round(metrics.percentile("end_to_end_ms", p), 6).alias(f"p{p}") for p in (50, 95, 99))), over(ARRIVALS, "SELECT event_type, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99 FROM (SELECT event_type, 1000.0::DOUBLE + greatest(0, (epoch_us(received_at) - epoch_us(ingest_time)) / 1000.0::DOUBLE) AS x FROM arr) GROUP BY event_type"))
register("top_energy_updates", lambda t: t.arrivals.where("energy_delta_kwh is not null").select("event_id", "copy", "energy_delta_kwh").orderBy(F.desc("energy_delta_kwh"), "event_no", "copy").limit(50), over(ARRIVALS, "SELECT event_id, copy, energy_delta_kwh FROM arr WHERE energy_delta_kwh IS NOT NULL ORDER BY energy_delta_kwh DESC, event_no, copy LIMIT 50"))
register("last_or_percentile", lambda t: t.arrivals.groupBy("station_id").agg(F.max_by("power_kw", F.when(c("power_kw").isNotNull(), F.struct("event_time", "event_no"))).alias("latest"), metrics.percentile("power_kw", 95).alias("p")).select("station_id", F.round(F.when(c("latest") > 0, c("latest")).otherwise(c("p")), 6).alias("value")), over(ARRIVALS, "SELECT station_id, round(CASE WHEN latest > 0 THEN latest ELSE p END, 6) AS value FROM (SELECT station_id, arg_max(power_kw, (event_time, event_no)) FILTER (power_kw IS NOT NULL) AS latest, coalesce(quantile_cont(power_kw, 0.95), 0) AS p FROM arr GROUP BY station_id)"))

# Serving tables --------------------------------------------------------------------------------------
_SERVING = ROLLUPS + """,
si0 AS (SELECT *, opens OR metered OR ends OR active AS has_session FROM counted),
si AS (SELECT *, (last_value(CASE WHEN metered THEN {'x': power_kw} END IGNORE NULLS) OVER w).x AS s_power, (last_value(CASE WHEN opens OR metered OR ends AND event_type = 'SESSION_STOP' THEN {'x': coalesce(final_meter_kwh, meter_kwh, initial_meter_kwh)} END IGNORE NULLS) OVER w).x AS s_meter,
  last_value(CASE WHEN opens OR ends AND event_type = 'SESSION_STOP' THEN vehicle_brand END IGNORE NULLS) OVER w AS s_brand, count(CASE WHEN metered THEN 1 END) OVER w AS s_count, coalesce(max(CASE WHEN metered AND power_kw >= 0 THEN power_kw END) OVER w, 0) AS s_max,
  coalesce(CASE WHEN ends AND event_type = 'SESSION_STOP' THEN total_energy_kwh END, sum(CASE WHEN metered THEN energy_delta_kwh END) OVER w, 0) AS s_energy, max(CASE WHEN opens THEN event_time END) OVER w AS s_started, max(CASE WHEN applied THEN event_time END) OVER w AS s_last,
  coalesce(max(CASE WHEN opens THEN tariff_id END) OVER w, 'default') AS s_tariff_id, coalesce(max(CASE WHEN opens THEN tariff_eur_per_kwh END) OVER w, 0.35::DOUBLE) AS s_tariff,
  CASE event_type WHEN 'STATUS_CHANGE' THEN new_status WHEN 'HEARTBEAT' THEN charger_status WHEN 'FAULT_ALERT' THEN 'faulted' WHEN 'SESSION_START' THEN 'charging' WHEN 'METER_UPDATE' THEN 'charging' ELSE 'available' END AS st
  FROM si0 WINDOW w AS (PARTITION BY session_key, epoch ORDER BY event_time, event_no, copy ROWS UNBOUNDED PRECEDING)),
sp AS (SELECT *, greatest(0.0::DOUBLE, coalesce(CASE WHEN metered THEN power_kw END, CASE WHEN has_session THEN s_power END, 0)) AS pw FROM si)"""
register("serving_station_state", lambda t: serving.station_state(t.serving_inputs), over(_SERVING, "SELECT station_id, event_time, operator_id, st AS current_status, pw AS latest_power_kw, CAST(active_sessions AS BIGINT) AS active_session_count, CASE WHEN lower(trim(st)) IN ('faulted', 'degraded', 'error') THEN 1 ELSE 0 END AS fault_flag, coalesce(city, '') AS city, coalesce(country, '') AS country, last_heartbeat_time FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY epoch_ms(event_time) DESC, event_time DESC, event_no DESC, copy DESC) AS r, max(CASE WHEN event_type = 'HEARTBEAT' THEN event_time END) OVER (PARTITION BY station_id) AS last_heartbeat_time FROM sp) WHERE r = 1"))
register("serving_connector_state", lambda t: serving.connector_state(t.serving_inputs), over(_SERVING, """SELECT station_id, connector_id, event_time, operator_id, st AS status, CASE WHEN event_type IN ('SESSION_STOP', 'FAULT_ALERT') OR event_type = 'STATUS_CHANGE' AND lower(trim(new_status)) = 'faulted' THEN '' ELSE coalesce(session_id, '') END AS session_id, pw AS power_kw,
  greatest(0.0::DOUBLE, coalesce(CASE WHEN metered THEN meter_kwh END, CASE WHEN event_type = 'SESSION_STOP' THEN final_meter_kwh END, CASE WHEN has_session THEN s_meter END, 0)) AS energy_kwh_last, coalesce(CASE WHEN has_session THEN s_brand END, '') AS vehicle_brand, coalesce(CASE event_type WHEN 'FAULT_ALERT' THEN fault_code WHEN 'STATUS_CHANGE' THEN reason END, '') AS fault_code, last_meter_time
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id, connector_id ORDER BY epoch_ms(event_time) DESC, event_time DESC, event_no DESC, copy DESC) AS r, max(CASE WHEN event_type = 'METER_UPDATE' THEN event_time END) OVER (PARTITION BY station_id, connector_id) AS last_meter_time FROM sp WHERE event_type <> 'HEARTBEAT') WHERE r = 1"""))
register("serving_session_state", lambda t: serving.session_state(t.serving_inputs).drop("event_time"), over(_SERVING, """SELECT session_id, station_id, connector_id, operator_id, s_started AS start_time, s_last AS last_event_time, coalesce(s_brand, '') AS vehicle_brand, s_tariff_id AS tariff_id, greatest(0.0::DOUBLE, s_energy) AS current_energy_kwh, coalesce(s_power, 0) AS current_power_kw, s_count AS meter_update_count, s_max AS max_power_kw_seen,
  round(greatest(0.0::DOUBLE, s_energy) * greatest(0.0::DOUBLE, s_tariff), 6) AS estimated_cost_eur, CASE WHEN ends THEN 'finalized' WHEN s_count > 0 THEN 'charging' ELSE 'active' END AS status, CASE WHEN ends THEN 3600 ELSE 86400 END AS ttl_seconds
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY epoch_ms(event_time) DESC, event_time DESC, event_no DESC, copy DESC) AS r FROM sp WHERE has_session AND session_id IS NOT NULL AND (event_type <> 'METER_UPDATE' OR metered)) WHERE r = 1"""))


def _upsert(t: Telemetry) -> DataFrame:
    """The newest row of each station from the arrivals of the first half is in store; the second half comes as a batch."""
    newest = F.max_by(F.struct("event_time", "event_type", "city"), F.struct("event_time", "event_no", "copy"))
    pick = lambda which: t.arrivals.where(which).groupBy("station_id").agg(newest.alias("r")).select("station_id", "r.*")
    return serving.guarded_upsert(pick(EARLIER), pick(f"not {EARLIER}"), ["station_id"])


register("serving_guarded_upsert", _upsert, over(ARRIVALS + f", r AS (SELECT *, NOT {EARLIER} AS h, row_number() OVER (PARTITION BY station_id, {EARLIER} ORDER BY event_time DESC, event_no DESC, copy DESC) AS r FROM arr)", "SELECT coalesce(s.station_id, b.station_id) AS station_id, CASE WHEN n THEN b.event_time ELSE s.event_time END AS event_time, CASE WHEN n THEN coalesce(b.event_type, s.event_type) ELSE s.event_type END AS event_type, CASE WHEN n THEN coalesce(b.city, s.city) ELSE s.city END AS city FROM (SELECT * FROM r WHERE r = 1 AND NOT h) s FULL JOIN (SELECT * FROM r WHERE r = 1 AND h) b ON s.station_id = b.station_id, LATERAL (SELECT coalesce(b.event_time IS NOT NULL AND (s.event_time IS NULL OR epoch_ms(b.event_time) > epoch_ms(s.event_time)), false) AS n)"))


register("serving_timeout_states", lambda t: serving.timeout_states(t.finalized.where("finalized_reason = 'inactivity_timeout'"), t.as_of).drop("energy_kwh_last"), over(FACTS, f"SELECT station_id, connector_id, operator_id, TIMESTAMP '{AS_OF}' AS event_time, last_event_time AS last_meter_time, 'available' AS status, '' AS session_id, 0.0::DOUBLE AS power_kw, coalesce(vehicle_brand, '') AS vehicle_brand, '' AS fault_code FROM fin WHERE finalized_reason = 'inactivity_timeout'"))
register("serving_live_sessions", lambda t: serving.live(serving.session_state(t.serving_inputs), F.lit("2024-01-29 00:00:00").cast("timestamp")).groupBy("status").agg(F.count("*").alias("n")), over(_SERVING, """SELECT status, count(*) AS n FROM (SELECT event_time, CASE WHEN ends THEN 'finalized' WHEN s_count > 0 THEN 'charging' ELSE 'active' END AS status, CASE WHEN ends THEN 3600 ELSE 86400 END AS ttl FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY epoch_ms(event_time) DESC, event_time DESC, event_no DESC, copy DESC) AS r FROM sp WHERE has_session AND session_id IS NOT NULL AND (event_type <> 'METER_UPDATE' OR metered)) WHERE r = 1)
  WHERE epoch_us(TIMESTAMP '2024-01-29 00:00:00') < epoch_us(event_time) + CAST(ttl AS BIGINT) * 1000000 GROUP BY status"""))
register("serving_key_scan", lambda t: serving.keys_like(serving.station_state(t.serving_inputs), "ST-1", 100), over(ROLLUPS, "SELECT DISTINCT station_id FROM counted WHERE station_id LIKE 'ST-1%'"))
register("serving_point_read", lambda t: serving.point_read(serving.session_state(t.serving_inputs), "session_id", ["3-1", "40-1", "nobody"]).select("session_id", "station_id", "meter_update_count", "status"), over(_SERVING, """SELECT session_id, station_id, s_count AS meter_update_count, CASE WHEN ends THEN 'finalized' WHEN s_count > 0 THEN 'charging' ELSE 'active' END AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY epoch_ms(event_time) DESC, event_time DESC, event_no DESC, copy DESC) AS r FROM sp WHERE has_session AND session_id IN ('3-1', '40-1', 'nobody') AND (event_type <> 'METER_UPDATE' OR metered)) WHERE r = 1"""))
register("serving_key_families", lambda t: t.raw_events.agg(F.count_distinct("station_id").alias("station"), F.count_distinct(F.when(c("event_type") != "HEARTBEAT", F.struct("station_id", "connector_id"))).alias("connector")), over(VERDICTS, "SELECT count(DISTINCT station_id) AS station, count(DISTINCT CASE WHEN event_type <> 'HEARTBEAT' THEN station_id || '/' || connector_id END) AS connector FROM v WHERE accepted"))

# Metrics and verdicts --------------------------------------------------------------------------------
register("latency_trio", lambda t: metrics.latencies(t.arrivals).groupBy("station_id").agg(F.round(F.avg("ingest_lag_ms"), 6).alias("ingest"), F.round(F.avg("processor_ms"), 6).alias("processor"), F.round(F.avg("end_to_end_ms"), 6).alias("end_to_end")), over(ARRIVALS, "SELECT station_id, round(avg(1000.0::DOUBLE), 6) AS ingest, round(avg(x), 6) AS processor, round(avg(1000.0::DOUBLE + x), 6) AS end_to_end FROM (SELECT station_id, greatest(0, (epoch_us(received_at) - epoch_us(ingest_time)) / 1000.0::DOUBLE) AS x FROM arr) GROUP BY station_id"))
register("latency_histogram", lambda t: metrics.histogram(metrics.latencies(t.arrivals), "processor_ms").where("le < 1e9"), over(ARRIVALS, f"SELECT le, count(*) FILTER (x <= le) AS n FROM (SELECT greatest(0, (epoch_us(received_at) - epoch_us(ingest_time)) / 1000.0::DOUBLE) AS x FROM arr), (VALUES {', '.join(f'({b}::DOUBLE)' for b in metrics.LATENCY_BUCKETS)}) b(le) GROUP BY le"))
_samples = lambda t: t.arrivals.select("station_id", "event_time", (c("sequence_no") % 40).cast("double").alias("value"), "event_no")
register("counter_rate_5m", lambda t: metrics.rates(_samples(t), ["station_id"], "event_time", "value").select("start", "station_id", F.round("rate", 6).alias("rate")), over(ARRIVALS + ", s AS (SELECT station_id, event_time, CAST(sequence_no % 40 AS DOUBLE) AS value, lag(CAST(sequence_no % 40 AS DOUBLE)) OVER (PARTITION BY station_id ORDER BY event_time) AS old FROM arr)", "SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS start, station_id, round(sum(CASE WHEN old IS NULL THEN 0 WHEN value >= old THEN value - old ELSE greatest(0, value) END) / 300, 6) AS rate FROM s GROUP BY 1, 2"))


def _type_counters(t: Telemetry) -> DataFrame:
    """A counter of the events of each station and type, which starts anew each day, read at every event."""
    own = Window.partitionBy("station_id", "event_type", F.to_date("event_time")).orderBy("event_time", "event_no", "copy")
    return t.arrivals.select("station_id", "event_type", "event_time", F.row_number().over(own).cast("double").alias("value"))


register("rate_by_event_type", lambda t: metrics.rates(_type_counters(t), ["station_id", "event_type"], "event_time", "value").groupBy("start", "event_type").agg(F.round(F.sum("rate"), 6).alias("rate")), over(ARRIVALS + """,
s AS (SELECT station_id, event_type, event_time, event_no, copy, CAST(row_number() OVER (PARTITION BY station_id, event_type, CAST(event_time AS DATE) ORDER BY event_time, event_no, copy) AS DOUBLE) AS value FROM arr),
d AS (SELECT *, lag(value) OVER (PARTITION BY station_id, event_type ORDER BY event_time, value) AS old FROM s)""", "SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS start, event_type, round(sum(CASE WHEN old IS NULL THEN 0 WHEN value >= old THEN value - old ELSE greatest(0, value) END) / 300, 6) AS rate FROM d GROUP BY 1, 2"))
register("gauge_latest_and_max", lambda t: _samples(t).groupBy("station_id").agg(F.max("value").alias("most"), F.max_by("value", F.struct("event_time", "event_no")).alias("latest")), over(ARRIVALS, "SELECT station_id, max(CAST(sequence_no % 40 AS DOUBLE)) AS most, arg_max(CAST(sequence_no % 40 AS DOUBLE), (event_time, event_no)) AS latest FROM arr GROUP BY station_id"))
_counts = lambda rows: rows.groupBy(c("event_type").alias("metric")).agg(F.count("*").cast("double").alias("value"))
register("counter_delta_with_reset", lambda t: metrics.counter_delta(_counts(t.arrivals.where(EARLIER)), _counts(t.arrivals.where(f"not {EARLIER}"))), over(ARRIVALS, f"SELECT a.m AS metric, CASE WHEN a.v >= coalesce(b.v, 0) THEN a.v - coalesce(b.v, 0) ELSE greatest(0, a.v) END AS delta FROM (SELECT event_type AS m, CAST(count(*) AS DOUBLE) AS v FROM arr WHERE NOT {EARLIER} GROUP BY 1) a LEFT JOIN (SELECT event_type AS m, CAST(count(*) AS DOUBLE) AS v FROM arr WHERE {EARLIER} GROUP BY 1) b ON a.m = b.m"))


def _verdicts(t: Telemetry) -> DataFrame:
    by = t.arrivals.groupBy("station_id").agg(F.count("*").cast("double").alias("achieved"), F.max("lateness").alias("lag"), F.avg(F.coalesce("power_kw", F.lit(0.0))).alias("p95"))
    out = by.withColumn("bottleneck", metrics.bottleneck(c("achieved"), F.lit(500.0), c("p95"), c("p95") * 2, c("lag")))
    return out.select("station_id", metrics.outcome(c("achieved"), F.lit(500.0)).alias("outcome"), "bottleneck", metrics.advice(c("bottleneck")).alias("advice"))


register("benchmark_verdicts", lambda t: _verdicts(type(t)(t.arrivals.withColumn("lateness", F.unix_seconds("received_at") - F.unix_seconds("event_time")))), over(ARRIVALS + ", s AS (SELECT station_id, CAST(count(*) AS DOUBLE) AS a, max(epoch_us(received_at) // 1000000 - epoch_us(event_time) // 1000000) AS lag, avg(coalesce(power_kw, 0)) AS p FROM arr GROUP BY station_id), b AS (SELECT *, CASE WHEN lag > 1000 THEN 'kafka_consumer_lag_growth' WHEN p > 250 THEN 'clickhouse_insert_latency' WHEN p * 2 > 50 THEN 'redis_write_latency' WHEN a < 400 THEN 'processor_throughput_limit' ELSE 'no_major_bottleneck_observed' END AS bottleneck FROM s)", "SELECT station_id, CASE WHEN a >= 450 THEN 'pass' WHEN a >= 350 THEN 'partial' ELSE 'fail' END AS outcome, bottleneck, CASE bottleneck " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in metrics.ADVICE.items()) + " END AS advice FROM b"))
register("metrics_exposition_parse", lambda t: metrics.exposition(t.arrivals.select(F.concat(F.lit('events_total{station="'), "station_id", F.lit('", kind="'), "event_type", F.lit('"} '), "event_no").alias("value"))).groupBy("name", c("labels")["station"].alias("station"), c("labels")["kind"].alias("kind")).agg(F.sum("value").alias("total")), over(ARRIVALS, "SELECT 'events_total' AS name, station_id AS station, event_type AS kind, CAST(sum(event_no) AS DOUBLE) AS total FROM arr GROUP BY 2, 3"))
register("query_latency_summary", lambda t: metrics.latencies(t.arrivals).groupBy("event_type").agg(metrics.percentile("end_to_end_ms", 95).alias("p95"), metrics.percentile("end_to_end_ms", 99).alias("p99")).agg(F.count("*").cast("double").alias("families"), F.round(metrics.percentile("p95", 95), 3).alias("p95_of_p95_ms"), F.round(metrics.percentile("p99", 99), 3).alias("p99_of_p99_ms"), F.round(F.max("p99"), 3).alias("max_p99_ms")), over(ARRIVALS + ", s AS (SELECT event_type, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.99) AS p99 FROM (SELECT event_type, 1000.0::DOUBLE + greatest(0, (epoch_us(received_at) - epoch_us(ingest_time)) / 1000.0::DOUBLE) AS x FROM arr) GROUP BY event_type)", "SELECT CAST(count(*) AS DOUBLE) AS families, round(quantile_cont(p95, 0.95), 3) AS p95_of_p95_ms, round(quantile_cont(p99, 0.99), 3) AS p99_of_p99_ms, round(max(p99), 3) AS max_p99_ms FROM s"))

# Generator -------------------------------------------------------------------------------------------
register_plain("generator_network_shard", lambda spark, _: generator.network(spark, 1200, shard=1, shards=3), "SELECT format('ST-{:04d}', i + 1) AS station_id, 'OP-' || (i % 3) AS operator_id, 'C' || (i % 6) AS city, CAST(j AS VARCHAR) AS connector_id FROM range(1200) a(i), range(1, 3) b(j) WHERE i % 3 = 1")
register_plain("generator_demand", lambda spark, _: spark.range(24).select(c("id").alias("hour"), F.round(generator.demand(c("id")), 6).alias("multiplier")), f"SELECT i AS hour, round(greatest(0.1::DOUBLE, ([{', '.join(f'{w}::DOUBLE' for w in generator.HOURLY_WEIGHTS)}])[i + 1] * CASE WHEN i >= 7 AND i < 10 THEN 1.7::DOUBLE ELSE 1 END * CASE WHEN i >= 17 AND i < 21 THEN 2.0::DOUBLE ELSE 1 END), 6) AS multiplier FROM range(24) t(i)")
register_plain("generator_burst_target", lambda spark, _: spark.range(300).select(c("id").alias("tick"), generator.burst_target(c("id").cast("double"), 1000.0).alias("target")), "SELECT i AS tick, CASE WHEN i % 60 < 18 THEN 3000.0::DOUBLE ELSE 1000.0::DOUBLE END AS target FROM range(300) t(i)")
register_plain("generator_weighted_choice", lambda spark, _: spark.range(1000).select(generator.weighted_choice({"a": 1, "b": 3, "c": 0}, (c("id") + 0.5) / 1000).alias("item")).groupBy("item").agg(F.count("*").alias("n")), "SELECT * FROM (VALUES ('a', 250::BIGINT), ('b', 750::BIGINT)) t(item, n)")


def _chance(seed: int, k: int, *keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}:{k}', {', '.join(keys)})), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


#: The generated sessions and their events, from the same digests.
_GENERATED = f"""
g_net AS (SELECT format('ST-{{:04d}}', i + 1) AS station_id, 'OP-' || (i % 3) AS operator_id, 'C' || (i % 6) AS city, CAST(j AS VARCHAR) AS connector_id FROM range(200) a(i), range(1, 3) b(j)),
g_u AS (SELECT *, {", ".join(f"{_chance(17, k, 'station_id', 'connector_id')} AS u{k}" for k in range(1, 6))} FROM g_net),
g_s0 AS (SELECT *, CASE WHEN u1 <= 3 / 7.5::DOUBLE THEN 'Tesla' WHEN u1 <= 3 / 7.5::DOUBLE + 2 / 7.5::DOUBLE THEN 'Renault' WHEN u1 <= 3 / 7.5::DOUBLE + 2 / 7.5::DOUBLE + 1.5 / 7.5::DOUBLE THEN 'BMW' ELSE 'Togg' END AS vehicle_brand,
  round(10 + 50 * u2, 2) AS soc_start,
  round(CASE WHEN u3 < 27 / 82.0::DOUBLE THEN 8 + sqrt(u3 * 82 * 27) ELSE 90 - sqrt((1 - u3) * 82 * 55) END, 2) AS minutes,
  round(11 + 139 * u4, 3) AS power_kw, TIMESTAMP '2026-01-01 00:00:00' + to_minutes(CAST(floor(60 * u5) AS BIGINT)) AS started_at FROM g_u),
g_s AS (SELECT *, 'S-' || station_id || '-' || connector_id AS session_id, round(power_kw * CASE WHEN soc_start < 50 THEN 1.0::DOUBLE WHEN soc_start < 80 THEN 0.72::DOUBLE ELSE greatest(0.1::DOUBLE, (100 - soc_start) / 100) END * minutes / 60, 6) AS energy_kwh,
  CAST(greatest(1, floor(minutes * 60 / 60)) AS BIGINT) AS n FROM g_s0),
g_e AS (SELECT session_id || '-' || q AS event_id, CASE WHEN q = 0 THEN 'SESSION_START' WHEN q <= n THEN 'METER_UPDATE' ELSE 'SESSION_STOP' END AS event_type, started_at + to_seconds(q * 60) AS event_time,
  station_id, connector_id, operator_id, session_id, q AS sequence_no, city, vehicle_brand,
  CASE WHEN q BETWEEN 1 AND n THEN round(energy_kwh / n, 6) END AS energy_delta_kwh, CASE WHEN q BETWEEN 1 AND n THEN round(round(energy_kwh / n, 6) * q, 6) END AS meter_kwh
  FROM (SELECT *, unnest(range(0, n + 2)) AS q FROM g_s))"""
_generated = lambda spark: generator.meter_events(generator.sessions(generator.network(spark, 200)))
register_plain("generator_events", lambda spark, _: _generated(spark), over(_GENERATED, "SELECT * FROM g_e"))
register_plain("generator_quality_faults", lambda spark, _: generator.with_faults(_generated(spark), 0.02, 0.02, 0.02), over(_GENERATED + f""",
g_b AS (SELECT *, {", ".join(f"{_chance(29, k, 'event_id')} AS u{k}" for k in range(1, 6))} FROM g_e),
g_r AS (SELECT *, event_time + to_seconds(CASE WHEN u1 < 0.02 THEN CAST(floor(5 + 25 * u2) AS BIGINT) ELSE 0 END) AS release_at FROM g_b)""", """SELECT * EXCLUDE (u1, u2, u3, u4, u5) FROM g_r
UNION ALL SELECT * EXCLUDE (u1, u2, u3, u4, u5) FROM g_r WHERE u3 < 0.02
UNION ALL SELECT * EXCLUDE (u1, u2, u3, u4, u5) REPLACE (event_id || '-late' AS event_id, event_time - to_seconds(900 + CAST(floor(20 + 220 * u5) AS BIGINT)) AS event_time)
  FROM g_r WHERE event_type NOT IN ('SESSION_START', 'SESSION_STOP') AND u4 < 0.02"""))
