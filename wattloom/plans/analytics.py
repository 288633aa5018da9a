"""The analytical queries, as SQL with a named parameter as_of for the present.

Each reads views of the fact and rollup tables. Sums are rounded to 6 places first: the order of a sum mustn't show. NULLS LAST and tie-breaking keys make limits well
defined; empty conditional sums are 0. The fault query names the day column as the table does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (SQL, the view that it reads). {as_of} stands for a timestamp expression of either engine.
QUERIES = {
    "q1_peak_hour_revenue": """
        WITH base AS (SELECT revenue_eur_total AS r, hour(session_start_time) AS hr FROM fact_sessions WHERE session_start_time >= {as_of} - INTERVAL '7' DAY)
        SELECT round(100.0 * coalesce(sum(CASE WHEN hr IN (7, 8, 17, 18, 19) THEN r END), 0) / nullif(sum(r), 0), 2) AS peak_hour_revenue_contribution_pct,
               round(coalesce(sum(CASE WHEN hr IN (7, 8, 17, 18, 19) THEN r END), 0), 2) AS peak_hour_revenue_eur, round(coalesce(sum(r), 0), 2) AS total_revenue_eur FROM base""",
    "q2_revenue_by_tariff_hour": """
        SELECT CAST(date_trunc('hour', session_start_time) AS {naive}) AS hour_bucket, tariff_id, count(*) AS sessions, round(round(sum(energy_kwh_total), 6), 2) AS energy_kwh, round(round(sum(revenue_eur_total), 6), 2) AS revenue_eur,
               round(round(avg(revenue_eur_total), 6), 2) AS avg_revenue_per_session, round(round(sum(revenue_eur_total) / nullif(sum(energy_kwh_total), 0), 8), 4) AS revenue_per_kwh
        FROM fact_sessions WHERE session_start_time >= {as_of} - INTERVAL '7' DAY GROUP BY 1, 2 ORDER BY 1, 2""",
    "q3_fleet_power_anomaly": """
        WITH stats AS (SELECT avg(avg_power_kw) AS m, stddev_pop(avg_power_kw) AS s FROM fact_sessions WHERE avg_power_kw IS NOT NULL AND session_start_time >= {as_of} - INTERVAL '30' DAY)
        SELECT f.session_id, f.operator_id, f.station_id, f.connector_id, f.vehicle_brand, CAST(f.session_start_time AS {naive}) AS session_start_time, CAST(f.session_end_time AS {naive}) AS session_end_time, round(f.avg_power_kw, 2) AS avg_power_kw,
               round(m, 2) AS fleet_mean_power_kw, round(s, 2) AS fleet_std_power_kw, round((f.avg_power_kw - m) / nullif(s, 0), 2) AS z_score
        FROM fact_sessions f CROSS JOIN stats WHERE f.avg_power_kw IS NOT NULL AND f.session_start_time >= {as_of} - INTERVAL '30' DAY AND abs((f.avg_power_kw - m) / nullif(s, 0)) > 2
        ORDER BY abs((f.avg_power_kw - m) / nullif(s, 0)) DESC, f.start_event_id LIMIT 100""",
    "q4_brand_power_anomaly": """
        WITH stats AS (SELECT vehicle_brand AS b, avg(avg_power_kw) AS m, stddev_pop(avg_power_kw) AS s FROM fact_sessions WHERE avg_power_kw IS NOT NULL AND vehicle_brand IS NOT NULL AND session_start_time >= {as_of} - INTERVAL '30' DAY GROUP BY vehicle_brand)
        SELECT f.session_id, f.vehicle_brand, f.operator_id, f.station_id, CAST(f.session_start_time AS {naive}) AS session_start_time, round(f.avg_power_kw, 2) AS avg_power_kw, round(m, 2) AS brand_mean_power_kw, round(s, 2) AS brand_std_power_kw, round((f.avg_power_kw - m) / nullif(s, 0), 2) AS z_score
        FROM fact_sessions f JOIN stats ON f.vehicle_brand = b WHERE f.avg_power_kw IS NOT NULL AND f.session_start_time >= {as_of} - INTERVAL '30' DAY AND abs((f.avg_power_kw - m) / nullif(s, 0)) > 2
        ORDER BY abs((f.avg_power_kw - m) / nullif(s, 0)) DESC, f.start_event_id LIMIT 100""",
    "q5_fault_count_by_city": """
        SELECT country_code, city, CAST(sum(fault_count) AS BIGINT) AS total_faults, CAST(sum(distinct_station_count) AS BIGINT) AS station_days_affected
        FROM agg_city_day_faults WHERE bucket_day >= CAST({as_of} AS DATE) - INTERVAL '30' DAY GROUP BY country_code, city ORDER BY total_faults DESC, country_code, city LIMIT 20""",
    "q6_fault_distribution": """
        SELECT country AS location_country, city AS location_city, count(*) AS fault_events FROM raw_events WHERE event_type = 'FAULT_ALERT' AND event_time >= {as_of} - INTERVAL '30' DAY
        GROUP BY country, city ORDER BY fault_events DESC, country NULLS LAST, city NULLS LAST LIMIT 20""",
    "b1_hourly_energy": """
        SELECT CAST(bucket_hour AS {naive}) AS bucket_hour, operator_id, sum(energy_kwh_sum) AS energy_kwh FROM agg_operator_hour WHERE bucket_hour >= {as_of} - INTERVAL '7' DAY GROUP BY bucket_hour, operator_id ORDER BY bucket_hour DESC, operator_id LIMIT 5000""",
    "b2_uptime_downtime": """
        SELECT operator_id, station_id, count(*) AS minute_rows, CAST(sum(CASE WHEN active_connector_estimate > 0 THEN 1 ELSE 0 END) AS BIGINT) AS charging_minutes, CAST(sum(CASE WHEN active_connector_estimate = 0 THEN 1 ELSE 0 END) AS BIGINT) AS idle_minutes
        FROM agg_station_minute WHERE bucket_minute >= {as_of} - INTERVAL '7' DAY GROUP BY operator_id, station_id ORDER BY charging_minutes DESC, operator_id, station_id LIMIT 2000""",
    "b3_duration_energy_by_brand": """
        SELECT coalesce(vehicle_brand, 'unknown') AS brand, round(avg(duration_seconds), 6) AS avg_duration_seconds, round(avg(energy_kwh_total), 6) AS avg_energy_kwh, count(*) AS session_count FROM fact_sessions WHERE session_start_time >= {as_of} - INTERVAL '30' DAY GROUP BY 1 ORDER BY session_count DESC, brand LIMIT 100""",
    "b4_revenue_by_tariff_time": """
        SELECT CAST(date_trunc('hour', session_start_time) AS {naive}) AS hour_bucket, tariff_id, round(sum(revenue_eur_total), 6) AS revenue_eur, round(sum(energy_kwh_total), 6) AS energy_kwh, count(*) AS sessions FROM fact_sessions WHERE session_start_time >= {as_of} - INTERVAL '14' DAY GROUP BY 1, 2 ORDER BY hour_bucket DESC, tariff_id LIMIT 5000""",
    "b5_fault_density_by_city": """
        SELECT bucket_day, operator_id, city, country_code, fault_count, distinct_station_count FROM agg_city_day_faults WHERE bucket_day >= CAST({as_of} AS DATE) - INTERVAL '30' DAY ORDER BY bucket_day DESC, fault_count DESC, operator_id, country_code, city LIMIT 5000""",
    "b6_anomaly_spikes": """
        SELECT station_id, max(events_total) AS max_events_minute, round(avg(events_total), 6) AS avg_events_minute FROM agg_station_minute WHERE bucket_minute >= {as_of} - INTERVAL '3' DAY GROUP BY station_id HAVING max(events_total) > avg(events_total) * 4 ORDER BY max_events_minute DESC, station_id LIMIT 1000""",
    "b6_anomaly_spikes_wide": """
        SELECT station_id, max(events_total) AS max_events_minute, round(avg(events_total), 6) AS avg_events_minute FROM agg_station_minute WHERE bucket_minute >= {as_of} - INTERVAL '30' DAY GROUP BY station_id HAVING max(events_total) > avg(events_total) * {spike} ORDER BY max_events_minute DESC, station_id LIMIT 1000""",
    "b7_table_counts": """
        SELECT 'raw_events' AS table_name, count(*) AS n FROM raw_events UNION ALL SELECT 'fact_sessions', count(*) FROM fact_sessions UNION ALL SELECT 'agg_station_minute', count(*) FROM agg_station_minute
        UNION ALL SELECT 'agg_operator_hour', count(*) FROM agg_operator_hour UNION ALL SELECT 'agg_city_day_faults', count(*) FROM agg_city_day_faults""",
    "b8_events_by_type": "SELECT event_type, count(*) AS n FROM raw_events GROUP BY event_type",
}
#: The burst over the average that the wide form looks for, so that rows come out of a sparse table.
SPIKE = 1.2


def sql(name: str, as_of: str, naive: str) -> str:
    return QUERIES[name].format(as_of=as_of, naive=naive, spike=SPIKE)


def run(spark: SparkSession, name: str, views: dict[str, DataFrame], as_of: str) -> DataFrame:
    """One query over these tables; as_of is an ISO timestamp. Their names hold for the time of analysis only."""
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    try:
        return spark.sql(sql(name, ":as_of", "TIMESTAMP_NTZ").replace(":as_of", "CAST(:as_of AS TIMESTAMP)"), args={"as_of": as_of})
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
