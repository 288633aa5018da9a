"""Station-minute, operator-hour and city-day rollups. One row a key; sums are partial before they shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.sources.adapter import arrival

c = F.col


def with_session_tariff(counted: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Adds the tariff of the session that an applied meter update belongs to."""
    tariffs = snapshot.select(c("session_id").alias("session_key"), "epoch", "tariff")
    return counted.join(tariffs, ["session_key", "epoch"], "left")


def station_minute(events: DataFrame, facts: DataFrame) -> DataFrame:
    """Accepted events (with active_sessions and tariff) by minute, operator and station, and finalised
    sessions at their end minute."""
    kind = lambda x: F.when(c("event_type") == x, 1).otherwise(0)
    power = F.when(c("metered"), F.greatest(F.lit(0.0), "power_kw"))
    power = F.when(c("power_kw").isNotNull(), power)
    energy = F.when(c("metered"), F.greatest(F.lit(0.0), "energy_delta_kwh")).otherwise(0.0)
    rows = events.select(
        F.date_trunc("MINUTE", "event_time").alias("bucket_minute"), "operator_id", "station_id", "city", "country",
        F.struct(F.lit(0).alias("later"), *arrival_fields()).alias("came"),
        F.lit(1).alias("one"), kind("METER_UPDATE").alias("m"), kind("SESSION_START").alias("s"), kind("SESSION_STOP").alias("e"), kind("FAULT_ALERT").alias("f"), kind("HEARTBEAT").alias("h"),
        energy.alias("energy"), (energy * F.greatest(F.lit(0.0), F.coalesce("tariff", F.lit(0.0)))).alias("revenue"), power.alias("power"), power.alias("peak"), c("active_sessions").alias("open"),
    )
    ends = facts.select(
        F.date_trunc("MINUTE", "session_end_time").alias("bucket_minute"), "operator_id", "station_id", c("location_city").alias("city"), c("location_country").alias("country"),
        F.struct(F.lit(1).alias("later"), c("session_end_time").alias("event_time"), F.lit(0).cast("bigint").alias("event_no"), F.lit(0).alias("copy")).alias("came"),
        F.lit(0).alias("one"), F.lit(0).alias("m"), F.lit(0).alias("s"), F.when(c("finalized_reason") == "normal_stop", 0).otherwise(1).alias("e"), F.lit(0).alias("f"), F.lit(0).alias("h"),
        F.lit(0.0).alias("energy"), F.lit(0.0).alias("revenue"), F.lit(None).cast("double").alias("power"), c("peak_power_kw").alias("peak"), F.lit(0).cast("bigint").alias("open"),
    )
    total = lambda x: F.sum(x).cast("bigint")
    return rows.unionByName(ends).groupBy("bucket_minute", "operator_id", "station_id").agg(
        F.min_by(F.struct("city", "country"), "came").alias("place"),
        total("one").alias("events_total"), total("m").alias("meter_update_count"), total("s").alias("session_start_count"), total("e").alias("session_stop_count"), total("f").alias("fault_count"), total("h").alias("heartbeat_count"),
        F.round(F.sum("energy"), 6).alias("energy_kwh_sum"), F.round(F.sum("revenue"), 6).alias("revenue_eur_sum"), F.round(F.coalesce(F.avg("power"), F.lit(0.0)), 6).alias("avg_power_kw"), F.round(F.greatest(F.lit(0.0), F.coalesce(F.max("peak"), F.lit(0.0))), 6).alias("max_power_kw"), F.max("open").alias("active_connector_estimate"),
    ).select("bucket_minute", "operator_id", "station_id", c("place.city").alias("city"), c("place.country").alias("country_code"), "events_total", "meter_update_count", "session_start_count", "session_stop_count", "fault_count", "heartbeat_count", "energy_kwh_sum", "revenue_eur_sum", "avg_power_kw", "max_power_kw", "active_connector_estimate")


def arrival_fields() -> list:
    return [c(x) for x in ("event_time", "event_no", "copy")]


def operator_hour(events: DataFrame, facts: DataFrame) -> DataFrame:
    """Finalised sessions at the hour of their end and faults at theirs, by operator."""
    ends = facts.select(F.date_trunc("HOUR", "session_end_time").alias("bucket_hour"), "operator_id", "station_id", c("energy_kwh_total").alias("energy"), c("revenue_eur_total").alias("revenue"), c("is_complete").alias("done"), (1 - c("is_complete")).alias("undone"), F.lit(0).alias("fault"), c("duration_seconds").alias("duration"))
    faults = events.where("event_type = 'FAULT_ALERT'").select(F.date_trunc("HOUR", "event_time").alias("bucket_hour"), "operator_id", "station_id", F.lit(0.0).alias("energy"), F.lit(0.0).alias("revenue"), F.lit(0).alias("done"), F.lit(0).alias("undone"), F.lit(1).alias("fault"), F.lit(None).cast("bigint").alias("duration"))
    return ends.unionByName(faults).groupBy("bucket_hour", "operator_id").agg(
        F.round(F.sum("energy"), 6).alias("energy_kwh_sum"), F.round(F.sum("revenue"), 6).alias("revenue_eur_sum"), F.sum("done").cast("bigint").alias("sessions_completed"), F.sum("undone").cast("bigint").alias("sessions_incomplete"), F.sum("fault").cast("bigint").alias("fault_count"), F.count_distinct("station_id").alias("distinct_station_count"), F.round(F.coalesce(F.avg("duration"), F.lit(0.0)), 6).alias("avg_session_duration_seconds"),
    )


def city_day_faults(events: DataFrame) -> DataFrame:
    """Faults by UTC day, operator, country and city; the commonest code, ties to the greatest."""
    known = lambda x: F.coalesce(F.when(c(x) != "", c(x)), F.lit("unknown"))
    faults = events.where("event_type = 'FAULT_ALERT'").select(F.to_date("event_time").alias("bucket_day"), "operator_id", known("country").alias("country_code"), known("city").alias("city"), "station_id", known("fault_code").alias("code"))
    keys = ["bucket_day", "operator_id", "country_code", "city"]
    codes = faults.groupBy(*keys, "code").agg(F.count("*").alias("n"))
    most = codes.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("fault_count"), F.max_by("code", F.struct("n", "code")).alias("most_common_fault_code"))
    stations = faults.groupBy(*keys).agg(F.count_distinct("station_id").alias("distinct_station_count"))
    return most.join(stations, keys).select(*keys, "fault_count", "distinct_station_count", "most_common_fault_code")
