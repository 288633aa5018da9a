"""The `events` table as charging events in arrival order.

Arrivals are ordered by (event_time, event_no, copy); a station's arrivals share a log partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: The order of arrival.
ARRIVAL = ("event_time", "event_no", "copy")


def arrival() -> Column:
    return F.struct(*ARRIVAL)


def seconds(column: Column) -> Column:
    return F.make_dt_interval(secs=column)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed charging events: duplicates, late, out-of-order and invalid ones included."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k, u = F.get_json_object("props", "$.k").cast("bigint"), F.col("user_id")
    base = events.select(F.col("event_id").alias("event_no"), F.col("ts").cast("timestamp").alias("event_time"), u.alias("u"), F.col("event_type").alias("kind"), "value", k.alias("k"))
    own = Window.partitionBy("u").orderBy("event_time", "event_no")
    numbered = base.withColumn("starts", F.sum(F.when(F.col("kind") == "signup", 1).otherwise(0)).over(own)).withColumn("nth", F.row_number().over(own))
    is_ = lambda *x: F.col("event_type").isin(*x)
    k, value = F.col("k"), F.col("value")
    kind = F.when(F.col("kind") == "signup", "SESSION_START").when(F.col("kind") == "click", "METER_UPDATE").when(F.col("kind") == "view", "HEARTBEAT").when(F.col("kind") == "purchase", "SESSION_STOP").when(k < 80, "FAULT_ALERT").otherwise("STATUS_CHANGE")
    station = F.col("u") % 20
    out = numbered.withColumn("event_type", kind).select(
        F.concat(F.lit("evt-"), F.col("event_no")).alias("event_id"),
        "event_no",
        F.explode(F.when(F.col("event_no") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        "event_type",
        "event_time",
        (F.col("event_time") + seconds(F.lit(1))).alias("ingest_time"),
        (F.col("event_time") + seconds(F.when(k < 90, k).otherwise(k * 10))).alias("received_at"),
        F.concat(F.lit("ST-"), station).alias("station_id"),
        F.col("u").cast("string").alias("connector_id"),
        F.concat(F.lit("OP-"), station % 3).alias("operator_id"),
        F.when(~is_("HEARTBEAT") & (F.col("starts") > 0), F.concat("u", F.lit("-"), F.floor((F.col("starts") + 1) / 2))).alias("session_id"),
        F.greatest(F.lit(0), F.col("nth") - F.when(k % 10 == 0, 3).otherwise(0)).cast("bigint").alias("sequence_no"),
        F.when(k % 11 != 0, F.concat(F.lit("C"), station % 6)).alias("city"),
        F.concat(F.lit("X"), station % 2).alias("country"),
        F.when(is_("SESSION_START"), value * 2).alias("initial_meter_kwh"),
        F.when(is_("SESSION_START") & (k % 3 > 0), F.concat(F.lit("T"), k % 3)).alias("tariff_id"),
        F.when(is_("SESSION_START") & (k % 3 > 0), F.when(k % 3 == 1, 0.3).otherwise(0.45)).alias("tariff_eur_per_kwh"),
        F.when(is_("SESSION_START") & (k % 5 > 0) | is_("SESSION_STOP") & (k % 7 == 0), F.concat(F.lit("B"), k % 4)).alias("vehicle_brand"),
        F.when(is_("METER_UPDATE"), F.when(k % 29 == 0, -1.0).otherwise(value * 2)).alias("meter_kwh"),
        F.when(is_("METER_UPDATE"), F.when(k % 31 == 0, -1.0).otherwise(value / 10)).alias("energy_delta_kwh"),
        F.when(is_("METER_UPDATE") & (k % 13 != 0), value).alias("power_kw"),
        F.when(is_("SESSION_STOP"), value * 3).alias("final_meter_kwh"),
        F.when(is_("SESSION_STOP") & (k % 2 == 0), value).alias("total_energy_kwh"),
        F.when(is_("SESSION_STOP"), F.concat(F.lit("reason"), k % 3)).alias("end_reason"),
        F.when(is_("FAULT_ALERT"), F.concat(F.lit("F"), k % 5)).alias("fault_code"),
        F.when(is_("FAULT_ALERT"), F.when(k % 2 == 0, "high").otherwise("low")).alias("severity"),
        F.when(is_("STATUS_CHANGE"), F.when(k % 23 == 0, "").otherwise("charging")).alias("previous_status"),
        F.when(is_("STATUS_CHANGE"), F.when(k % 2 == 0, " Faulted ").otherwise("available")).alias("new_status"),
        F.when(is_("STATUS_CHANGE") & (k % 3 > 0), "overheat").alias("reason"),
        F.when(is_("HEARTBEAT"), F.when(k % 37 == 0, "").when(k % 4 == 0, "degraded").otherwise("available")).alias("charger_status"),
    )
    return out
