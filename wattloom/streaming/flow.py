"""The streaming flow: parse, deduplicate, admit, fold into sessions, write each micro-batch to its tables.

Every record of the log ends in one table: raw_events, late_events_rejected or dead_letter_events; only repeats of an
event id are dropped. A repeated micro-batch overwrites its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.schema import ALLOWED_LATENESS, DEDUP_TTL
from wattloom.operators import admission, parse, serving
from wattloom.operators.sessions import session_facts
from wattloom.sources import tables
from wattloom.sources.logs import Settings
from wattloom.streaming.sessions import fact_rows, session_stream


def deduplicated(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """The first event of each id within the watermark's delay; the state of older ids is dropped."""
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def first_of_ids(parsed_log: DataFrame, ttl: int = DEDUP_TTL) -> DataFrame:
    """Parsed records without repeats of a valid record's event id. The state of an id goes after `ttl` seconds of
    arrival; time is that of the micro-batch, so no record is too old to pass. Invalid records are told apart by their
    place in the log: each of them passes."""
    place = F.concat_ws(":", F.lit("\x00"), "topic", "partition", "offset")
    keyed = parsed_log.withColumn("once", F.when(F.col("error_reason").isNull(), parse.event_id()).otherwise(place))
    arrived = keyed.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", f"{max(60, ttl)} seconds")
    return arrived.dropDuplicatesWithinWatermark(["once"]).drop("once", "arrived")


def judged(events: DataFrame, allowed: int = ALLOWED_LATENESS) -> DataFrame:
    """Adds errors, lateness_seconds and lateness, row by row: before any watermark can drop a late event."""
    return events.withColumn("errors", admission.semantic_errors()).withColumn("lateness_seconds", admission.lateness_seconds()).withColumn("lateness", admission.lateness_class(allowed))


#: The columns of a dead letter, whatever stage it comes from.
LETTER = ("event_id", "event_type", "event_time", "ingest_time", "station_id", "connector_id", "operator_id", "session_id", "schema_version", "producer_id", "sequence_no", "error_reason", "raw_payload_json", "failed_at", "topic", "partition", "offset")


def write_admission(batch: DataFrame, batch_id: int, root: str, allowed: int = ALLOWED_LATENESS) -> None:
    """One micro-batch of parsed records to the three tables; each record goes to one of them."""
    batch = batch.persist()
    try:
        events = judged(parse.envelopes(batch), allowed)
        sound = events.where("size(errors) = 0").drop("errors")
        tables.append(sound.where("lateness != 'too_late_rejected'").drop("lateness"), root, "raw_events", batch_id)
        late = sound.where("lateness = 'too_late_rejected'").drop("lateness")
        tables.append(late.withColumn("rejected_at", F.col("received_at")).withColumn("rejection_reason", F.lit("too_late")), root, "late_events_rejected", batch_id)
        invalid = events.where("size(errors) > 0").withColumn("failed_at", F.col("received_at")).withColumn("error_reason", F.array_join("errors", "; "))
        letters = parse.dead_letters(batch).select(*LETTER).unionByName(invalid.withColumnRenamed("payload_json", "raw_payload_json").select(*LETTER))
        tables.append(letters, root, "dead_letter_events", batch_id)
    finally:
        batch.unpersist()


def start_admission(log: DataFrame, root: str, checkpoint: str, allowed: int = ALLOWED_LATENESS, ttl: int = DEDUP_TTL):
    """Run what there is of a log through parsing, deduplication and admission; offsets are kept in the checkpoint."""
    records = first_of_ids(parse.parsed(log), ttl)
    query = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: write_admission(b, i, root, allowed))
    return query.trigger(availableNow=True).start()


def start(log: DataFrame, root: str, checkpoint: str, settings: Settings = Settings()):
    """start_admission by settings."""
    return start_admission(log, root, checkpoint, settings.allowed_lateness, settings.dedup_ttl)


def write_facts(batch: DataFrame, batch_id: int, root: str) -> None:
    """Facts of closed sessions, and the events that their session's state refuses as dead letters."""
    batch = batch.persist()
    try:
        tables.append(session_facts(fact_rows(batch)), root, "fact_sessions", batch_id)
        refused = batch.where("kind = 'invalid'").select("session_id", "event_id", "error_reason", F.timestamp_micros("event_us").alias("failed_at"))
        tables.append(refused, root, "session_dead_letters", batch_id)
    finally:
        batch.unpersist()


def start_sessions(events: DataFrame, root: str, checkpoint: str, timeout: int = 900):
    """Fold admitted events into sessions, append the facts of those that close and the events refused."""
    query = session_stream(events, timeout).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return query.foreachBatch(lambda b, i: write_facts(b, i, root)).trigger(availableNow=True).start()


def write_state(batch: DataFrame, batch_id: int, root: str, keys: list[str]) -> dict[str, int]:
    """Latest-state rows of a micro-batch (one a key) applied to the table of the batch before; the counts of applied and
    of stale rows. Each batch writes a version of its own, so a repeat of it starts from the same rows."""
    spark = batch.sparkSession
    past = serving.last_version(spark, root, batch_id)
    batch = batch.persist()
    try:
        stored = batch.limit(0) if past is None else spark.read.schema(batch.schema).parquet(past)
        counts = serving.upsert_counts(stored, batch, keys)
        serving.guarded_upsert(stored, batch, keys).write.mode("overwrite").parquet(f"{root}/version={batch_id:012d}")
        return counts
    finally:
        batch.unpersist()


def minute_counts(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Station-minute counts, one row a window once the watermark has passed it."""
    return events.withWatermark("event_time", watermark).groupBy(F.window("event_time", "1 minute").alias("w"), "operator_id", "station_id").agg(F.count("*").alias("events_total"), F.size(F.collect_set("connector_id")).alias("connectors"))


def station_minutes(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Accepted events by minute, operator and station; energy and power of those that count (`metered`). One row a key,
    once the watermark has passed its minute."""
    kind = lambda x: F.count_if(F.col("event_type") == x)
    power = F.when(F.col("metered"), F.greatest(F.lit(0.0), "power_kw"))
    energy = F.when(F.col("metered"), F.greatest(F.lit(0.0), "energy_delta_kwh"))
    by = events.withWatermark("event_time", watermark).groupBy(F.window("event_time", "1 minute").alias("w"), "operator_id", "station_id")
    counts = by.agg(
        F.count("*").alias("events_total"), kind("METER_UPDATE").alias("meter_update_count"), kind("SESSION_START").alias("session_start_count"),
        kind("SESSION_STOP").alias("session_stop_count"), kind("FAULT_ALERT").alias("fault_count"), kind("HEARTBEAT").alias("heartbeat_count"),
        F.round(F.coalesce(F.sum(energy), F.lit(0.0)), 6).alias("energy_kwh_sum"), F.round(F.coalesce(F.avg(power), F.lit(0.0)), 6).alias("avg_power_kw"),
        F.round(F.coalesce(F.max(power), F.lit(0.0)), 6).alias("max_power_kw"),
    )
    return counts.select(F.col("w.start").alias("bucket_minute"), *(x for x in counts.columns if x != "w"))


def operator_hours(facts: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Finalised sessions at the hour of their end, by operator."""
    by = facts.withWatermark("session_end_time", watermark).groupBy(F.window("session_end_time", "1 hour").alias("w"), "operator_id")
    sums = by.agg(
        F.round(F.sum("energy_kwh_total"), 6).alias("energy_kwh_sum"), F.round(F.sum("revenue_eur_total"), 6).alias("revenue_eur_sum"),
        F.sum("is_complete").cast("bigint").alias("sessions_completed"), F.sum(1 - F.col("is_complete")).cast("bigint").alias("sessions_incomplete"),
        F.round(F.avg("duration_seconds"), 6).alias("avg_session_duration_seconds"),
    )
    return sums.select(F.col("w.start").alias("bucket_hour"), *(x for x in sums.columns if x != "w"))


def city_days(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Faults by day, operator, country and city with the commonest code, ties to the greatest: codes are counted first, and
    the counts of a day meet when it has passed."""
    known = lambda x: F.coalesce(F.when(F.col(x) != "", F.col(x)), F.lit("unknown"))
    faults = events.where("event_type = 'FAULT_ALERT'").withWatermark("event_time", watermark)
    keys = (known("country").alias("country_code"), known("city").alias("city"))
    codes = faults.groupBy(F.window("event_time", "1 day").alias("w"), "operator_id", *keys, known("fault_code").alias("code")).agg(F.count("*").alias("n"))
    days = codes.groupBy(F.window("w", "1 day").alias("day"), "operator_id", "country_code", "city")
    out = days.agg(F.sum("n").cast("bigint").alias("fault_count"), F.max_by("code", F.struct("n", "code")).alias("most_common_fault_code"))
    return out.select(F.to_date("day.start").alias("bucket_day"), "operator_id", "country_code", "city", "fault_count", "most_common_fault_code")
