"""The session state machine over a batch of arrivals, as window functions; session facts.

A session id is active after a START and inactive after a stop, fault or faulted status, whatever
came before, so its state is that of the last such event: no recursion. While a session is open it has
the identity of its START; events that name another are errors and change nothing. Only for ids whose
STARTs name several identities does the state depend on what was refused before: those, and no others,
go through a fold of their sorted events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.functions.schema import DEFAULT_TARIFF, DEFAULT_TARIFF_ID, INACTIVITY_TIMEOUT
from wattloom.sources.adapter import ARRIVAL, seconds

c = F.col


def is_faulted(status: Column) -> Column:
    return F.lower(F.btrim(status)) == "faulted"


def _folded(events: DataFrame) -> DataFrame:
    """session_key, event_no, copy and the state before each event: whether the session is open, and its identity."""
    held = F.struct(*ARRIVAL, "candidate", "is_start", "is_end", "identity")
    none = F.lit(None).cast(events.schema["identity"].dataType)

    def step(state: Column, e: Column) -> Column:
        moves = e["candidate"] & (~state["open"] | (state["identity"] == e["identity"]))
        opens, ends = moves & e["is_start"] & ~state["open"], moves & e["is_end"] & state["open"]
        before = F.struct(e["event_no"].alias("event_no"), e["copy"].alias("copy"), state["open"].alias("open"), state["identity"].alias("identity"))
        return F.struct(
            F.when(opens, True).when(ends, False).otherwise(state["open"]).alias("open"),
            F.when(opens, e["identity"]).otherwise(state["identity"]).alias("identity"),
            F.array_append(state["seen"], before).alias("seen"),
        )

    empty = F.array().cast(f"array<struct<event_no:{events.schema['event_no'].dataType.simpleString()},copy:{events.schema['copy'].dataType.simpleString()},open:boolean,identity:{events.schema['identity'].dataType.simpleString()}>>")
    first = F.struct(F.lit(False).alias("open"), none.alias("identity"), empty.alias("seen"))
    folded = events.groupBy("session_key").agg(F.sort_array(F.collect_list(held)).alias("events"))
    folded = folded.select("session_key", F.explode(F.aggregate("events", first, step, lambda state: state["seen"])).alias("state"))
    return folded.select("session_key", "state.event_no", "state.copy", c("state.open").alias("f_open"), c("state.identity").alias("f_identity"))


def session_verdicts(admitted: DataFrame) -> DataFrame:
    """Adds active, all_errors, warning, accepted, applied, outcome and epoch to admitted arrivals.

    Events without a session id have no state; they are spread over partitions by their own id."""
    key = F.coalesce(F.when(c("session_id") != "", c("session_id")), F.concat(F.lit("\x00"), c("event_id")))
    own = Window.partitionBy("session_key").orderBy(*ARRIVAL)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    start = c("event_type") == "SESSION_START"
    closes = c("event_type").isin("SESSION_STOP", "FAULT_ALERT") | (c("event_type") == "STATUS_CHANGE") & is_faulted(c("new_status"))
    identity = F.struct("station_id", "connector_id", "operator_id")
    has = F.coalesce(c("session_id"), F.lit("")) != ""
    started = F.when(c("candidate") & start & has, identity)
    whole = Window.partitionBy("session_key")
    kept = admitted.withColumn("session_key", key).withColumn("identity", identity).withColumn("first_identity", F.min(started).over(whole))
    kept = kept.withColumn("mixed", F.coalesce(F.max(started).over(whole) != c("first_identity"), F.lit(False)))
    strange = c("first_identity").isNotNull() & (c("first_identity") != identity)
    kept = kept.withColumn("moves", c("candidate") & has & ~F.coalesce(strange, F.lit(False)))
    kept = kept.withColumn("active", F.coalesce(F.last(F.when(c("moves") & start, True).when(c("moves") & closes, False), ignorenulls=True).over(before), F.lit(False)))
    mixed = kept.where("mixed").select("session_key", *ARRIVAL, "candidate", start.alias("is_start"), closes.alias("is_end"), "identity")
    kept = kept.join(_folded(mixed), ["session_key", "event_no", "copy"], "left")
    kept = kept.withColumn("active", F.coalesce("f_open", "active")).withColumn("first_identity", F.when(c("mixed"), c("f_identity")).otherwise(c("first_identity"))).drop("f_open", "f_identity", "identity", "mixed")
    clash = lambda x: F.when(c("active") & (c(f"first_identity.{x}") != c(x)), f"session identity mismatch: {x}")
    stateful = F.array_compact(F.array(clash("station_id"), clash("connector_id"), clash("operator_id"), F.when(start & c("active"), "SESSION_START received for already-active session_id"), F.when((c("event_type") == "SESSION_STOP") & has & ~c("active"), "SESSION_STOP without active session context is invalid")))
    kept = kept.withColumn("all_errors", F.concat("errors", stateful)).withColumn("accepted", c("candidate") & (F.size("all_errors") == 0))
    kept = kept.withColumn("opens", c("accepted") & start & has).withColumn("ends", c("accepted") & has & closes & c("active")).withColumn("epoch", F.sum(F.when(c("opens"), 1).otherwise(0)).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    meter = c("event_type") == "METER_UPDATE"
    in_epoch = Window.partitionBy("session_key", "epoch").orderBy(*ARRIVAL)
    counted = F.when(c("opens") | c("accepted") & meter & c("active"), c("sequence_no"))
    kept = kept.withColumn("last_sequence", F.max(counted).over(in_epoch.rowsBetween(Window.unboundedPreceding, -1)))
    rises = c("sequence_no") > c("last_sequence")
    kept = kept.withColumn("metered", F.coalesce(c("accepted") & meter & c("active") & rises, F.lit(False))).withColumn("applied", c("opens") | c("ends") | c("metered"))
    warning = F.when(meter & has & ~c("active"), "METER_UPDATE without active session context; keep historical only").when(meter & has & ~rises, "METER_UPDATE sequence_no is not increasing; keep historical only")
    outcome = (
        F.when(~c("accepted"), F.when(c("duplicate"), "duplicate").when(F.size("all_errors") > 0, "invalid").otherwise("too_late"))
        .when(c("opens"), "session_started")
        .when(c("metered"), "session_meter_updated")
        .when(c("ends"), F.when(c("event_type") == "SESSION_STOP", "normal_stop").otherwise("fault_termination"))
        .when(meter, F.when(~c("active"), "session_not_found").otherwise("non_increasing_sequence"))
        .when(has & closes, "session_not_found")
        .otherwise("no_session_mutation_for_event_type")
    )
    return kept.withColumn("warning", F.when(~c("duplicate"), warning)).withColumn("outcome", outcome)


def snapshots(verdicts: DataFrame) -> DataFrame:
    """One row for each session and epoch: its state after all its events."""
    opens, metered, ends, stop = c("opens"), c("metered"), c("ends"), c("ends") & (c("event_type") == "SESSION_STOP")
    of = lambda flag, x: F.max(F.when(flag, x))  # noqa: E731  one row of an epoch has the flag
    order = F.struct(*ARRIVAL)
    power = F.when(metered & (c("power_kw") >= 0), c("power_kw"))
    stop_reason = F.when(c("event_type") == "SESSION_STOP", c("end_reason")).when(c("event_type") == "FAULT_ALERT", F.concat(F.lit("fault:"), "fault_code")).otherwise(F.concat(F.lit("status_fault:"), F.coalesce(F.when(c("reason") != "", c("reason")), F.lit("status_change"))))
    out = verdicts.where("applied").groupBy("session_id", "epoch").agg(
        *(of(opens, c(x)).alias(x) for x in ("operator_id", "station_id", "connector_id", "city", "country")),
        of(opens, c("event_time")).alias("started_at"),
        of(opens, c("event_id")).alias("start_event_id"),
        of(ends, c("event_id")).alias("stop_event_id"),
        F.coalesce(of(stop, F.when(c("vehicle_brand") != "", c("vehicle_brand"))), of(opens, c("vehicle_brand"))).alias("vehicle_brand"),
        F.coalesce(of(opens, F.when(c("tariff_id") != "", c("tariff_id"))), F.lit(DEFAULT_TARIFF_ID)).alias("tariff_id"),
        F.coalesce(of(opens, F.when(c("tariff_eur_per_kwh") >= 0, c("tariff_eur_per_kwh"))), F.lit(DEFAULT_TARIFF)).alias("tariff"),
        F.max("event_time").alias("last_event_time"),
        F.count_if(metered).alias("meter_update_count"),
        F.coalesce(of(stop, c("total_energy_kwh")), F.sum(F.when(metered, c("energy_delta_kwh"))), F.lit(0.0)).alias("energy"),
        F.sum(power).alias("power_sum"),
        F.count(power).alias("power_samples"),
        F.coalesce(F.max(power), F.lit(0.0)).alias("power_max"),
        F.max_by(F.coalesce(c("final_meter_kwh"), c("meter_kwh"), c("initial_meter_kwh")), F.when(opens | metered | stop, order)).alias("latest_meter_kwh"),
        F.max_by("power_kw", F.when(metered, order)).alias("latest_power_kw"),
        of(ends, stop_reason).alias("stop_reason"),
        of(ends, F.when(c("event_type") == "SESSION_STOP", "normal_stop").otherwise("fault_termination")).alias("finalized_reason"),
    )
    return out


def finalized(snapshot: DataFrame, as_of: Column, timeout: int = INACTIVITY_TIMEOUT) -> DataFrame:
    """Closed sessions, and those whose last event is `timeout` seconds or more before as_of."""
    idle = c("finalized_reason").isNull() & (c("last_event_time") <= as_of - seconds(F.lit(max(1, timeout))))
    expired = snapshot.withColumns({x: F.when(idle, "inactivity_timeout").otherwise(c(x)) for x in ("finalized_reason", "stop_reason")})
    return expired.where("finalized_reason is not null")


def session_facts(finalised: DataFrame) -> DataFrame:
    """One fact for each finalised session."""
    energy, zero = F.greatest(F.lit(0.0), "energy"), F.lit(0.0)
    duration = F.greatest(F.lit(0), F.floor((F.unix_micros("last_event_time") - F.unix_micros("started_at")) / 1_000_000)).cast("bigint")
    timed = finalised.withColumn("duration_seconds", duration).withColumn("energy_kwh_total", energy).withColumn("revenue_eur_total", F.round(energy * F.greatest(zero, "tariff"), 6))
    mean = F.when(c("power_samples") > 0, c("power_sum") / c("power_samples")).when(c("duration_seconds") > 0, c("energy_kwh_total") / (c("duration_seconds") / 3600.0)).otherwise(zero)
    reason = c("finalized_reason")
    return timed.select(
        "session_id", "operator_id", "station_id", "connector_id",
        c("started_at").alias("session_start_time"),
        F.greatest("started_at", "last_event_time").alias("session_end_time"),
        c("city").alias("location_city"), c("country").alias("location_country"),
        "vehicle_brand", "tariff_id", "duration_seconds", "energy_kwh_total", "revenue_eur_total", "meter_update_count",
        F.greatest(zero, "power_max").alias("peak_power_kw"),
        F.greatest(zero, mean).alias("avg_power_kw"),
        F.when(reason == "normal_stop", "completed").when(reason == "inactivity_timeout", "timeout").when(reason == "fault_termination", "fault_terminated").otherwise("incomplete").alias("session_completion_status"),
        F.when(reason == "fault_termination", "faulted").when(reason == "normal_stop", "available").otherwise("unknown").alias("final_station_status"),
        F.coalesce("stop_reason", reason).alias("stop_reason"),
        F.when(reason == "normal_stop", 1).otherwise(0).alias("is_complete"),
        F.when(reason == "inactivity_timeout", 1).otherwise(0).alias("is_timeout_finalized"),
        F.when(F.hour("started_at").between(16, 21), 1).otherwise(0).alias("peak_hour_flag"),
        F.when(c("energy_kwh_total") > 0, c("revenue_eur_total") / c("energy_kwh_total")).otherwise(zero).alias("revenue_per_kwh"),
        "start_event_id", "stop_event_id", "finalized_reason",
    )


def active_counts(verdicts: DataFrame) -> DataFrame:
    """Adds active_sessions: open sessions of the station after each accepted event.

    Running sums are taken over hours of a station, and within each hour, so that a busy station's
    events don't meet in one task."""
    step = F.when(c("opens"), 1).when(c("ends"), -1).otherwise(0)
    accepted = verdicts.where("accepted").withColumn("step", step).withColumn("bucket", F.date_trunc("HOUR", "event_time"))
    totals = accepted.groupBy("station_id", "bucket").agg(F.sum("step").alias("step"))
    earlier = totals.withColumn("base", F.coalesce(F.sum("step").over(Window.partitionBy("station_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("step")
    within = F.sum("step").over(Window.partitionBy("station_id", "bucket").orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, 0))
    return accepted.withColumn("within", within).join(earlier, ["station_id", "bucket"]).withColumn("active_sessions", F.greatest(F.lit(0), c("base") + c("within")).cast("bigint")).drop("within", "base", "step", "bucket")
