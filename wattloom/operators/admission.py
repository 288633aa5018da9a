"""What admits an event: deduplication, stateless semantic rules, lateness, disposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.functions.schema import ALLOWED_LATENESS

c = F.col


def first_wins(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("event_time", "event_no", "copy")) -> DataFrame:
    """Adds `duplicate`: whether an earlier arrival has the key. One shuffle, on a key that is all but unique."""
    return events.withColumn("duplicate", F.row_number().over(Window.partitionBy(key).orderBy(*order)) > 1)


def not_committed(events: DataFrame, committed: DataFrame, key: str = "event_id") -> DataFrame:
    """Events whose key is not among those committed before."""
    return events.join(committed.select(key), key, "left_anti")


def _rule(broken: Column, text: Column | str) -> Column:
    return F.when(broken, F.lit(text) if isinstance(text, str) else text)


def semantic_errors() -> Column:
    """The messages of all broken stateless rules, in order."""
    kind, empty = c("event_type"), lambda x: F.coalesce(c(x), F.lit("")) == ""
    start, meter, stop = (kind == x for x in ("SESSION_START", "METER_UPDATE", "SESSION_STOP"))
    below = lambda which, field, name=None: _rule(which & (c(field) < 0), f"{name} payload.{field} must be non-negative")
    return F.array_compact(
        F.array(
            _rule((start | meter | stop) & empty("session_id"), F.concat(F.lit("session_id is required for "), kind)),
            below(start, "initial_meter_kwh", "SESSION_START"),
            below(start, "tariff_eur_per_kwh", "SESSION_START"),
            _rule(meter & (c("sequence_no") <= 0), "METER_UPDATE sequence_no must be > 0"),
            below(meter, "meter_kwh", "METER_UPDATE"),
            below(meter, "energy_delta_kwh", "METER_UPDATE"),
            below(meter, "power_kw", "METER_UPDATE"),
            below(stop, "final_meter_kwh", "SESSION_STOP"),
            below(stop, "total_energy_kwh", "SESSION_STOP"),
            _rule((kind == "HEARTBEAT") & empty("charger_status"), "HEARTBEAT payload.charger_status must be non-empty"),
            _rule((kind == "STATUS_CHANGE") & (empty("previous_status") | empty("new_status")), "STATUS_CHANGE previous_status and new_status must be non-empty"),
            _rule((kind == "FAULT_ALERT") & empty("fault_code"), "FAULT_ALERT payload.fault_code must be non-empty"),
            _rule((kind == "FAULT_ALERT") & empty("severity"), "FAULT_ALERT payload.severity must be non-empty"),
        )
    )


def lateness_seconds() -> Column:
    """Whole seconds by which an event came late; 0 if less than one or early."""
    return F.greatest(F.lit(0), F.floor((F.unix_micros("received_at") - F.unix_micros("event_time")) / 1_000_000)).cast("bigint")


def lateness_class(allowed: int = ALLOWED_LATENESS) -> Column:
    late = c("lateness_seconds")
    return F.when(late <= 0, "on_time").when(late <= max(1, allowed), "accepted_late").otherwise("too_late_rejected")


def admitted(events: DataFrame, allowed: int = ALLOWED_LATENESS) -> DataFrame:
    """Adds duplicate, errors, lateness_seconds, lateness and candidate: an event that may change a session."""
    out = first_wins(events).withColumn("errors", semantic_errors()).withColumn("lateness_seconds", lateness_seconds()).withColumn("lateness", lateness_class(allowed))
    return out.withColumn("candidate", ~c("duplicate") & (F.size("errors") == 0) & (c("lateness") != "too_late_rejected"))


#: For each disposition, which sinks get the event: raw, dead letter, late table, rollups, sessions, serving.
DISPOSITIONS = [("accepted", 1, 0, 0, 1, 1, 1), ("invalid", 0, 1, 0, 0, 0, 0), ("duplicate", 0, 0, 0, 0, 0, 0), ("too_late", 0, 0, 1, 0, 0, 0)]
DISPOSITION_COLUMNS = ["disposition", "to_raw", "to_dead_letter", "to_late", "to_rollups", "to_sessions", "to_serving"]
