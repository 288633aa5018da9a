"""Synthetic charging in detail: a battery's curve minute by minute, heartbeats, faults with recovery, all six event types.

Each row makes its own events from hashes of its keys; only a session's curve is a fold, over its own minutes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.generator import chance, weighted_choice

c = F.col
#: A battery's capacity by brand in kWh; the share of its power that a charger gives by state of charge: all
#: of it below the first bound, a share up to the second, then less and less, but never under the least.
CAPACITY = {"Tesla": 75.0, "Renault": 52.0, "BMW": 80.0, "Togg": 88.0}
FULL_BELOW, SHARE_BELOW, SHARE, LEAST = 50.0, 80.0, 0.72, 0.1
#: Fault codes and severities with their weights, and minutes until a charger recovers.
FAULTS = {"OVERHEAT": 3, "GROUND_FAULT": 1, "COMM_LOSS": 4, "CONNECTOR_LOCK": 2}
SEVERITIES, RECOVERY = {"low": 5, "medium": 3, "high": 2}, (2, 20)
#: Heartbeats: seconds between two of a station, how far each may be off as a share, and the least distance.
HEARTBEAT_S, JITTER, LEAST_S = 60.0, 0.15, 5.0


def capacity(brand: Column) -> Column:
    out = F.lit(60.0)
    for name, kwh in CAPACITY.items():
        out = F.when(brand == name, kwh).otherwise(out)
    return out


def power_share(soc: Column) -> Column:
    """The share of the charger's power that a battery takes at a state of charge in percent."""
    return F.when(soc < FULL_BELOW, 1.0).when(soc < SHARE_BELOW, SHARE).otherwise(F.greatest(F.lit(LEAST), (100 - soc) / 100))


def curve(sessions: DataFrame, step_s: int = 60) -> DataFrame:
    """Sessions with `steps`: for each step its energy, meter, power, state of charge, voltage and current. A battery takes
    no more than fits; a session of no minutes has one step."""
    kwh = capacity(c("vehicle_brand"))
    n = F.greatest(F.lit(1), F.floor(c("minutes") * 60 / step_s)).cast("int")
    kind = "array<struct<energy:double,meter:double,power:double,soc:double>>"
    first = F.struct(c("soc_start").cast("double").alias("soc"), F.lit(0.0).alias("meter"), F.array().cast(kind).alias("seen"))

    def step(state: Column, _: Column) -> Column:
        power = F.round(c("power_kw") * power_share(state["soc"]), 3)
        energy = F.round(F.least(power * step_s / 3600, F.greatest(F.lit(0.0), (100 - state["soc"]) / 100 * kwh)), 6)
        soc, meter = F.least(F.lit(100.0), state["soc"] + energy / kwh * 100), F.round(state["meter"] + energy, 6)
        row = F.struct(energy.alias("energy"), meter.alias("meter"), power.alias("power"), F.round(soc, 4).alias("soc"))
        return F.struct(soc.alias("soc"), meter.alias("meter"), F.array_append(state["seen"], row).alias("seen"))

    return sessions.withColumn("steps", F.aggregate(F.sequence(F.lit(1), n), first, step, lambda state: state["seen"]))


def _event(kind: str | Column, at: Column, **fields: Column) -> Column:
    """An event as a struct: the envelope's own columns and those of any payload, null where a type has none."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    known = {
        "sequence_no": "bigint", "session_id": "string", "vehicle_brand": "string", "initial_meter_kwh": "double", "soc_start_percent": "double",
        "meter_kwh": "double", "energy_delta_kwh": "double", "power_kw": "double", "soc_percent": "double", "voltage_v": "double", "current_a": "double",
        "final_meter_kwh": "double", "total_energy_kwh": "double", "duration_seconds": "double", "final_soc_percent": "double", "end_reason": "string",
        "previous_status": "string", "new_status": "string", "reason": "string", "charger_status": "string", "active_session_count": "double",
        "fault_code": "string", "severity": "string", "recoverable": "boolean",
    }
    return F.struct(kind.alias("event_type"), at.alias("event_time"), *(fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in known.items()))


def _after(at: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(at) + (seconds.cast("double") * 1_000_000).cast("bigint"))


def session_events(sessions: DataFrame, step_s: int = 60, fault_rate: float = 0.02, seed: int = 41) -> DataFrame:
    """START, meter updates, and the end of each session: a STOP once it is over or the battery is full, or a fault on the
    way, after which the connector is faulted, recovers and is available again. One row an event, in order."""
    made = curve(sessions, step_s)
    u = lambda k: chance(seed, k, "session_id")
    n = F.size("steps")
    full = F.array_position(F.transform("steps", lambda x: x["soc"] >= 100), True)
    last = F.when(full > 0, F.least(full, n)).otherwise(n).cast("int")
    made = made.withColumn("fails", u(1) < fault_rate).withColumn("last", F.when(u(1) < fault_rate, F.ceil(u(2) * last)).otherwise(last).cast("int"))
    own = {"session_id": c("session_id"), "vehicle_brand": c("vehicle_brand")}
    volts = F.lit(400.0)
    start = F.array(_event("SESSION_START", c("started_at"), sequence_no=F.lit(0), initial_meter_kwh=F.lit(0.0), soc_start_percent=c("soc_start"), **own))
    meter = F.transform(
        F.slice("steps", F.lit(1), c("last")),
        lambda x, i: _event(
            "METER_UPDATE", _after(c("started_at"), (i + 1) * step_s), sequence_no=i + 1, meter_kwh=x["meter"], energy_delta_kwh=x["energy"], power_kw=x["power"],
            soc_percent=x["soc"], voltage_v=volts, current_a=F.round(x["power"] * 1000 / volts, 3), **own,
        ),
    )
    end, final = _after(c("started_at"), c("last") * step_s + 1), F.element_at("steps", c("last"))
    reason = F.when(full.between(1, c("last")), "battery_full").otherwise("user_stop")
    stop = F.array(_event("SESSION_STOP", end, sequence_no=c("last") + 1, final_meter_kwh=final["meter"], total_energy_kwh=final["meter"], duration_seconds=(c("last") * step_s + 1), final_soc_percent=final["soc"], end_reason=reason, **own))
    back = _after(end, (RECOVERY[0] + (RECOVERY[1] - RECOVERY[0]) * u(3)) * 60)
    code, severity = weighted_choice(FAULTS, u(4)), weighted_choice(SEVERITIES, u(5))
    fault = F.array(
        _event("FAULT_ALERT", end, sequence_no=c("last") + 1, fault_code=code, severity=severity, recoverable=F.lit(True), **own),
        _event("STATUS_CHANGE", _after(end, F.lit(1)), sequence_no=c("last") + 2, previous_status=F.lit("charging"), new_status=F.lit("faulted"), reason=code),
        _event("STATUS_CHANGE", back, sequence_no=c("last") + 3, previous_status=F.lit("faulted"), new_status=F.lit("available"), reason=F.lit("recovered")),
    )
    events = F.concat(start, meter, F.when(c("fails"), fault).otherwise(stop))
    place = ("station_id", "connector_id", "operator_id", "city")
    rows = made.select(*place, F.col("session_id").alias("of"), F.posexplode(events).alias("nth", "event"))
    return rows.select(F.concat_ws("-", "of", "nth").alias("event_id"), *place, "event.*")


def heartbeats(connectors: DataFrame, seconds: int, start: str = "2026-01-01 00:00:00", every_s: float = HEARTBEAT_S, seed: int = 43) -> DataFrame:
    """Heartbeats of each station over a time: at every interval, off by up to a share of it, and never closer than the least."""
    every_s = max(LEAST_S / (1 - 2 * JITTER), every_s)
    stations = connectors.groupBy("station_id").agg(F.min("operator_id").alias("operator_id"), F.min("city").alias("city"), F.min("connector_id").alias("connector_id"))
    ticks = stations.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(max(0, int(seconds / every_s) - 1)))))
    off = (2 * chance(seed, 1, "station_id", "nth") - 1) * JITTER
    at = _after(F.lit(start).cast("timestamp"), (c("nth") + 0.5 + off) * every_s)
    event = _event("HEARTBEAT", at, sequence_no=c("nth"), charger_status=F.lit("available"), active_session_count=F.lit(0))
    return ticks.select(F.concat_ws("-", F.lit("H"), "station_id", "nth").alias("event_id"), "station_id", "connector_id", "operator_id", "city", event.alias("event")).select("event_id", "station_id", "connector_id", "operator_id", "city", "event.*")


def fixed_starts(idle: int, active: int, wanted: int, rate: float) -> int:
    """Starts of a tick without pacing: a share of the idle connectors, and no more than are wanted open."""
    return max(0, min(idle, wanted - active, round(idle * min(1.0, max(0.0, rate)))))


def distribution(config: dict, name: str, default: dict[str, float]) -> dict[str, float]:
    """The weights that a configuration gives for a name, as shares that sum to one. It may hold a mapping of items to
    weights or a list of items with `name` and `weight`; what is missing, empty or without a positive weight is the default."""
    given = config.get(name)
    if isinstance(given, list):
        given = {str(x["name"]): x.get("weight", 1.0) for x in given if isinstance(x, dict) and "name" in x}
    if not isinstance(given, dict):
        given = {}
    held = {}
    for item, weight in given.items():
        try:
            held[str(item)] = max(0.0, float(weight))
        except (TypeError, ValueError):
            raise ValueError(f"{name}: the weight of {item} is no number") from None
    if sum(held.values()) <= 0:
        held = dict(default)
    total = sum(held.values())
    return {item: weight / total for item, weight in held.items()}
