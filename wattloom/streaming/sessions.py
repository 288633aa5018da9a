"""The session state machine as a stateful stream: one keyed state a session, event-time timers for idleness.

Deviation: a session expires when the watermark, not a wall clock, passes its last event by the timeout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from wattloom.functions.schema import DEFAULT_TARIFF, DEFAULT_TARIFF_ID, INACTIVITY_TIMEOUT

def _struct(ddl: str) -> T.StructType:
    kinds = {"string": T.StringType, "long": T.LongType, "double": T.DoubleType}
    return T.StructType([T.StructField(name, kinds[kind]()) for name, kind in (x.split() for x in ddl.split(", "))])


STATE = _struct("operator_id string, station_id string, connector_id string, city string, country string, started_us long, last_us long, start_event_id string, last_sequence_no long, meters long, energy double, power_sum double, power_samples long, power_max double, brand string, tariff_id string, tariff double, epoch long")
OUTPUT = _struct("session_id string, kind string, event_id string, error_reason string, event_us long, epoch long, operator_id string, station_id string, connector_id string, city string, country string, started_us long, last_event_us long, start_event_id string, stop_event_id string, vehicle_brand string, tariff_id string, tariff double, meter_update_count long, energy double, power_sum double, power_samples long, power_max double, stop_reason string, finalized_reason string")
_FIELDS = [f.name for f in STATE]


def transition(state: dict | None, e: dict, epoch: int) -> tuple[dict | None, str, str | None, dict | None]:
    """(state after, outcome, error, closing) of one event: the rules on a plain mapping, for tests as well."""
    kind, faulted = e["event_type"], (e.get("new_status") or "").strip().lower() == "faulted"
    errors = []
    if state is not None:
        errors += [f"session identity mismatch: {x}" for x in ("station_id", "connector_id", "operator_id") if state[x] != e[x]]
    if kind == "SESSION_START" and state is not None:
        errors.append("SESSION_START received for already-active session_id")
    if kind == "SESSION_STOP" and state is None:
        errors.append("SESSION_STOP without active session context is invalid")
    if errors:
        return state, "invalid", "; ".join(errors), None
    if kind == "SESSION_START":
        tariff = e.get("tariff_eur_per_kwh")
        new = {x: e.get(x) for x in ("operator_id", "station_id", "connector_id", "city", "country")}
        new |= {"started_us": e["us"], "last_us": e["us"], "start_event_id": e["event_id"], "last_sequence_no": e["sequence_no"], "meters": 0, "energy": 0.0, "power_sum": 0.0, "power_samples": 0, "power_max": 0.0}
        new |= {"brand": e.get("vehicle_brand"), "tariff_id": e.get("tariff_id") or DEFAULT_TARIFF_ID, "tariff": tariff if tariff is not None and tariff >= 0 else DEFAULT_TARIFF, "epoch": epoch + 1}
        return new, "session_started", None, None
    if kind == "METER_UPDATE":
        if state is None:
            return None, "session_not_found", None, None
        if e["sequence_no"] <= state["last_sequence_no"]:
            return state, "non_increasing_sequence", None, None
        power, new = e.get("power_kw"), dict(state)
        if power is not None and power >= 0:
            new |= {"power_sum": new["power_sum"] + power, "power_samples": new["power_samples"] + 1, "power_max": max(new["power_max"], power)}
        new |= {"last_us": max(new["last_us"], e["us"]), "last_sequence_no": e["sequence_no"], "meters": new["meters"] + 1, "energy": new["energy"] + e["energy_delta_kwh"]}
        return new, "session_meter_updated", None, None
    closes = kind in ("SESSION_STOP", "FAULT_ALERT") or kind == "STATUS_CHANGE" and faulted
    if not closes:
        return state, "no_session_mutation_for_event_type", None, None
    if state is None:
        return None, "session_not_found", None, None
    done = dict(state) | {"last_us": max(state["last_us"], e["us"]), "stop_event_id": e["event_id"]}
    if kind == "SESSION_STOP":
        done |= {"stop_reason": e.get("end_reason"), "brand": e.get("vehicle_brand") or done["brand"], "energy": e["total_energy_kwh"] if e.get("total_energy_kwh") is not None else done["energy"]}
    elif kind == "FAULT_ALERT":
        done["stop_reason"] = f"fault:{e.get('fault_code')}"
    else:
        done["stop_reason"] = f"status_fault:{e.get('reason') or 'status_change'}"
    reason = "normal_stop" if kind == "SESSION_STOP" else "fault_termination"
    return None, reason, None, done | {"finalized_reason": reason}


def _row(session_id, kind, event_id=None, error=None, s=None, us=None) -> Row:
    s = s or {}
    names = {"last_event_us": "last_us", "vehicle_brand": "brand", "meter_update_count": "meters"}
    values = {"session_id": session_id, "kind": kind, "event_id": event_id, "error_reason": error, "event_us": us}
    return Row(**{f.name: values.get(f.name, s.get(names.get(f.name, f.name))) for f in OUTPUT})


class SessionProcessor(StatefulProcessor):
    def __init__(self, timeout: int = INACTIVITY_TIMEOUT):
        self.timeout_ms = max(1, timeout) * 1000

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("session", STATE)
        self.epochs = handle.getValueState("epochs", _struct("n long"))

    def _rearm(self, last_us: int | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if last_us is not None:
            self.handle.registerTimer(last_us // 1000 + self.timeout_ms)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get() if self.state.exists() else None
        state = dict(zip(_FIELDS, held)) if held is not None else None
        epoch = self.epochs.get()[0] if self.epochs.exists() else 0
        for r in sorted((r.asDict() for r in rows), key=lambda r: (r["us"], r["event_no"], r["copy"])):
            state, outcome, error, done = transition(state, r, epoch)
            if outcome == "session_started":
                epoch = state["epoch"]
            yield _row(key[0], outcome, r["event_id"], error, state, r["us"])
            if done:
                yield _row(key[0], "fact", None, None, done)
        if state is None:
            self.state.clear()
        else:
            self.state.update(tuple(state[f] for f in _FIELDS))
        if epoch:
            self.epochs.update((epoch,))
        self._rearm(state["last_us"] if state else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            state = dict(zip(_FIELDS, self.state.get()))
            self.state.clear()
            yield _row(key[0], "fact", None, None, state | {"stop_reason": "inactivity_timeout", "finalized_reason": "inactivity_timeout"})

    def close(self):
        pass


def session_stream(events: DataFrame, timeout: int = INACTIVITY_TIMEOUT, watermark: str = "15 minutes") -> DataFrame:
    """Rows tagged by kind: an outcome for each event with a session id, and a fact for each closed session.

    Lateness must be judged before: the watermark drops late rows without a word."""
    keyed = events.where("session_id is not null and session_id != ''").withWatermark("event_time", watermark).withColumn("us", F.unix_micros("event_time"))
    return keyed.groupBy("session_id").transformWithState(SessionProcessor(timeout), OUTPUT, "Append", "EventTime")


def fact_rows(tagged: DataFrame) -> DataFrame:
    """The facts of the stream in the columns from which session_facts() works."""
    times = {"started_at": F.timestamp_micros("started_us"), "last_event_time": F.timestamp_micros("last_event_us")}
    return tagged.where("kind = 'fact'").withColumns(times)
