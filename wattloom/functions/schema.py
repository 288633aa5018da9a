"""Types and fixed values of the charging event model."""

from __future__ import annotations

from pyspark.sql import types as T

#: The event types, in the order in which they are listed.
EVENT_TYPES = ("SESSION_START", "METER_UPDATE", "STATUS_CHANGE", "SESSION_STOP", "HEARTBEAT", "FAULT_ALERT")
#: The fields that every envelope has, in the order in which missing ones are reported.
REQUIRED_FIELDS = ("event_id", "event_type", "event_time", "ingest_time", "station_id", "connector_id", "operator_id", "session_id", "schema_version", "producer_id", "sequence_no", "location", "payload")
#: Required, then optional payload fields of each event type.
PAYLOAD_FIELDS = {
    "SESSION_START": (("initial_meter_kwh",), ("auth_method", "vehicle_id", "vehicle_brand", "vehicle_model", "tariff_id", "tariff_eur_per_kwh", "soc_start_percent", "target_soc_percent")),
    "METER_UPDATE": (("meter_kwh", "energy_delta_kwh"), ("power_kw", "soc_percent", "voltage_v", "current_a")),
    "STATUS_CHANGE": (("previous_status", "new_status"), ("reason",)),
    "SESSION_STOP": (("final_meter_kwh", "end_reason"), ("duration_seconds", "total_energy_kwh", "final_soc_percent", "vehicle_brand", "vehicle_model")),
    "HEARTBEAT": (("charger_status",), ("firmware_version", "active_session_count", "faulted_connector_count")),
    "FAULT_ALERT": (("fault_code", "severity"), ("message", "recoverable")),
}
TEXT_FIELDS = ("auth_method", "vehicle_id", "vehicle_brand", "vehicle_model", "tariff_id", "previous_status", "new_status", "reason", "end_reason", "charger_status", "firmware_version", "fault_code", "severity", "message")
NUMBER_FIELDS = ("initial_meter_kwh", "tariff_eur_per_kwh", "soc_start_percent", "target_soc_percent", "meter_kwh", "energy_delta_kwh", "power_kw", "soc_percent", "voltage_v", "current_a", "final_meter_kwh", "duration_seconds", "total_energy_kwh", "final_soc_percent", "active_session_count", "faulted_connector_count")
#: Reasons of the parse stage; any other reason is of the schema stage.
PARSE_REASONS = ("empty_message", "malformed_utf8", "empty_json", "malformed_json", "event_must_be_json_object")
#: Tariff of a session that names none, lateness and time limits in seconds.
DEFAULT_TARIFF_ID, DEFAULT_TARIFF = "default", 0.35
ALLOWED_LATENESS, INACTIVITY_TIMEOUT, DEDUP_TTL, SESSION_TTL, FINAL_TTL = 600, 900, 86400, 86400, 3600

LOCATION = T.StructType([T.StructField("city", T.StringType()), T.StructField("country", T.StringType()), T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
#: One wide payload: the fields of all six types, null where a type lacks one.
PAYLOAD = T.StructType([*(T.StructField(n, T.StringType()) for n in TEXT_FIELDS), *(T.StructField(n, T.DoubleType()) for n in NUMBER_FIELDS), T.StructField("recoverable", T.BooleanType())])
#: The columns of a log source, whatever it reads.
LOG = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType())])
