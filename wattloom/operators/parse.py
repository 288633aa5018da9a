"""Log records to validated envelopes: one pass of expressions, one error reason per bad record.

Text is parsed as the only element of a JSON array, so that trailing garbage makes it malformed.
Deviations: NaN and Infinity are malformed; a payload value of a wrong type is a schema error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.schema import EVENT_TYPES, NUMBER_FIELDS, PARSE_REASONS, PAYLOAD_FIELDS, REQUIRED_FIELDS, TEXT_FIELDS

c = F.col
#: ISO timestamps that are accepted: date and time to the second, a fraction, an optional zone.
_TIME = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?\s*$"


def settled(df: DataFrame, *names: str) -> DataFrame:
    """df with these columns worked out once: the optimiser doesn't copy their expressions into each later use."""
    rest = [x for x in df.columns if x not in names]
    return df.select(*rest, F.explode(F.array(F.struct(*names))).alias("settled")).select(*rest, *(c(f"settled.{x}").alias(x) for x in names))


def _get(path: str, kind: str = "variant") -> Column:
    return F.try_variant_get("body", path, kind)


def _kind(path: str) -> Column:
    """The JSON kind at a path: STRING, BIGINT, DECIMAL.., DOUBLE, BOOLEAN, OBJECT.., ARRAY.., VOID; null if absent."""
    return F.schema_of_variant(_get(path))


def _text(path: str) -> Column:
    return F.when(_kind(path) == "STRING", _get(path, "string"))


def _number(path: str) -> Column:
    kind = _kind(path)
    return F.when((kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE"), _get(path, "double")).when(kind == "BOOLEAN", _get(path, "boolean").cast("double"))


def event_id() -> Column:
    """The event id of a parsed record's body."""
    return _text("$.event_id")


def timestamp(text: Column) -> Column:
    return F.when(text.rlike(_TIME), F.try_to_timestamp(F.btrim(text)))


def _not_text(field: str) -> Column:
    text = _text(f"$.{field}")
    return F.when(text.isNull() | text.rlike(r"^\s*$"), F.lit(f"{field} must be a non-empty string"))


def _by_type(of) -> Column:
    """What `of` makes of the required and optional payload fields of the record's type; only that is worked out."""
    out = None
    for kind in EVENT_TYPES:
        value = of(*PAYLOAD_FIELDS[kind])
        out = F.when(c("event_type") == kind, value) if out is None else out.when(c("event_type") == kind, value)
    return out


def _names(fields: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, fields))


def _payload_errors() -> list[Column]:
    keys, start = c("payload_keys"), F.concat(F.lit("Invalid payload for "), "event_type")
    missing = F.array_except(_by_type(lambda needed, optional: _names(needed)), keys)
    extra = F.array_except(keys, _by_type(lambda needed, optional: _names(needed + optional)))
    wrong = _by_type(lambda needed, optional: F.array_compact(F.array(*(F.when(~_value_fits(f), F.lit(f)) for f in needed + optional))))
    return [F.when(F.size(x) > 0, F.concat(start, F.lit(text), F.array_join(F.array_sort(x), ", "))) for x, text in ((missing, ": missing "), (extra, ": unexpected "), (wrong, ": wrong type of "))]


def _value_fits(field: str) -> Column:
    kind = _kind(f"$.payload.{field}")
    if field in TEXT_FIELDS:
        return kind.isin("STRING", "VOID")
    if field == "recoverable":
        return kind.isin("BOOLEAN", "VOID")
    return (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "BOOLEAN", "VOID")


def parsed(log: DataFrame) -> DataFrame:
    """Adds text, body (the JSON object), error_reason and error_class to log records."""
    raw = c("value")
    text = F.make_valid_utf8(raw.cast("string"))
    base = log.withColumn("text", text).withColumn("whole", F.try_parse_json(F.concat(F.lit("["), F.col("text"), F.lit("]"))))
    base = settled(settled(base, "text", "whole").withColumn("body", F.when(F.try_variant_get("whole", "$[1]", "variant").isNull(), F.try_variant_get("whole", "$[0]", "variant"))), "body")
    parse_error = (
        F.when(raw.isNull(), "empty_message")
        .when(~F.is_valid_utf8(raw.cast("string")), "malformed_utf8")
        .when(c("text").rlike(r"^\s*$"), "empty_json")
        .when(c("body").isNull(), "malformed_json")
        .when(~F.schema_of_variant("body").startswith("OBJECT"), "event_must_be_json_object")
    )
    base = base.drop("whole").withColumn("parse_error", parse_error).withColumn("event_type", F.when(parse_error.isNull(), _text("$.event_type")))
    # The names of an object's fields come from the parsed value; the text is parsed once.
    names = lambda path: F.map_keys(_get(path, "map<string,variant>"))
    base = base.withColumn("keys", names("$")).withColumn("payload_keys", names("$.payload"))
    base = settled(base, "parse_error", "event_type", "keys", "payload_keys")
    missing = F.array_except(F.array(*map(F.lit, REQUIRED_FIELDS)), c("keys"))
    bad_time = lambda f: F.when(timestamp(_text(f"$.{f}")).isNull(), F.concat(F.lit(f"Invalid timestamp for {f}: "), _text(f"$.{f}")))
    sequence, session = _kind("$.sequence_no"), _kind("$.session_id")
    of = lambda f: F.when(~F.coalesce((k := _kind(f"$.location.{f}")).startswith("DECIMAL") | k.isin("BIGINT", "DOUBLE", "BOOLEAN", "VOID"), F.lit(True)), F.lit(f"location.{f} must be numeric when present"))
    # All checks in the order in which they count; what isn't there breaks none, so only the first is reported.
    schema_errors = F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", "))),
        _not_text("event_id"),
        _not_text("event_type"),
        F.when(~c("event_type").isin(*EVENT_TYPES), F.concat(F.lit("Invalid event_type: "), "event_type")),
        _not_text("event_time"),
        bad_time("event_time"),
        _not_text("ingest_time"),
        bad_time("ingest_time"),
        *(_not_text(f) for f in ("station_id", "connector_id", "operator_id", "schema_version", "producer_id")),
        F.when(~session.isin("STRING", "VOID"), F.lit("session_id must be null or string")),
        F.when(sequence != "BIGINT", F.lit("sequence_no must be an integer")),
        F.when(_get("$.sequence_no", "bigint") < 0, F.lit("sequence_no must be non-negative")),
        F.when(~_kind("$.payload").startswith("OBJECT"), F.lit("payload must be an object")),
        *_payload_errors(),
        F.when(~_kind("$.location").startswith("OBJECT"), F.lit("location must be an object")),
        of("latitude"),
        of("longitude"),
    )
    checked = base.withColumn("errors", F.array_compact(F.concat(F.array("parse_error"), F.when(c("parse_error").isNull(), schema_errors).otherwise(F.array(F.lit(None).cast("string"))))))
    out = settled(checked, "errors").withColumn("error_reason", F.get("errors", F.lit(0))).drop("parse_error", "errors", "keys", "payload_keys")
    return out.withColumn("error_class", F.when(c("error_reason").isin(*PARSE_REASONS), "parse").when(c("error_reason").isNotNull(), "schema"))


def envelopes(parsed_log: DataFrame) -> DataFrame:
    """The valid records as typed columns, payload fields flat and null where a type lacks them."""
    value = lambda f: (_text(f"$.payload.{f}") if f in TEXT_FIELDS else _number(f"$.payload.{f}")).alias(f)
    plain = [_text(f"$.{f}").alias(f) for f in ("event_id", "station_id", "connector_id", "operator_id", "session_id", "schema_version", "producer_id")]
    return parsed_log.where("error_reason is null").select(
        *plain, "event_type", timestamp(_text("$.event_time")).alias("event_time"), timestamp(_text("$.ingest_time")).alias("ingest_time"), _get("$.sequence_no", "bigint").alias("sequence_no"),
        _text("$.location.city").alias("city"), _text("$.location.country").alias("country"), _number("$.location.latitude").alias("latitude"), _number("$.location.longitude").alias("longitude"),
        *map(value, TEXT_FIELDS), *map(value, NUMBER_FIELDS), F.to_json(_get("$.payload")).alias("payload_json"), "topic", "partition", "offset", c("timestamp").alias("received_at"),
    )


def dead_letters(parsed_log: DataFrame) -> DataFrame:
    """What can be saved of the invalid records, with their place in the log."""
    text = lambda f: F.when(_get(f"$.{f}", "string") != "", _get(f"$.{f}", "string"))
    sequence = F.coalesce(_get("$.sequence_no", "bigint"), text("sequence_no").try_cast("bigint"))
    return parsed_log.where("error_reason is not null").select(
        F.coalesce(text("event_id"), F.lit("unknown")).alias("event_id"), F.coalesce(text("event_type"), F.lit("UNKNOWN")).alias("event_type"),
        timestamp(_text("$.event_time")).alias("event_time"), F.coalesce(timestamp(_text("$.ingest_time")), "timestamp").alias("ingest_time"),
        *(text(f).alias(f) for f in ("station_id", "connector_id", "operator_id", "session_id", "schema_version", "producer_id")),
        F.when(sequence >= 0, sequence).alias("sequence_no"), "error_reason", c("text").alias("raw_payload_json"), c("timestamp").alias("failed_at"), "topic", "partition", "offset",
    )


def dead_letter_messages(letters: DataFrame, routed_at: Column | None = None) -> DataFrame:
    """key and JSON value of each dead letter, as they go to a topic; routed_at is now unless given."""
    routed = F.current_timestamp() if routed_at is None else routed_at
    record = F.struct("error_reason", "failed_at", routed.alias("routed_at"), F.struct("topic", "partition", "offset").alias("source"), F.struct("event_id", "event_type", "station_id").alias("event"), "raw_payload_json")
    return letters.select(F.coalesce("station_id", "event_id").alias("key"), F.to_json(record).alias("value"))


def to_log(events: DataFrame, topic: str = "raw") -> DataFrame:
    """Arrivals as log records: JSON values, a station's records in one partition; used by tests and queries."""
    payload = F.lit(None).cast("string")
    columns = set(events.columns)
    for kind in EVENT_TYPES:
        needed, optional = PAYLOAD_FIELDS[kind]
        fields = F.to_json(F.struct(*(c(f) for f in needed + optional if f in columns)))
        payload = F.when(c("event_type") == kind, fields).otherwise(payload)
    iso = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    head = F.to_json(F.struct("event_id", "event_type", iso("event_time").alias("event_time"), iso("ingest_time").alias("ingest_time"), "station_id", "connector_id", "operator_id", "session_id", F.lit("1.0").alias("schema_version"), F.lit("sim").alias("producer_id"), "sequence_no", F.struct("city", "country").alias("location")), {"ignoreNullFields": "false"})
    value = F.concat(F.regexp_replace(head, r"\}$", ',"payload":'), payload, F.lit("}"))
    return events.select(c("station_id").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit(topic).alias("topic"), F.pmod(F.xxhash64("station_id"), F.lit(6)).cast("int").alias("partition"), c("event_no").alias("offset"), c("received_at").alias("timestamp"))
