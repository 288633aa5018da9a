"""Latest-state tables: station, connector and session hashes, with an out-of-order guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.functions.schema import DEFAULT_TARIFF, DEFAULT_TARIFF_ID, FINAL_TTL, SESSION_TTL
from wattloom.operators.sessions import is_faulted
from wattloom.sources.adapter import ARRIVAL, arrival

c = F.col
#: Statuses that raise a station's fault flag.
FAULT_STATUSES = ("faulted", "degraded", "error")


def station_status() -> Column:
    kind = c("event_type")
    return F.when(kind == "STATUS_CHANGE", c("new_status")).when(kind == "HEARTBEAT", c("charger_status")).when(kind == "FAULT_ALERT", "faulted").when(kind.isin("SESSION_START", "METER_UPDATE"), "charging").when(kind == "SESSION_STOP", "available").otherwise("unknown")


def serving_inputs(events: DataFrame) -> DataFrame:
    """Adds to accepted events, with active_sessions, what the hashes need of their session as it then was."""
    so_far = Window.partitionBy("session_key", "epoch").orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, 0)
    has = c("opens") | c("metered") | c("ends") | c("active")
    latest = lambda flag, x: F.last(F.when(flag, F.struct(x.alias("x"))), ignorenulls=True).over(so_far)["x"]
    power = F.when(c("metered") & (c("power_kw") >= 0), c("power_kw"))
    stop = c("ends") & (c("event_type") == "SESSION_STOP")
    out = events.withColumn("has_session", has)
    out = out.withColumn("s_power", latest(c("metered"), c("power_kw"))).withColumn("s_meter", latest(c("opens") | c("metered") | stop, F.coalesce("final_meter_kwh", "meter_kwh", "initial_meter_kwh")))
    out = out.withColumn("s_brand", F.last(F.when((c("opens") | stop) & (c("vehicle_brand") != ""), c("vehicle_brand")), ignorenulls=True).over(so_far)).withColumn("s_count", F.count(F.when(c("metered"), 1)).over(so_far)).withColumn("s_max", F.coalesce(F.max(power).over(so_far), F.lit(0.0)))
    out = out.withColumn("s_energy", F.coalesce(F.when(stop, c("total_energy_kwh")), F.sum(F.when(c("metered"), c("energy_delta_kwh"))).over(so_far), F.lit(0.0))).withColumn("s_started", latest(c("opens"), c("event_time"))).withColumn("s_last", F.max(F.when(c("applied"), c("event_time"))).over(so_far))
    out = out.withColumn("s_tariff_id", F.coalesce(latest(c("opens"), F.when(c("tariff_id") != "", c("tariff_id"))), F.lit(DEFAULT_TARIFF_ID))).withColumn("s_tariff", F.coalesce(latest(c("opens"), F.when(c("tariff_eur_per_kwh") >= 0, c("tariff_eur_per_kwh"))), F.lit(DEFAULT_TARIFF)))
    return out


def _latest(rows: DataFrame, *keys: str, newest: tuple[str, ...] = ()) -> DataFrame:
    """Latest row of a key by event time in milliseconds; ties go to the last arrival. A partial maximum, no window. The
    columns `newest` are the maxima of all rows of the key: what a later row doesn't tell stays."""
    rest = [x for x in rows.columns if x not in (*keys, *newest, "came")]
    latest = F.max_by(F.struct(*rest), F.struct(F.unix_millis("event_time"), "came")).alias("r")
    picked = rows.groupBy(*keys).agg(latest, *(F.max(x).alias(x) for x in newest))
    return picked.select(*keys, *(c(f"r.{x}").alias(x) for x in rest), *newest)


def _power() -> Column:
    return F.greatest(F.lit(0.0), F.coalesce(F.when(c("metered"), c("power_kw")), F.when(c("has_session"), c("s_power")), F.lit(0.0)))


def station_state(inputs: DataFrame) -> DataFrame:
    status = station_status()
    rows = inputs.select("station_id", arrival().alias("came"), "event_time", "operator_id", status.alias("current_status"), _power().alias("latest_power_kw"), c("active_sessions").alias("active_session_count"), F.when(F.lower(F.btrim(status)).isin(*FAULT_STATUSES), 1).otherwise(0).alias("fault_flag"), F.coalesce("city", F.lit("")).alias("city"), F.coalesce("country", F.lit("")).alias("country"), F.when(c("event_type") == "HEARTBEAT", c("event_time")).alias("last_heartbeat_time"))
    return _latest(rows, "station_id", newest=("last_heartbeat_time",))


def connector_state(inputs: DataFrame) -> DataFrame:
    gone = c("event_type").isin("SESSION_STOP", "FAULT_ALERT") | (c("event_type") == "STATUS_CHANGE") & is_faulted(c("new_status"))
    meter = F.greatest(F.lit(0.0), F.coalesce(F.when(c("metered"), c("meter_kwh")), F.when(c("event_type") == "SESSION_STOP", c("final_meter_kwh")), F.when(c("has_session"), c("s_meter")), F.lit(0.0)))
    fault = F.when(c("event_type") == "FAULT_ALERT", c("fault_code")).when(c("event_type") == "STATUS_CHANGE", c("reason"))
    rows = inputs.where("event_type != 'HEARTBEAT'").select("station_id", "connector_id", arrival().alias("came"), "event_time", "operator_id", station_status().alias("status"), F.when(gone, "").otherwise(F.coalesce("session_id", F.lit(""))).alias("session_id"), _power().alias("power_kw"), meter.alias("energy_kwh_last"), F.coalesce(F.when(c("has_session"), c("s_brand")), F.lit("")).alias("vehicle_brand"), F.coalesce(fault, F.lit("")).alias("fault_code"), F.when(c("event_type") == "METER_UPDATE", c("event_time")).alias("last_meter_time"))
    return _latest(rows, "station_id", "connector_id", newest=("last_meter_time",))


def session_state(inputs: DataFrame) -> DataFrame:
    rows = inputs.where("has_session and session_id is not null and (event_type != 'METER_UPDATE' or metered)")
    status = F.when(c("ends"), "finalized").when(c("s_count") > 0, "charging").otherwise("active")
    energy = F.greatest(F.lit(0.0), "s_energy")
    rows = rows.select("session_id", arrival().alias("came"), "event_time", "station_id", "connector_id", "operator_id", c("s_started").alias("start_time"), c("s_last").alias("last_event_time"), F.coalesce("s_brand", F.lit("")).alias("vehicle_brand"), c("s_tariff_id").alias("tariff_id"), energy.alias("current_energy_kwh"), F.coalesce("s_power", F.lit(0.0)).alias("current_power_kw"), c("s_count").alias("meter_update_count"), c("s_max").alias("max_power_kw_seen"), F.round(energy * F.greatest(F.lit(0.0), "s_tariff"), 6).alias("estimated_cost_eur"), status.alias("status"), F.when(c("ends"), FINAL_TTL).otherwise(SESSION_TTL).alias("ttl_seconds"))
    return _latest(rows, "session_id")


def timeout_states(expired: DataFrame, now: Column) -> DataFrame:
    """Connector rows of sessions that timed out; their guard time is that of the sweep, so that no older row wins."""
    return expired.select("station_id", "connector_id", "operator_id", now.alias("event_time"), c("last_event_time").alias("last_meter_time"), F.lit("available").alias("status"), F.lit("").alias("session_id"), F.lit(0.0).alias("power_kw"), F.greatest(F.lit(0.0), "latest_meter_kwh").alias("energy_kwh_last"), F.coalesce("vehicle_brand", F.lit("")).alias("vehicle_brand"), F.lit("").alias("fault_code"))


def timeout_stations(expired: DataFrame, now: Column) -> DataFrame:
    """Station rows of the sweep: available, one session less is open."""
    return expired.groupBy("station_id").agg(F.first("operator_id").alias("operator_id"), F.count("*").alias("closed_sessions")).select("station_id", "operator_id", now.alias("event_time"), F.lit("available").alias("current_status"), F.lit(0.0).alias("latest_power_kw"), "closed_sessions", F.lit(0).alias("fault_flag"))


def timeout_sessions(expired: DataFrame, now: Column) -> DataFrame:
    """Session rows of the sweep: finalized, kept for a while."""
    return expired.select("session_id", "station_id", "connector_id", "operator_id", now.alias("event_time"), "last_event_time", F.lit("finalized").alias("status"), F.lit(0.0).alias("current_power_kw"), F.lit(FINAL_TTL).alias("ttl_seconds"))


def guarded_upsert(stored: DataFrame, batch: DataFrame, keys: list[str], guard: str = "event_time") -> DataFrame:
    """stored with the batch's rows (one a key) applied where they are newer by milliseconds; equal is stale.
    Fields that a newer row lacks keep their stored value."""
    fields = [x for x in stored.columns if x not in keys]
    s, b = stored.alias("s"), batch.alias("b")
    both = s.join(b, [c(f"s.{k}") == c(f"b.{k}") for k in keys], "full_outer")
    newer = c(f"s.{guard}").isNull() | (F.unix_millis(c(f"b.{guard}")) > F.unix_millis(c(f"s.{guard}")))
    newer = F.coalesce(newer & c(f"b.{guard}").isNotNull(), F.lit(False))
    pick = lambda f: (F.when(newer, F.coalesce(c(f"b.{f}"), c(f"s.{f}"))).otherwise(c(f"s.{f}")) if f in batch.columns else c(f"s.{f}")).alias(f)
    return both.select(*(F.coalesce(c(f"s.{k}"), c(f"b.{k}")).alias(k) for k in keys), *map(pick, fields))


def upsert_counts(stored: DataFrame, batch: DataFrame, keys: list[str], guard: str = "event_time") -> dict[str, int]:
    """How many rows of a batch guarded_upsert() applies, and how many are stale."""
    old = stored.select(*keys, c(guard).alias("stored_guard"))
    newer = c("stored_guard").isNull() | (F.unix_millis(c(guard)) > F.unix_millis("stored_guard"))
    newer = F.coalesce(newer & c(guard).isNotNull(), F.lit(False))
    row = batch.select(*keys, guard).join(old, keys, "left").agg(F.count_if(newer).alias("applied"), F.count_if(~newer).alias("stale")).first()
    return row.asDict()


def last_version(spark: SparkSession, root: str, before: int) -> str | None:
    """The folder of the newest version of a state table that a batch before this one has written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    names = [x.getPath().getName() for x in files.listStatus(path)]
    found = [n for n in names if n.startswith("version=") and int(n[8:]) < before and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return f"{root}/{max(found)}" if found else None


def live(state: DataFrame, now: Column, ttl: str = "ttl_seconds", since: str = "event_time") -> DataFrame:
    """Rows whose time to live hasn't run out."""
    return state.where(F.unix_micros(now) < F.unix_micros(since) + c(ttl).cast("bigint") * 1_000_000)


def keys_like(state: DataFrame, prefix: str, limit: int, key: str = "station_id") -> DataFrame:
    """Up to `limit` keys that begin with prefix: a sampling operator."""
    return state.where(c(key).startswith(prefix)).select(key).orderBy(key).limit(limit)


def point_read(state: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The rows of some keys; the filter reaches the scan, so a table sorted by key is read in a few blocks."""
    return state.where(c(key).isin(values))
