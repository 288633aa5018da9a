import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattloom.operators import admission, generator, metrics, parse, serving
from wattloom.plans.telemetry import Telemetry
from wattloom.sources import tables
from wattloom.sources.logs import Settings
from wattloom.streaming import flow
from wattloom.streaming.sessions import fact_rows, session_stream, transition

SMALL = "/root/testdata/sf0.001"


def test_lateness_bounds(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [(t, t + dt.timedelta(seconds=s), float(s)) for s in (-5, 0, 0.9, 1, 600, 600.9, 601)]
    df = spark.createDataFrame(rows, "event_time timestamp, received_at timestamp, s double").withColumn("lateness_seconds", admission.lateness_seconds())
    got = {r["s"]: r["k"] for r in df.select("s", admission.lateness_class(600).alias("k")).collect()}
    assert got == {-5: "on_time", 0: "on_time", 0.9: "on_time", 1: "accepted_late", 600: "accepted_late", 600.9: "accepted_late", 601: "too_late_rejected"}


def test_parse_reasons(spark):
    good = '{"event_id":"e","event_type":"HEARTBEAT","event_time":"2026-01-01T00:00:00Z","ingest_time":"2026-01-01T00:00:00","station_id":"s","connector_id":"1","operator_id":"o","session_id":null,"schema_version":"1","producer_id":"p","sequence_no":0,"location":{"latitude":1},"payload":{"charger_status":"ok"}}'
    cases = {
        good: None,
        "{bad-json": "malformed_json",
        "": "empty_json",
        " \t ": "empty_json",
        None: "empty_message",
        b"\xc3\x28": "malformed_utf8",
        "[1]": "event_must_be_json_object",
        "3": "event_must_be_json_object",
        good + " x": "malformed_json",
        good + good: "malformed_json",
        "{}": "Missing required fields: event_id, event_type, event_time, ingest_time, station_id, connector_id, operator_id, session_id, schema_version, producer_id, sequence_no, location, payload",
        good.replace('"sequence_no":0', '"sequence_no":true'): "sequence_no must be an integer",
        good.replace('"sequence_no":0', '"sequence_no":1.0'): "sequence_no must be an integer",
        good.replace('"charger_status":"ok"', '"x":1,"charger_status":"ok"'): "Invalid payload for HEARTBEAT: unexpected x",
        good.replace('"charger_status":"ok"', ""): "Invalid payload for HEARTBEAT: missing charger_status",
        good.replace('"charger_status":"ok"', '"charger_status":4'): "Invalid payload for HEARTBEAT: wrong type of charger_status",
        good.replace('"latitude":1', '"latitude":"x"'): "location.latitude must be numeric when present",
        good.replace("HEARTBEAT", "NOPE"): "Invalid event_type: NOPE",
        good.replace("2026-01-01T00:00:00Z", "soon"): "Invalid timestamp for event_time: soon",
    }
    rows = [(k, v.encode() if isinstance(v, str) else v) for k, v in enumerate(cases)]
    log = spark.createDataFrame([(None, v, "t", 0, k, dt.datetime(2026, 1, 1)) for k, v in rows], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    got = {r["offset"]: r["error_reason"] for r in parse.parsed(log).collect()}
    assert [got[k] for k in range(len(rows))] == list(cases.values())


EVENT = {"station_id": "s", "connector_id": "1", "operator_id": "o", "session_id": "x", "sequence_no": 1, "us": 0, "event_id": "e"}


def test_transition_paths():
    start = EVENT | {"event_type": "SESSION_START", "vehicle_brand": "A", "sequence_no": 0}
    state, outcome, error, done = transition(None, start, 0)
    assert outcome == "session_started" and state["tariff"] == 0.35 and state["epoch"] == 1
    assert transition(state, start, 1)[1:3] == ("invalid", "SESSION_START received for already-active session_id")
    meter = EVENT | {"event_type": "METER_UPDATE", "energy_delta_kwh": 2.0, "power_kw": None, "us": 5}
    state, outcome, *_ = transition(state, meter, 1)
    assert outcome == "session_meter_updated" and state["energy"] == 2.0 and state["power_samples"] == 0
    assert transition(state, meter, 1)[1] == "non_increasing_sequence"
    assert transition(state, meter | {"station_id": "z"}, 1)[2] == "session identity mismatch: station_id"
    stop = EVENT | {"event_type": "SESSION_STOP", "total_energy_kwh": 9.0, "end_reason": "done", "us": 3}
    _, outcome, _, done = transition(state, stop, 1)
    assert outcome == "normal_stop" and done["energy"] == 9.0 and done["last_us"] == 5 and done["stop_reason"] == "done"
    fault = EVENT | {"event_type": "STATUS_CHANGE", "new_status": " FaulteD ", "reason": None}
    assert transition(state, fault, 1)[3]["stop_reason"] == "status_fault:status_change"
    assert transition(None, stop, 0)[2] == "SESSION_STOP without active session context is invalid"
    assert transition(None, meter, 0)[1] == "session_not_found"


def test_reopened_ids_agree_with_a_fold(spark):
    """Ids that are closed and started again elsewhere, and events that name another place while one is open."""
    import random

    from wattloom.operators.sessions import session_verdicts

    rng, rows = random.Random(9), []
    for no in range(600):
        kind = rng.choice(["SESSION_START", "SESSION_START", "METER_UPDATE", "SESSION_STOP", "FAULT_ALERT", "HEARTBEAT"])
        rows.append((f"e{no}", no, 0, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=no), kind, rng.choice(["x", "y", "z", "w"]), "s", rng.choice("12"), "o", no, rng.random() < 0.9))
    schema = "event_id string, event_no long, copy int, event_time timestamp, event_type string, session_id string, station_id string, connector_id string, operator_id string, sequence_no long, candidate boolean"
    df = spark.createDataFrame(rows, schema).withColumn("errors", F.array().cast("array<string>")).withColumn("duplicate", F.lit(False))
    nothing = {x: F.lit(None).cast("string") for x in ("new_status", "reason", "fault_code", "end_reason")}
    got = {r["event_id"]: r["outcome"] for r in session_verdicts(df.withColumns(nothing)).collect()}
    states, epochs, reopened = {}, {}, 0
    for r in rows:
        e = dict(zip(("event_id", "event_no", "copy", "event_time", "event_type", "session_id", "station_id", "connector_id", "operator_id", "sequence_no"), r)) | {"us": r[1], "energy_delta_kwh": 1.0}
        if not r[-1]:
            continue
        held = states.get(e["session_id"])
        state, outcome, _, _ = transition(held, e, epochs.get(e["session_id"], 0))
        states[e["session_id"]] = state
        if outcome == "session_started":
            reopened += epochs.get(e["session_id"], 0) > 0
            epochs[e["session_id"]] = state["epoch"]
        assert got[e["event_id"]] == outcome, e
    assert reopened > 20


def test_batch_agrees_with_a_fold(spark):
    t = Telemetry.of(spark, SMALL)
    rows = t.verdicts.where("session_id is not null").withColumn("us", F.unix_micros("event_time")).orderBy("event_time", "event_no", "copy").collect()
    states, epochs, checked = {}, {}, 0
    for r in (r.asDict() for r in rows):
        if not r["candidate"]:
            continue
        key = r["session_id"]
        state, outcome, _, _ = transition(states.get(key), r, epochs.get(key, 0))
        if outcome == "session_started":
            epochs[key] = state["epoch"]
        states[key] = state
        assert outcome == r["outcome"], r
        checked += 1
    assert checked > 100


def test_stream_agrees_with_batch(spark, tmp_path):
    t = Telemetry.of(spark, SMALL)
    source = t.admitted.where("candidate").drop("errors").coalesce(1)
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    query = session_stream(stream, timeout=10**8, watermark="60 days").writeStream.format("memory").queryName("tagged").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(180)
    facts = fact_rows(spark.table("tagged"))
    got = {(r["session_id"], r["epoch"]): (round(r["energy"], 6), r["finalized_reason"], r["stop_event_id"]) for r in facts.collect()}
    want = {(r["session_id"], r["epoch"]): (round(r["energy"], 6), r["finalized_reason"], r["stop_event_id"]) for r in t.snapshots.where("finalized_reason is not null").collect()}
    assert got == want


def spoilt_log(t, spark):
    """A log with a malformed and a schema-breaking record more."""
    log = parse.to_log(t.arrivals)
    bad = [(None, b"{bad", "raw", 7, 1, dt.datetime(2026, 1, 1)), (None, b'{"event_id": "evt-1"}', "raw", 7, 2, dt.datetime(2026, 1, 1)), (None, None, "raw", 7, 3, dt.datetime(2026, 1, 1))]
    return log.unionByName(spark.createDataFrame(bad, log.schema))


def test_stream_admission_loses_nothing(spark, tmp_path):
    """Each record ends in one table, but for repeats of an id."""
    t = Telemetry.of(spark, SMALL)
    spoilt_log(t, spark).coalesce(2).write.parquet(str(tmp_path / "log"))
    from wattloom.sources.logs import file_log

    query = flow.start_admission(file_log(spark, str(tmp_path / "log")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert query.awaitTermination(180)
    judged = t.admitted.where("not duplicate").groupBy(F.when(F.size("errors") > 0, "dead_letter_events").when(F.col("lateness") == "too_late_rejected", "late_events_rejected").otherwise("raw_events").alias("k")).count().collect()
    read = lambda name, *since: tables.read(spark, str(tmp_path / "out"), name, *since)
    for r in judged:
        assert read(r["k"]).count() == r["count"] + 3 * (r["k"] == "dead_letter_events")
    assert {r["error_reason"][:15] for r in read("dead_letter_events").where("partition = 7").collect()} == {"malformed_json", "Missing require", "empty_message"}
    some = read("raw_events", "2024-01-15 00:00:00")
    assert 0 < some.count() < read("raw_events").count()


def test_text_log_is_a_stream(spark, tmp_path):
    from wattloom.sources.logs import text_log

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"a": 1}\n{bad\n{"a": 2}\n')
    query = flow.start_admission(text_log(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert query.awaitTermination(180)
    assert tables.read(spark, str(tmp_path / "out"), "dead_letter_events").count() == 3


def test_state_versions(spark, tmp_path):
    at = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    schema, root = "k string, event_time timestamp, v string", str(tmp_path / "state")
    first, second = [("a", at(5), "1"), ("b", at(5), "1")], [("a", at(6), "2"), ("b", at(4), "2"), ("c", at(1), "2")]
    assert flow.write_state(spark.createDataFrame(first, schema), 0, root, ["k"]) == {"applied": 2, "stale": 0}
    for _ in range(2):  # a repeated batch does the same again
        assert flow.write_state(spark.createDataFrame(second, schema), 1, root, ["k"]) == {"applied": 2, "stale": 1}
    rows = spark.read.parquet(serving.last_version(spark, root, 2)).collect()
    assert {r["k"]: r["v"] for r in rows} == {"a": "2", "b": "1", "c": "2"}


def test_streaming_dedup_and_minutes(spark, tmp_path):
    t = Telemetry.of(spark, SMALL)
    t.arrivals.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.arrivals.schema).parquet(str(tmp_path / "in"))
    for name, df in (("once", flow.deduplicated(stream, "60 days")), ("minutes", flow.minute_counts(stream, "1 minute"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert q.awaitTermination(180)
    assert spark.table("once").count() == t.arrivals.select("event_id").distinct().count()
    assert spark.table("minutes").count() > 0


def test_guarded_upsert(spark):
    at = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    schema = "k string, event_time timestamp, v string, w string"
    stored = spark.createDataFrame([("a", at(5), "old", "kept"), ("b", at(5), "old", "x"), ("c", at(5), "old", "x")], schema)
    batch = spark.createDataFrame([("a", at(6), "new", None), ("b", at(5), "equal", "y"), ("c", at(4), "older", "y"), ("d", at(1), "first", None)], schema)
    got = {r["k"]: (r["v"], r["w"]) for r in serving.guarded_upsert(stored, batch, ["k"]).collect()}
    assert got == {"a": ("new", "kept"), "b": ("old", "x"), "c": ("old", "x"), "d": ("first", None)}


@pytest.mark.parametrize("values, p, want", [([], 50, 0.0), ([3.0], 95, 3.0), ([1.0, 2.0, 4.0], 95, 3.8), ([1.0, 2.0], 200, 2.0), ([1.0, 2.0], -1, 1.0)])
def test_percentile(spark, values, p, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(metrics.percentile("v", p).alias("x")).first()["x"] == pytest.approx(want)


def test_exposition(spark):
    lines = ["# HELP x", 'a_total{x="1,2",y="q\\"r"} 3', "b 4.5e1", "", "not a line at all !", "c .5e3 1700000000", 'd{z="}"}+Inf', "e 3d", "f{x=1", "9g 1"]
    got = {r["name"]: (r["labels"], r["value"]) for r in metrics.exposition(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"a_total": ({"x": "1,2", "y": 'q"r'}, 3.0), "b": ({}, 45.0), "c": ({}, 500.0), "d": ({"z": "}"}, float("inf"))}


def test_generator(spark):
    a, b = (set(r["station_id"] for r in generator.network(spark, 12, shard=k, shards=2).collect()) for k in (0, 1))
    assert not a & b and a | b == {f"ST-{k:04d}" for k in range(1, 13)}
    with pytest.raises(ValueError):
        generator.network(spark, 3, shard=2, shards=2)
    pacing = generator.Pacing()
    assert pacing.side(180, 100) == 1 and pacing.scaled(1.0, 1) == pytest.approx(0.8) and pacing.cap(1, 8, 100) == 0
    assert pacing.side(10, 100) == -1 and pacing.scaled(1.0, -1) == pytest.approx(1.08) and pacing.cap(-1, 8, 100) == 1
    assert pacing.side(105, 100) == 0 and pacing.scaled(2.0, 0) == pytest.approx(1.8) and pacing.cap(0, 1000, 10) == 5
    assert pacing.scaled(0.01, 1) == 0.05 and pacing.scaled(9.0, -1) == 3.0
    pace = generator.paced_starts(400, 100.0, 300)
    assert 80 < sum(x[2] for x in pace[150:]) / 150 < 120
    started = generator.started_by_pace(generator.network(spark, 200), pace)
    assert 0 < started.count() <= 400 and started.where("started_at is null").count() == 0
    events = generator.meter_events(generator.sessions(generator.network(spark, 20)))
    assert events.where("event_type = 'SESSION_START'").count() == 40
    late = generator.with_faults(events, 0.0, 1.0, 0.0).where("event_id like '%-late'")
    assert late.where("event_type in ('SESSION_START', 'SESSION_STOP')").count() == 0 and late.count() > 0


def test_settings(tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"allowed_lateness": -3, "dedup_ttl": 1, "topic": "x"}')
    got = Settings.load(str(path), {"WATTLOOM_TOPIC": "y", "WATTLOOM_MAX_RECORDS": "bad"})
    assert (got.allowed_lateness, got.dedup_ttl, got.topic, got.max_records) == (1, 60, "y", 50_000)
    path.write_text("[1]")
    with pytest.raises(ValueError):
        Settings.load(str(path), {})


def test_harness(spark, tmp_path):
    from wattloom.plans import harness

    rows = harness.time_queries({"good": lambda: spark.range(5).toDF("id"), "bad": lambda: spark.range(5).select("nope")}, 3)
    assert [(r["query"], r["failures"]) for r in rows] == [("good", 0), ("bad", 3)] and rows[0]["p50_ms"] > 0 and rows[1]["max_ms"] == 0
    assert harness.percentile([1.0, 2.0, 4.0], 95) == pytest.approx(3.8) and harness.percentile([], 50) == 0
    harness.write_results(rows, harness.environment(spark), str(tmp_path), "one")
    harness.write_results(rows, {}, str(tmp_path), "two")
    assert (tmp_path / "latest" / "results.csv").read_text().count("\n") == 3 and (tmp_path / "summary.jsonl").read_text().count("\n") == 2
    assert (tmp_path / "one" / "results.md").read_text().count("| good |") == 1
    read = harness.point_reads(spark.range(20).selectExpr("cast(id as string) as k", "id"), "k", 0.5, 5)
    assert read["keys"] == 5 and read["reads"] > 0
    assert harness.achieved_rate(None, 7) == 7 and harness.achieved_rate(3, 7) == 3 and harness.flattened({"a": {"b": 1, "c": "x"}, "d": True}) == {"a.b": 1.0}


def test_progress(spark, tmp_path):
    from wattloom.sources.logs import file_log
    from wattloom.streaming import progress

    assert progress.lag('{"t": {"0": 5, "1": 9}}', '{"t": {"0": 8, "1": 4, "2": 2}}') == 5 and progress.lag(None, None) == 0
    parse.to_log(Telemetry.of(spark, SMALL).arrivals).limit(50).coalesce(1).write.parquet(str(tmp_path / "log"))
    listener = progress.Progress()
    spark.streams.addListener(listener)
    try:
        records = progress.with_counters(parse.parsed(file_log(spark, str(tmp_path / "log"))))
        query = records.writeStream.format("noop").queryName("counted").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        for _ in range(100):
            if ("counted", "records_total") in listener.counters:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.counters["counted", "records_total"] == 50 == listener.counters["counted", "valid_total"]
    text = progress.exposition(listener.rows())
    got = {r["name"]: r["value"] for r in metrics.exposition(spark.createDataFrame([(x,) for x in text.split("\n")], "value string")).collect()}
    assert got["wattloom_records_total"] == 50


def test_charging(spark):
    from wattloom.operators import charging

    connectors = generator.network(spark, 40)
    sessions = generator.sessions(connectors)
    events = charging.session_events(sessions, fault_rate=0.3).collect()
    assert [tuple(r) for r in events] == [tuple(r) for r in charging.session_events(sessions, fault_rate=0.3).collect()]
    by = {}
    for r in events:
        by.setdefault(r["event_id"].rsplit("-", 1)[0], []).append(r)
    assert len(by) == 80 and {r["event_type"] for r in events} == {"SESSION_START", "METER_UPDATE", "SESSION_STOP", "FAULT_ALERT", "STATUS_CHANGE"}
    for own in by.values():
        own.sort(key=lambda r: r["sequence_no"])
        assert [r["event_time"] for r in own] == sorted(r["event_time"] for r in own) and own[0]["event_type"] == "SESSION_START"
        meters = [r for r in own if r["event_type"] == "METER_UPDATE"]
        assert meters and all(a["power_kw"] >= b["power_kw"] and a["soc_percent"] <= b["soc_percent"] <= 100 for a, b in zip(meters, meters[1:]))
        assert sum(r["energy_delta_kwh"] for r in meters) == pytest.approx(meters[-1]["meter_kwh"], abs=1e-4)
        assert meters[0]["current_a"] == pytest.approx(meters[0]["power_kw"] * 1000 / meters[0]["voltage_v"], abs=1e-3)
        assert own[-1]["event_type"] == "SESSION_STOP" or [r["event_type"] for r in own[-3:]] == ["FAULT_ALERT", "STATUS_CHANGE", "STATUS_CHANGE"] and own[-1]["new_status"] == "available"
    beats = charging.heartbeats(connectors, 3600).select("station_id", F.unix_micros("event_time").alias("us")).collect()
    assert len(beats) == 40 * 60
    times = sorted(r["us"] for r in beats if r["station_id"] == "ST-0001")
    assert all(60 * 0.7 - 0.01 <= (b - a) / 1e6 <= 60 * 1.3 + 0.01 for a, b in zip(times, times[1:]))
    assert charging.fixed_starts(10, 3, 5, 0.9) == 2 and charging.fixed_starts(10, 9, 5, 1) == 0
    assert charging.distribution({"x": {"a": 1, "b": 3}}, "x", {}) == {"a": 0.25, "b": 0.75}
    assert charging.distribution({"x": [{"name": "a", "weight": 2}]}, "x", {}) == {"a": 1.0} and charging.distribution({"x": {"a": 0}}, "x", {"z": 2.0}) == {"z": 1.0}
    with pytest.raises(ValueError):
        charging.distribution({"x": {"a": "many"}}, "x", {"z": 1.0})


def test_stream_rollups_agree_with_batch(spark, tmp_path):
    """What the watermark has closed is as in the batch tables."""
    t = Telemetry.of(spark, SMALL)
    events = t.raw_events.select("event_time", "event_type", "operator_id", "station_id", "city", "country", "metered", "power_kw", "energy_delta_kwh", "fault_code")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    t.facts.coalesce(1).write.parquet(str(tmp_path / "facts"))
    read = lambda name, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    made = {"minutes": flow.station_minutes(read("events", events)), "hours": flow.operator_hours(read("facts", t.facts)), "days": flow.city_days(read("events", events))}
    batch = {"minutes": t.station_minute, "hours": t.operator_hour, "days": t.city_day_faults}
    for name, df in made.items():
        query = df.writeStream.format("memory").queryName(f"rolled_{name}").outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert query.awaitTermination(180)
        got = spark.table(f"rolled_{name}")
        own = [x for x in got.columns if x not in ("max_power_kw", "session_stop_count")]
        keys = [x for x in own if x.startswith(("bucket", "operator", "station", "country", "city"))]
        cell = lambda x: round(x, 4) if isinstance(x, float) else x
        want = {tuple(r[k] for k in keys): tuple(cell(r[x]) for x in own) for r in batch[name].collect()}
        rows = got.collect()
        assert len(rows) == len({tuple(r[k] for k in keys) for r in rows}) and len(rows) > 10
        for r in rows:
            assert tuple(cell(r[x]) for x in own) == want[tuple(r[k] for k in keys)], (name, r)
