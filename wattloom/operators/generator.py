"""Synthetic load: a charging network, demand, a rate controller and quality faults.

Rows come from range() and hashes of their keys, so every partition makes its own, the same at each run;
the pacing of starts is sequential by nature and runs on the driver, one small step a tick.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

c = F.col
#: Demand by hour of day, and the two peaks (start hour, end hour, multiplier).
HOURLY_WEIGHTS = (0.35, 0.32, 0.30, 0.30, 0.34, 0.48, 0.72, 0.95, 1.05, 0.92, 0.84, 0.82, 0.86, 0.90, 0.96, 1.06, 1.20, 1.36, 1.50, 1.42, 1.20, 0.92, 0.68, 0.48)
MORNING, EVENING = (7, 10, 1.7), (17, 21, 2.0)


def chance(seed: int, k: int, *keys: str) -> Column:
    """A number in 0..1 that a row's keys decide: 32 bits of their MD5 digest with the seed and k."""
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}:{k}"), *keys))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)

def network(spark: SparkSession, stations: int, connectors: int = 2, shard: int = 0, shards: int = 1, operators: int = 3, cities: int = 6) -> DataFrame:
    """The connectors of one shard's stations; shards are disjoint and together complete."""
    if not (shards >= 1 and 0 <= shard < shards):
        raise ValueError("shard must be within the number of shards")
    base = spark.range(stations).where(c("id") % shards == shard)
    return base.select(F.format_string("ST-%04d", c("id") + 1).alias("station_id"), F.concat(F.lit("OP-"), c("id") % operators).alias("operator_id"), F.concat(F.lit("C"), c("id") % cities).alias("city"), F.explode(F.transform(F.sequence(F.lit(1), F.lit(connectors)), lambda k: k.cast("string"))).alias("connector_id"))


def weighted_choice(weights: dict[str, float], u: Column) -> Column:
    """The item whose share of the cumulative weights holds u (0..1); all-zero weights are alike."""
    kept = {k: max(0.0, w) for k, w in weights.items()}
    if not kept:
        raise ValueError("weighted_choice needs an item")
    total = sum(kept.values())
    kept = kept if total > 0 else dict.fromkeys(kept, 1.0)
    total, out, at = total or float(len(kept)), None, 0.0
    for k, w in kept.items():
        at += w / total
        out = (F.when if out is None else out.when)(u <= at, k)
    return out.otherwise(list(kept)[-1])


def triangular(low: float, high: float, mode: float, u: Column) -> Column:
    """Inverse of the triangular distribution function."""
    cut = (mode - low) / (high - low)
    return F.when(u < cut, low + F.sqrt(u * (high - low) * (mode - low))).otherwise(high - F.sqrt((1 - u) * (high - low) * (high - mode)))


def in_hours(hour: Column, start: int, end: int) -> Column:
    if start == end:
        return F.lit(True)
    return (hour >= start) & (hour < end) if start < end else (hour >= start) | (hour < end)


def demand(hour: Column, weights: tuple[float, ...] = HOURLY_WEIGHTS, morning=MORNING, evening=EVENING) -> Column:
    """Demand multiplier of an hour of day, never under 0.1."""
    out = F.element_at(F.array(*map(F.lit, weights)), hour.cast("int") + 1)
    for start, end, multiplier in (morning, evening):
        out = out * F.when(in_hours(hour, start, end), multiplier).otherwise(1.0)
    return F.greatest(F.lit(0.1), out)


def burst_target(tick: Column, target: float, cycle: float = 60.0, multiplier: float = 3.0) -> Column:
    """Target rate: multiplied in the first 30 % of each cycle."""
    cycle = max(cycle, 1.0)
    return F.when(F.pmod(tick, F.lit(cycle)) < cycle * 0.30, target * max(multiplier, 1.0)).otherwise(target)


def sessions(connectors: DataFrame, seed: int = 17, start: str = "2026-01-01 00:00:00") -> DataFrame:
    """A session for each connector: brand, state of charge, duration, energy."""
    u = lambda k: chance(seed, k, "station_id", "connector_id")
    out = connectors.withColumn("vehicle_brand", weighted_choice({"Tesla": 3, "Renault": 2, "BMW": 1.5, "Togg": 1}, u(1))).withColumn("soc_start", F.round(10 + 50 * u(2), 2))
    out = out.withColumn("minutes", F.round(triangular(8, 90, 35, u(3)), 2)).withColumn("power_kw", F.round(11 + 139 * u(4), 3)).withColumn("started_at", F.lit(start).cast("timestamp") + F.make_dt_interval(mins=F.floor(60 * u(5)).cast("int")))
    taper = F.when(c("soc_start") < 50, 1.0).when(c("soc_start") < 80, 0.72).otherwise(F.greatest(F.lit(0.1), (100 - c("soc_start")) / 100))
    return out.withColumn("session_id", F.concat_ws("-", F.lit("S"), "station_id", "connector_id")).withColumn("energy_kwh", F.round(c("power_kw") * taper * c("minutes") / 60, 6))


def meter_events(started: DataFrame, every_s: int = 60) -> DataFrame:
    """START, METER_UPDATEs and STOP of each session in order."""
    n = F.greatest(F.lit(1), F.floor(c("minutes") * 60 / every_s)).cast("int")
    rows = started.withColumn("n", n).select("*", F.explode(F.sequence(F.lit(0), c("n") + 1)).alias("sequence_no"))
    step = F.round(c("energy_kwh") / c("n"), 6)
    kind = F.when(c("sequence_no") == 0, "SESSION_START").when(c("sequence_no") <= c("n"), "METER_UPDATE").otherwise("SESSION_STOP")
    return rows.select(F.concat_ws("-", "session_id", "sequence_no").alias("event_id"), kind.alias("event_type"), (c("started_at") + F.make_dt_interval(secs=c("sequence_no") * every_s)).alias("event_time"), "station_id", "connector_id", "operator_id", "session_id", "sequence_no", "city", "vehicle_brand", F.when(kind == "METER_UPDATE", step).alias("energy_delta_kwh"), F.when(kind == "METER_UPDATE", F.round(step * c("sequence_no"), 6)).alias("meter_kwh"))


def with_faults(events: DataFrame, duplicates: float, late: float, out_of_order: float, threshold_s: int = 900, seed: int = 29) -> DataFrame:
    """Events with exact duplicates, too-late copies under new ids (none of START and STOP) and delayed ones."""
    u = lambda k: chance(seed, k, "event_id")
    base = events.withColumn("release_at", c("event_time") + F.make_dt_interval(secs=F.when(u(1) < out_of_order, F.floor(5 + 25 * u(2))).otherwise(0)))
    again = base.where(u(3) < duplicates)
    old = base.where(~c("event_type").isin("SESSION_START", "SESSION_STOP") & (u(4) < late)).withColumn("event_time", c("event_time") - F.make_dt_interval(secs=threshold_s + F.floor(20 + 220 * u(5)))).withColumn("event_id", F.concat("event_id", F.lit("-late")))
    return base.unionByName(again).unionByName(old)


@dataclass(frozen=True)
class Pacing:
    """How starts are paced: the quiet band around the target, the steps out of it, and what limits starts."""

    #: Share of the target by which a rate may be off, factors above and below, pull back to 1, limits of the scale.
    band: float = 0.1
    slower: float = 0.8
    faster: float = 1.08
    recovery: float = 0.2
    least: float = 0.05
    most: float = 3.0
    #: Share of the idle connectors that may start in a tick, and events that a started session adds to a tick.
    share: float = 0.05
    events_a_start: int = 2

    def side(self, observed: float, target: float) -> int:
        """1 above the band, -1 below, 0 within."""
        off = observed - target
        return 0 if abs(off) <= self.band * target else 1 if off > 0 else -1

    def scaled(self, scale: float, side: int) -> float:
        """The scale of admissions after a tick: a factor outside the band, within it part of the way back to 1."""
        moved = {1: scale * self.slower, -1: scale * self.faster, 0: scale + self.recovery * (1 - scale)}[side]
        return sorted((self.least, moved, self.most))[1]

    def cap(self, side: int, idle: int, headroom: float) -> int:
        """Most starts of a tick: none above the band; else a share of the idle connectors and what fits into the events
        still wanted. Below the band, one start is always let through while events are wanted."""
        if side > 0 or idle <= 0:
            return 0
        most = min(int(idle * self.share), int(max(0.0, headroom) // max(1, self.events_a_start)))
        return max(1, most) if side < 0 and headroom > 0 else most


def paced_starts(connectors: int, target: float, ticks: int, pacing: Pacing = Pacing(), base: float = 0.02, ceiling: float = 0.9, length: int = 35) -> list[tuple[int, int, float, float]]:
    """(tick, starts, observed rate, scale) of a run over ticks: every open session gives an event a tick, a start one
    more, and ends after `length` ticks. Sequential by nature: a small loop on the driver."""
    out, ends, idle, scale, observed = [], {}, connectors, 1.0, 0.0
    for tick in range(ticks):
        idle += ends.pop(tick, 0)
        side = pacing.side(observed, target)
        scale = pacing.scaled(scale, side)
        probability = sorted((0.0001, base * scale, ceiling))[1]
        due = connectors - idle
        starts = min(pacing.cap(side, idle, target - due), max(1, round(idle * probability)))
        idle -= starts
        ends[tick + length] = starts
        observed = float(connectors - idle + starts)
        out.append((tick, starts, observed, scale))
    return out


def started_by_pace(connectors: DataFrame, pace: list[tuple[int, int, float, float]], tick_s: int = 60, start: str = "2026-01-01 00:00:00", seed: int = 17) -> DataFrame:
    """Connectors with the tick and time of their start: shares of the hash range stand for the starts of each tick, so
    no connector needs to know of another. Those beyond the last start don't start."""
    total, bounds, at = connectors.count(), [], 0
    for _, starts, _, _ in pace:
        at += starts
        bounds.append(min(1.0, at / max(1, total)))
    u = chance(seed, 0, "station_id", "connector_id")
    tick = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= u))
    out = connectors.withColumn("tick", tick).where(c("tick") < len(pace))
    return out.withColumn("started_at", F.lit(start).cast("timestamp") + F.make_dt_interval(secs=c("tick") * tick_s))
