"""Percentiles, counters, rates, verdicts and the exposition text of metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

c = F.col
#: Upper bounds of the latency histogram in milliseconds.
LATENCY_BUCKETS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0, 30000.0)
#: What to do about each bottleneck, and about any other.
OTHER_ADVICE = "Collect longer traces and profile the slowest stage."
ADVICE = {
    "kafka_consumer_lag_growth": "Increase processor parallelism or tune poll/flush batch sizing.",
    "clickhouse_insert_latency": "Increase ClickHouse batch size/flush tuning and verify storage throughput.",
    "redis_write_latency": "Reduce Redis write amplification and validate Redis host resources.",
    "processor_throughput_limit": "Profile processor hot path and reduce per-event overhead.",
    "no_major_bottleneck_observed": "Run longer sustained window to validate stability.",
}


def percentile(value: Column | str, p: float) -> Column:
    """Exact percentile with linear interpolation; p is held within 0..100, and no values give 0."""
    return F.coalesce(F.percentile(value, max(0.0, min(100.0, p)) / 100), F.lit(0.0))


def latencies(events: DataFrame) -> DataFrame:
    """Ingest lag, processor latency and their sum in milliseconds."""
    ms = lambda a, b: F.greatest(F.lit(0.0), (F.unix_micros(a) - F.unix_micros(b)) / 1000)
    out = events.withColumn("ingest_lag_ms", ms("ingest_time", "event_time")).withColumn("processor_ms", ms("received_at", "ingest_time"))
    return out.withColumn("end_to_end_ms", c("ingest_lag_ms") + c("processor_ms"))


def histogram(values: DataFrame, value: str, bounds: tuple[float, ...] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative counts: one pass, one row a bound, infinity last."""
    counts = values.agg(*(F.count_if(c(value) <= b).alias(str(k)) for k, b in enumerate(bounds)), F.count(value).alias("all"))
    pairs = [F.struct(F.lit(float(b)).alias("le"), c(str(k)).alias("n")) for k, b in enumerate(bounds)] + [F.struct(F.lit(float("inf")).alias("le"), c("all").alias("n"))]
    return counts.select(F.inline(F.array(*pairs)))


def counter_steps(samples: DataFrame, series: list[str], at: str, value: str) -> DataFrame:
    """Adds step: growth since the sample before; after a reset, the new value. A series is cut into hours, each of which
    knows the last value before it, so that a busy series' samples don't meet in one task."""
    cut = samples.withColumn("hour_", F.date_trunc("HOUR", at))
    last = cut.groupBy(*series, "hour_").agg(F.max_by(value, at).alias("last_"))
    last = last.withColumn("before_", F.lag("last_").over(Window.partitionBy(*series).orderBy("hour_"))).drop("last_")
    own = Window.partitionBy(*series, "hour_").orderBy(at)
    cut = cut.withColumn("lag_", F.lag(F.struct(F.col(value).alias("v"))).over(own)).join(last, [*series, "hour_"])
    old = F.when(c("lag_").isNull(), c("before_")).otherwise(c("lag_.v"))
    step = F.when(old.isNull(), F.lit(0.0)).when(c(value) >= old, c(value) - old).otherwise(F.greatest(F.lit(0.0), c(value)))
    return cut.withColumn("step", step).drop("hour_", "lag_", "before_")


def rates(samples: DataFrame, series: list[str], at: str, value: str, width: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """Growth a second of each series in windows of a width."""
    return counter_steps(samples, series, at, value).groupBy(F.window(at, width).alias("w"), *series).agg((F.sum("step") / seconds).alias("rate")).select(c("w.start").alias("start"), *series, "rate")


def numbered(samples: DataFrame, keys: list[str], order: list[str], at: str) -> DataFrame:
    """Adds nth (from 1) by the order of samples of a key, whose first column is the time `at`. Counts of hours come first,
    so that a busy key's samples don't meet in one task."""
    cut = samples.withColumn("hour_", F.date_trunc("HOUR", at))
    counts = cut.groupBy(*keys, "hour_").agg(F.count("*").alias("in_hour_"))
    earlier = Window.partitionBy(*keys).orderBy("hour_").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base_", F.coalesce(F.sum("in_hour_").over(earlier), F.lit(0))).drop("in_hour_")
    within = F.row_number().over(Window.partitionBy(*keys, "hour_").orderBy(*order))
    return cut.withColumn("within_", within).join(counts, [*keys, "hour_"]).withColumn("nth", c("base_") + c("within_")).drop("hour_", "base_", "within_")


def rolling_percentiles(samples: DataFrame, keys: list[str], order: list[str], at: str, value: str, percents: tuple[float, ...], size: int = 20_000, every: int = 1000) -> DataFrame:
    """Percentiles of the last `size` samples of a key, worked out anew at each `every`-th: key, sample number, percentiles.
    A sample takes part in size / every of them; no frame is walked through row by row."""
    held = numbered(samples, keys, order, at)
    first = F.ceil(c("nth") / every).cast("long")
    seen = held.withColumn("point", F.explode(F.sequence(first, first + (size // every - 1)))).withColumn("sample_no", c("point") * every)
    ends = held.groupBy(*keys).agg(F.max("nth").alias("samples"))
    due = seen.join(ends, keys).where(c("sample_no") <= c("samples"))
    return due.groupBy(*keys, "sample_no").agg(*(percentile(value, p).alias(f"p{p:g}") for p in percents))


def counter_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """metric and delta of (metric, value) tables; a counter that fell was reset."""
    both = after.select("metric", c("value").alias("new")).join(before.select("metric", c("value").alias("old")), "metric", "left")
    old = F.coalesce("old", F.lit(0.0))
    return both.select("metric", F.when(c("new") >= old, c("new") - old).otherwise(F.greatest(F.lit(0.0), "new")).alias("delta"))


def outcome(achieved: Column, target: Column) -> Column:
    return F.when(achieved >= target * 0.9, "pass").when(achieved >= target * 0.7, "partial").otherwise("fail")


def bottleneck(achieved: Column, target: Column, insert_p95: Column, write_p95: Column, lag: Column) -> Column:
    return F.when(lag > target * 2, "kafka_consumer_lag_growth").when(insert_p95 > 250.0, "clickhouse_insert_latency").when(write_p95 > 50.0, "redis_write_latency").when(achieved < target * 0.8, "processor_throughput_limit").otherwise("no_major_bottleneck_observed")


def advice(name: Column) -> Column:
    out = F.lit(OTHER_ADVICE)
    for key, text in ADVICE.items():
        out = F.when(name == key, text).otherwise(out)
    return out


def exposition(lines: DataFrame, text: str = "value") -> DataFrame:
    """name, labels (a map) and value of each sample line of a metrics exposition; comments, blank and malformed lines
    are skipped. A sample is a name, labels in braces or none, a float (a timestamp may follow)."""
    quoted = r'"(?:\\.|[^"\\])*"'
    line = F.btrim(c(text), F.lit(" \t\r\n"))
    name = F.regexp_extract("line", r"^[^\s{]*", 0)
    named = lines.select(line.alias("line")).where(~c("line").startswith("#")).select("line", name.alias("name"))
    named = named.where(c("name").rlike(r"^[A-Za-z_:][A-Za-z0-9_:]*$"))
    rest = F.btrim(F.expr("substring(line, length(name) + 1)"))
    braced = F.regexp_extract("rest", rf'^\{{(?:{quoted}|[^"}}])*\}}', 0)
    split = named.select("name", rest.alias("rest")).withColumn("labelled", c("rest").startswith("{")).withColumn("body", braced)
    split = split.where(~c("labelled") | (c("body") != "")).withColumn("number", F.split(F.btrim(F.expr("substring(rest, length(body) + 1)")), r"\s+")[0])
    # The engine's own cast reads every float of the format, but also takes a type letter at the end.
    split = split.withColumn("number", F.when(~c("number").rlike(r"[0-9.][dDfF]$"), c("number").try_cast("double"))).where("number is not null")
    pair = rf"([A-Za-z_][A-Za-z0-9_]*)\s*=\s*({quoted})"
    values = F.transform(F.regexp_extract_all("body", F.lit(pair), 2), lambda v: F.substr(v, F.lit(2), F.length(v) - 2))
    mark = "\x00"
    plain = lambda v: F.replace(F.replace(F.replace(F.replace(v, F.lit("\\\\"), F.lit(mark)), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n")), F.lit(mark), F.lit("\\"))
    return split.select("name", F.map_from_arrays(F.regexp_extract_all("body", F.lit(pair), 1), F.transform(values, plain)).alias("labels"), c("number").alias("value"))
