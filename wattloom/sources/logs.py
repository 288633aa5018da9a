"""Where log records, settings and files come from."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.schema import LOG


@dataclass(frozen=True)
class Settings:
    """Typed settings; WATTLOOM_<NAME> in the environment overrides a file, out-of-range values are clamped."""

    topic: str = "raw"
    bootstrap: str = "localhost:9092"
    starting_offsets: str = "latest"
    max_records: int = 50_000
    allowed_lateness: int = 600
    inactivity_timeout: int = 900
    dedup_ttl: int = 86_400
    mirror_late: bool = True
    watermark: str = "15 minutes"

    @classmethod
    def load(cls, path: str | None = None, environ: dict[str, str] | None = None) -> Settings:
        raw: dict = {}
        if path:
            with open(path) as f:
                raw = _mapping(f.read())
        environ = os.environ if environ is None else environ
        out = {}
        for x in fields(cls):
            value = environ.get(f"WATTLOOM_{x.name.upper()}", raw.get(x.name, x.default))
            out[x.name] = _typed(value, type(x.default), x.default)
        out |= {"max_records": max(1, out["max_records"]), "allowed_lateness": max(1, out["allowed_lateness"]), "inactivity_timeout": max(1, out["inactivity_timeout"]), "dedup_ttl": max(60, out["dedup_ttl"])}
        return cls(**out)


def _mapping(text: str) -> dict:
    try:
        import yaml

        found = yaml.safe_load(text)
    except ImportError:
        found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError("the top level of a settings file must be a mapping")
    return found


def _typed(value, kind: type, default):
    try:
        if kind is bool:
            return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "on")
        return kind(value)
    except (TypeError, ValueError):
        return default


def file_log(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """A stream of log records from Parquet files with the columns of a log."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", max_files).parquet(path)


def text_log(spark: SparkSession, path: str, topic: str = "raw") -> DataFrame:
    """A stream of log records from files of JSON lines. A line's place is its file and the block it was read with: its
    timestamp is the file's, its offset a hash of place and text, as a stream has no line numbers; lines alike in a
    file are one record."""
    lines = spark.readStream.text(path).select("value", "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_block_start")
    place = F.xxhash64("file_path", "file_block_start", "value").bitwiseAND(F.lit((1 << 62) - 1))
    value = F.col("value").cast("binary").alias("value")
    partition = F.pmod(F.xxhash64("file_path"), F.lit(1 << 16)).cast("int").alias("partition")
    return lines.select(F.lit(None).cast("binary").alias("key"), value, F.lit(topic).alias("topic"), partition, place.alias("offset"), F.col("file_modification_time").alias("timestamp"))


def kafka_log(spark: SparkSession, settings: Settings) -> DataFrame:
    """A stream of log records from Kafka; its connector must be on the class path."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", settings.bootstrap).option("subscribe", settings.topic)
    return stream.option("startingOffsets", settings.starting_offsets).option("maxOffsetsPerTrigger", settings.max_records).load().select(*(f.name for f in LOG))


def results(spark: SparkSession, path: str) -> DataFrame:
    """Result files of benchmark runs; unreadable ones are dropped."""
    return spark.read.option("mode", "DROPMALFORMED").option("multiLine", True).json(path)
