"""The whole batch plan over the events table: admission, sessions, facts, rollups, serving tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.schema import ALLOWED_LATENESS, INACTIVITY_TIMEOUT
from wattloom.operators import admission, rollups, serving
from wattloom.operators import sessions as machine
from wattloom.sources import tables
from wattloom.sources.adapter import arrivals

#: The present of the test tables: the sweep and all relative times count from it.
AS_OF = "2024-01-31 00:00:00"


class Telemetry:
    """Lazy DataFrames of every table; each is a plan of its own, and Catalyst prunes what isn't read."""

    def __init__(self, events: DataFrame, as_of: str = AS_OF, allowed: int = ALLOWED_LATENESS, timeout: int = INACTIVITY_TIMEOUT):
        self.arrivals, self.as_of, self.allowed, self.timeout = events, F.lit(as_of).cast("timestamp"), allowed, timeout

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Telemetry:
        return cls(arrivals(spark, sf_dir))

    @cached_property
    def admitted(self) -> DataFrame:
        return admission.admitted(self.arrivals, self.allowed)

    @cached_property
    def verdicts(self) -> DataFrame:
        return machine.session_verdicts(self.admitted)

    @cached_property
    def raw_events(self) -> DataFrame:
        return self.verdicts.where("accepted")

    @cached_property
    def snapshots(self) -> DataFrame:
        return machine.snapshots(self.verdicts)

    @cached_property
    def finalized(self) -> DataFrame:
        return machine.finalized(self.snapshots, self.as_of, self.timeout)

    @cached_property
    def facts(self) -> DataFrame:
        return machine.session_facts(self.finalized)

    @cached_property
    def counted(self) -> DataFrame:
        return machine.active_counts(self.verdicts)

    @cached_property
    def station_minute(self) -> DataFrame:
        return rollups.station_minute(rollups.with_session_tariff(self.counted, self.snapshots), self.facts)

    @cached_property
    def operator_hour(self) -> DataFrame:
        return rollups.operator_hour(self.raw_events, self.facts)

    @cached_property
    def city_day_faults(self) -> DataFrame:
        return rollups.city_day_faults(self.raw_events)

    @cached_property
    def serving_inputs(self) -> DataFrame:
        return serving.serving_inputs(self.counted)

    def views(self) -> dict[str, DataFrame]:
        return {"raw_events": self.raw_events, "fact_sessions": self.facts, "agg_station_minute": self.station_minute, "agg_operator_hour": self.operator_hour, "agg_city_day_faults": self.city_day_faults}

    def history(self, root: str) -> None:
        """Write the history and rollup tables, as a run over the log would leave them. Verdicts come first: all others are
        made from the written ones, so that admission and sessions run once."""
        self.verdicts.write.mode("overwrite").parquet(f"{root}/verdicts")
        held = Telemetry(self.arrivals, allowed=self.allowed, timeout=self.timeout)
        held.as_of, held.verdicts = self.as_of, self.arrivals.sparkSession.read.parquet(f"{root}/verdicts")
        for name, df in held.views().items():
            flat = df.select(*(x for x, kind in df.dtypes if not kind.startswith(("array", "struct"))))
            tables.write(flat, root, name)


def stored_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables that the analytical queries read. They are written once for a state of the events table (its files' sizes
    and times), by the first query that needs them; all others scan them."""
    root = f"{tables.shared_root(spark)}/{tables.state_of(spark, f'{sf_dir}/events.parquet')}"
    if not tables.is_marked(spark, root):
        Telemetry.of(spark, sf_dir).history(root)
        tables.mark(spark, root)
    return {name: tables.read(spark, root, name) for name in ("raw_events", "fact_sessions", "agg_station_minute", "agg_operator_hour", "agg_city_day_faults")}
