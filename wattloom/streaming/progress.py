"""What a running stream tells of itself: counters observed in its plan, lag, rates, as metric rows and exposition text."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: The name under which counters are observed.
OBSERVED = "wattloom"


def with_counters(parsed_log: DataFrame) -> DataFrame:
    """Parsed records, counted as they pass: no second look at the data."""
    return parsed_log.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("records_total"),
        F.count_if(F.col("error_class") == "parse").alias("parse_errors_total"),
        F.count_if(F.col("error_class") == "schema").alias("schema_errors_total"),
        F.count_if(F.col("error_reason").isNull()).alias("valid_total"),
    )


def lag(end_offset: str | dict | None, latest_offset: str | dict | None) -> int:
    """Records that a source holds beyond what has been read: the sum over partitions, none below zero."""
    read, there = (json.loads(x) if isinstance(x, str) else x for x in (end_offset, latest_offset))
    total = 0
    for topic, partitions in (there or {}).items():
        if isinstance(partitions, dict):
            done = (read or {}).get(topic) or {}
            total += sum(max(0, int(n) - int(done.get(p, 0))) for p, n in partitions.items())
    return total


def _escaped(value: str) -> str:
    return value.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def exposition(rows: Iterable[tuple[str, dict[str, str], float]]) -> str:
    """Metric rows (name, labels, value) as exposition text, sorted, one line each."""
    lines = []
    for name, labels, value in rows:
        inner = ",".join(f'{k}="{_escaped(v)}"' for k, v in sorted(labels.items()))
        lines.append(f"{name}{{{inner}}} {value:g}" if inner else f"{name} {value:g}")
    return "".join(f"{line}\n" for line in sorted(lines))


class Progress(StreamingQueryListener):
    """Adds up observed counters over micro-batches and keeps the last lag and rates of each query."""

    def __init__(self):
        self.counters: dict[tuple[str, str], float] = {}
        self.gauges: dict[tuple[str, str], float] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        query = p.name or str(p.id)
        observed = p.observedMetrics.get(OBSERVED)
        for name, value in (observed.asDict() if observed else {}).items():
            self.counters[query, name] = self.counters.get((query, name), 0.0) + float(value)
        self.counters[query, "input_rows_total"] = self.counters.get((query, "input_rows_total"), 0.0) + float(p.numInputRows)
        self.gauges[query, "processed_rows_per_second"] = float(p.processedRowsPerSecond or 0.0)
        self.gauges[query, "lag_records"] = float(sum(lag(s.endOffset, s.latestOffset) for s in p.sources))

    def rows(self) -> list[tuple[str, dict[str, str], float]]:
        return [(f"wattloom_{name}", {"query": query}, value) for held in (self.counters, self.gauges) for (query, name), value in held.items()]
