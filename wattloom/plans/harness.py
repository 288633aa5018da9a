"""Timing of queries and of point reads, and the files that a run leaves: JSON, CSV, Markdown, a summary of all runs."""

from __future__ import annotations

import csv
import json
import os
import platform
import random
import subprocess
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What is told of the timings of a query or of reads, in milliseconds.
FIGURES = ("p50_ms", "p95_ms", "p99_ms", "avg_ms", "max_ms")


def percentile(values: list[float], p: float) -> float:
    """Linear between the two nearest ranks; 0 without values."""
    if not values:
        return 0.0
    held = sorted(values)
    at = (len(held) - 1) * min(max(p, 0.0), 100.0) / 100
    low = int(at)
    return held[low] + (held[min(low + 1, len(held) - 1)] - held[low]) * (at - low)


def figures(took_ms: list[float]) -> dict[str, float]:
    mean = sum(took_ms) / len(took_ms) if took_ms else 0.0
    values = (*(percentile(took_ms, p) for p in (50, 95, 99)), mean, max(took_ms, default=0.0))
    return {name: round(v, 3) for name, v in zip(FIGURES, values)}


def time_queries(queries: dict[str, Callable[[], DataFrame]], iterations: int = 3) -> list[dict]:
    """One row a query: iterations, failures with the last error, and figures of the runs that ended well. A query is run to
    the end and its rows are dropped, so that nothing but the engine is timed."""
    out = []
    for name, made in queries.items():
        took, error = [], None
        for _ in range(iterations):
            began = time.perf_counter()
            try:
                made().write.format("noop").mode("overwrite").save()
                took.append((time.perf_counter() - began) * 1000)
            except Exception as e:  # a failing query is a figure of the run, not its end
                error = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
        out.append({"query": name, "iterations": iterations, "failures": iterations - len(took), "error": error, **figures(took)})
    return out


def point_reads(state: DataFrame, key: str, seconds: float = 20.0, sample: int = 500, seed: int = 17) -> dict:
    """Reads of single keys, drawn from a sample of them, for some seconds: how many a second, and their figures."""
    keys = [r[0] for r in state.select(key).distinct().orderBy(F.xxhash64(key)).limit(sample).collect()]
    rng, took, end = random.Random(seed), [], time.perf_counter() + seconds
    while keys and time.perf_counter() < end:
        began = time.perf_counter()
        state.where(F.col(key) == rng.choice(keys)).collect()
        took.append((time.perf_counter() - began) * 1000)
    return {"keys": len(keys), "reads": len(took), "reads_per_second": round(len(took) / seconds, 3) if seconds > 0 else 0.0, **figures(took)}


def achieved_rate(accepted: float | None, generated: float | None) -> float:
    """Events a second that a run achieved: those accepted, or those generated where none are known to be accepted."""
    return float(accepted or generated or 0.0)


def environment(spark: SparkSession) -> dict:
    """What a run ran on."""
    conf = spark.sparkContext.getConf()
    try:
        commit = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10).stdout.strip() or None
    except OSError:
        commit = None
    return {
        "at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "platform": platform.platform(),
        "python": platform.python_version(),
        "cpus": os.cpu_count(),
        "spark": spark.version,
        "master": spark.sparkContext.master,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "driver_memory": conf.get("spark.driver.memory", None),
        "commit": commit,
    }


def markdown(rows: list[dict]) -> str:
    """A table of rows that share their names."""
    if not rows:
        return ""
    names = list(rows[0])
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [names, ["-"] * len(names), *([cell(r.get(n)) for n in names] for r in rows)]
    return "".join(f"| {' | '.join(line)} |\n" for line in lines)


def write_results(rows: list[dict], about: dict, folder: str, run: str) -> None:
    """A run's files in a folder of its own, the same under `latest`, and a line in the summary of all runs."""
    for where in (os.path.join(folder, run), os.path.join(folder, "latest")):
        os.makedirs(where, exist_ok=True)
        with open(os.path.join(where, "results.json"), "w") as f:
            json.dump({"run": run, "environment": about, "results": rows}, f, indent=1)
        with open(os.path.join(where, "results.csv"), "w", newline="") as f:
            sheet = csv.DictWriter(f, list(rows[0]) if rows else [])
            sheet.writeheader()
            sheet.writerows(rows)
        with open(os.path.join(where, "results.md"), "w") as f:
            f.write(f"# {run}\n\n{markdown(rows)}")
    with open(os.path.join(folder, "summary.jsonl"), "a") as f:
        f.write(json.dumps({"run": run, **summary(rows), "environment": about}) + "\n")


def summary(rows: list[dict]) -> dict:
    """Families, failures and the percentiles over families of a run's percentiles."""
    of = lambda name, p: round(percentile([r[name] for r in rows], p), 3)
    return {"families": len(rows), "failures": sum(r["failures"] for r in rows), "p95_of_p95_ms": of("p95_ms", 95), "p99_of_p99_ms": of("p99_ms", 99), "max_p99_ms": of("p99_ms", 100)}


def flattened(sample: dict, prefix: str = "") -> dict[str, float]:
    """The numbers of a nested sample under dotted names."""
    out: dict[str, float] = {}
    for name, value in sample.items():
        if isinstance(value, dict):
            out |= flattened(value, f"{prefix}{name}.")
        elif isinstance(value, (int, float)) and not isinstance(value, bool):
            out[prefix + name] = float(value)
    return out
