"""History tables as partitioned Parquet, and the writers of results."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The time column and the order of each history table.
LAYOUT = {
    "raw_events": ("event_time", ("station_id", "event_time", "event_id")),
    "dead_letter_events": ("failed_at", ("failed_at", "event_id")),
    "session_dead_letters": ("failed_at", ("failed_at", "session_id")),
    "late_events_rejected": ("rejected_at", ("rejected_at", "station_id", "event_id")),
    "fact_sessions": ("session_start_time", ("operator_id", "station_id", "session_start_time", "session_id")),
    "agg_station_minute": ("bucket_minute", ("bucket_minute", "operator_id", "station_id")),
    "agg_operator_hour": ("bucket_hour", ("bucket_hour", "operator_id")),
    "agg_city_day_faults": ("bucket_day", ("bucket_day", "operator_id", "country_code", "city")),
}


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_root(spark: SparkSession) -> str:
    """The folder for tables that driver and executors share; a temporary one only where all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return f"{found.rstrip('/')}/wattloom-tables/{spark.sparkContext.applicationId}"


def state_of(spark: SparkSession, path: str) -> str:
    """A name for what a path holds now: its files with their sizes and times."""
    where, files = _files(spark, path)
    found, listed = files.listFiles(where, True), []
    while found.hasNext():
        x = found.next()
        listed.append(f"{x.getPath()} {x.getLen()} {x.getModificationTime()}")
    return hashlib.sha256("\n".join([path, *sorted(listed)]).encode()).hexdigest()[:24]


def is_marked(spark: SparkSession, root: str) -> bool:
    where, files = _files(spark, f"{root}/_COMPLETE")
    return files.exists(where)


def mark(spark: SparkSession, root: str) -> None:
    """Note that all tables of a folder are there: what a broken run has left is written again."""
    where, files = _files(spark, f"{root}/_COMPLETE")
    files.create(where, True).close()


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """Rows with their month, sorted as the table's files are."""
    at, order = LAYOUT[name]
    return df.withColumn("yyyymm", F.date_format(at, "yyyyMM").cast("int")).sortWithinPartitions("yyyymm", *order)


def write(df: DataFrame, root: str, name: str) -> None:
    """A whole table, by month; what was there is replaced."""
    _laid_out(df, name).write.mode("overwrite").partitionBy("yyyymm").parquet(f"{root}/{name}")


def append(df: DataFrame, root: str, name: str, batch_id: int | None = None) -> None:
    """Append to a table, by month, sorted within files. With a batch id the batch has a folder of its own,
    which a repeat of the batch overwrites: the write is idempotent."""
    rows = _laid_out(df, name)
    if batch_id is None:
        rows.write.mode("append").partitionBy("yyyymm").parquet(f"{root}/{name}")
    else:
        rows.write.mode("overwrite").partitionBy("yyyymm").parquet(f"{root}/{name}/batch={batch_id}")


def read(spark: SparkSession, root: str, name: str, since: str | None = None) -> DataFrame:
    """A table, or its rows since a time; the months are pruned with it."""
    df = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    if since is None:
        return df
    month = int(since[:4] + since[5:7])
    return df.where((F.col("yyyymm") >= month) & (F.col(LAYOUT[name][0]) >= F.lit(since).cast("timestamp")))


def compact(spark: SparkSession, root: str, name: str, target: str) -> None:
    """One table's batches rewritten as few sorted files a month."""
    at, order = LAYOUT[name]
    read(spark, root, name).drop("batch").repartition("yyyymm").sortWithinPartitions("yyyymm", *order).write.mode("overwrite").partitionBy("yyyymm").parquet(f"{target}/{name}")
