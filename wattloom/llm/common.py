"""Reading tables, shared intermediate storage and small worker-side helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of an Arrow batch, the same for all operators: a plan made for one may run after another set its own.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

#: Each scratch file on a local disk costs permission commands, for which Hadoop forks a process, and for the moment of a
#: fork the child counts with all of its executor's memory. Without checksum files there are two for a file instead of
#: three; stores that aren't local don't read these settings.
LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: For a large table of values that seldom repeat, read once or twice: light compression, no dictionaries, no statistics of sizes.
LIGHT = {"parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false", "parquet.size.statistics.enabled": "false"}
#: Rows that a scratch file holds at least, where the number of rows is known beforehand.
ROWS_A_FILE = 8192



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, by bytes above all: texts may be long."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="wattloom-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def files_for(rows: int) -> int:
    """The most files that a table of about so many rows is dealt to: in proportion, so that no task grows with the input."""
    return 1 + rows // ROWS_A_FILE


def saved(df: DataFrame, files: int | None = None, light: bool = False) -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage, survives lost executors. The shuffle files
    of the job that writes it go when it ends. Where files is given, more partitions than that are written together. light: write it cheaply."""
    spark = df.sparkSession
    df = df if files is None else df.coalesce(files)
    path = f"{shared_dir(spark)}/wattloom/{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(compression="zstd", **LOCAL_FILES, **(LIGHT if light else {})).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._wattloom_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete what saved() wrote, once nothing that is still to run reads it."""
    path = getattr(df, "_wattloom_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partition_index() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def as_bytes(column) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    for x in column.cast(pa.binary()):
        yield x.as_py() or b""
