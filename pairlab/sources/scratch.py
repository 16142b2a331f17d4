"""Intermediate results as tables in the shared scratch folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

# Column of a table's private row numbers.
ROW = "_pairlab_row"

_local_folder: str | None = None
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    _local_folder = _local_folder or tempfile.mkdtemp(prefix="pairlab-")
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/pairlab/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """Write a table and read it back: lineage ends there, and a lost executor costs nothing that was written."""
    path = path or scratch_path(df.sparkSession, name)
    _written.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, keep: Iterable[str] = ()) -> int:
    """Delete the scratch tables this process has written so far, but for the paths in ``keep``; their number. To be called
    when nothing that reads them is still to be used, as at the end of a job whose result has been written."""
    kept, gone = set(keep), 0
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in _written if p not in kept]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(place.getFileSystem(configuration).delete(place, True))
        _written.remove(path)
    return gone


def with_row_numbers(df: DataFrame) -> tuple[DataFrame, str]:
    """The table with a private number per row, unique and stored, so that every later read sees the same one, and the name
    of that column, which no column of the table has."""
    name = ROW
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name
