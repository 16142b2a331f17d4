"""Sinks: processed Parquet, CSV, one-row JSON reports, summaries of text folders."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pairlab.functions.text import file_stem
from pairlab.sources import readers


def ingest_local(
    spark: SparkSession, source: str, target: str, text_col: str = "article", summary_col: str = "highlights"
) -> DataFrame:
    """CSV splits to one Parquet table with stored ids, partitioned by split; a table already there is kept."""
    raw = readers.with_id(readers.read_pairs_csv(spark, source, text_col, summary_col))
    raw.write.mode("ignore").partitionBy("split").parquet(target)
    return spark.read.parquet(target)


def write_processed(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Parquet with one folder per split, written by the tasks that hold the rows."""
    df.write.mode(mode).partitionBy("split").parquet(folder)


def write_csv(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def write_report_json(report: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """A one-row report as one JSON text."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).coalesce(1).write.mode(mode).text(folder)


def write_text_summaries(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """(file_stem, generated_summary) as a table: one output file per row is not a thing a cluster should write."""
    df.select(file_stem("file_name").alias("file_stem"), "generated_summary").write.mode(mode).parquet(folder)


@dataclass(frozen=True)
class Throughput:
    rows: int
    seconds: float

    @property
    def seconds_per_row(self) -> float:
        return self.seconds / max(self.rows, 1)


def counted_write(df: DataFrame, seen: Mapping[str, Observation], write: Callable[[DataFrame], None]) -> dict[str, int] | None:
    """Write a table whose plan holds the observations ``seen``, and what they counted.  A stage that ran again, after a lost
    executor or a failed task, may have counted twice: then there is no count (None), and the caller has to count anew."""
    context = df.sparkSession.sparkContext
    outer, group = context.getLocalProperty("spark.jobGroup.id"), f"pairlab-{uuid.uuid4().hex}"
    context.setLocalProperty("spark.jobGroup.id", group)
    try:
        write(df)
    finally:
        context.setLocalProperty("spark.jobGroup.id", outer)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
    if any(stage is not None and (stage.currentAttemptId or stage.numFailedTasks) for stage in stages):
        return None
    return {point: observation.get["rows"] for point, observation in seen.items()}


def timed_write(df: DataFrame, folder: str, mode: str = "overwrite") -> Throughput:
    """Write once and measure: wall time over rows counted on the way, without a second job."""
    seen = Observation("throughput")
    start = time.perf_counter()
    df.observe(seen, F.count("*").alias("rows")).write.mode(mode).parquet(folder)
    return Throughput(seen.get["rows"], time.perf_counter() - start)
