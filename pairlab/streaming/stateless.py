"""The stateless preprocessing steps on a stream: null removal, cleaning, length bounds.

Dedup looks at a whole split and stays a batch step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairlab.plans.preprocess import preprocess


def preprocess_stream(df: DataFrame, text_col: str = "article", summary_col: str = "highlights", **options) -> DataFrame:
    return preprocess(df, text_col, summary_col, use_drop_duplicates=False, **options)


def run_preprocess_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    text_col: str = "article",
    summary_col: str = "highlights",
    max_files: int | None = None,
    **options,
) -> list[int]:
    """Process what has come into a Parquet folder since the last run, and stop; rows per micro-batch read.

    The checkpoint remembers which files are done and the sink's log which batches are whole, so a run that is broken off
    or started again neither loses nor repeats a row.  ``max_files`` bounds a micro-batch.
    """
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        preprocess_stream(reader.parquet(source), text_col, summary_col, **options)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [progress["numInputRows"] for progress in query.recentProgress]
