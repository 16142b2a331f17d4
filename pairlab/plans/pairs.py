"""Text-pair views over the test tables, which have documents and conversations but no summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _first_line_end(value: Column) -> Column:
    return F.instr(value, "\n")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, split, article, highlights) of ``documents``: the first line is the summary, the rest the article.

    One-line documents have a null summary, every fifth article carries a dateline tag, and the last digit of
    the id names the split.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    body = F.col("text")
    line_end = _first_line_end(body)
    last_digit = F.col("doc_id") % 10
    tag = F.when(F.col("doc_id") % 5 == 0, "(CNN) -- ").otherwise("")
    article = F.when(line_end > 0, F.substr(body, line_end + 1)).otherwise(body)
    return docs.select(
        F.col("doc_id").alias("id"),
        F.when(last_digit == 0, "test").when(last_digit == 1, "validation").otherwise("train").alias("split"),
        F.concat(tag, article).alias("article"),
        F.when(line_end > 0, F.substr(body, F.lit(1), line_end - 1)).alias("highlights"),
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, split, article, highlights) of ``conversations``: a user turn and the assistant turn after it.

    Turns are numbered without gaps, so the next turn is an equality on (conversation, number): the longest
    conversation is spread like any other rows.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("article"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("highlights")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("test").alias("split"), "article", "highlights"
    )
