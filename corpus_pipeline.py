"""From raw documents to token ids: quality, near duplicates, repeated passages, benchmark items, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of ``documents``. Near duplicates are told apart by row, whatever their ids; the other filters leave rows without
an id untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairlab.llm import bpe, decontaminate, minhash, quality, suffix_dedup
from pairlab.session import ship
from pairlab.sources.scratch import materialize, with_row_numbers

# No SQL can express the classifier, near-duplicate groups or the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None
QUALITY_THRESHOLD = 0.7
REPEATED_BYTES = 100


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; word vectors come from all of ``docs``."""
    ship(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_score(docs, model, score_column="_llm_score")
    return scored.where(F.col("_llm_score") >= QUALITY_THRESHOLD).drop("_llm_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, the first of its rows (words in runs of five,
    0.8). Rows without an id come last."""
    ship(spark)
    rows, number = with_row_numbers(docs)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(number).alias("row"))
    groups = minhash.near_duplicates(rows.select(order.alias("place"), "text"), "place", width=5, percent=80)
    gone = groups.where("NOT kept").select(F.col("place.row").alias(number))
    return rows.join(gone, number, "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document, or the same one, already has; the first copy stays.
    Documents of which nothing is left go."""
    ship(spark)
    return suffix_dedup.without_repeats(docs, width=REPEATED_BYTES).where("text IS NULL OR length(trim(text)) > 0")


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, plain or with other numbers, names or units. Each row is judged by its own
    text, whatever its id."""
    ship(spark)
    rows, number = with_row_numbers(docs)
    held = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), number)
    return rows.join(held.select(number).distinct(), number, "left_anti").select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of what is left."""
    ship(spark)
    return bpe.digest(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True).drop("ids_sha256")


STAGES = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_items),
    ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
