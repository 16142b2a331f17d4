"""One query per operator over the given tables.  Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairlab.operators import (
    cleaning,
    dedup,
    features,
    generation,
    matching,
    profile,
    rouge,
    sampling,
    words,
)
from pairlab.plans import evaluate as scoring, report
from pairlab.plans.pairs import pairs, turn_pairs
from pairlab.plans.preprocess import preprocess, step_row_counts
from pairlab.sources import readers, sinks
from pairlab.sources.scratch import materialize, scratch_path
from pairlab.streaming import stateless

Query = Callable[[SparkSession, str], DataFrame]

VOCAB = 5_000
PREFIX = "summarize: "


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_na(pairs(spark, sf_dir))


def lead_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, article, reference_summary, generated_summary) of the cleaned pairs with the lead baseline."""
    cleaned = cleaning.clean_pairs(filled(spark, sf_dir))
    return generation.summarize_lead(cleaned).select(
        "id", "article", F.col("highlights").alias("reference_summary"), "generated_summary"
    )


def optional_reference_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all pairs, some of which have no reference."""
    cleaned = pairs(spark, sf_dir).withColumn("article", cleaning.text.clean_text("article"))
    return generation.summarize_lead(cleaned).withColumnRenamed("highlights", "reference_summary")


def line_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five leading sentences, one per line, against the whole document with its own lines."""
    return pairs(spark, sf_dir).select(
        "id",
        F.col("article").alias("reference_summary"),
        generation.lead("article", 5, "\n").alias("generated_summary"),
    )


def pairs_union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pairs(spark, sf_dir)
    parts = [
        cleaning.tag_split(table.where(F.col("split") == s).drop("split"), s) for s in readers.SPLITS
    ]
    return cleaning.union_splits(*parts).select("id", "split", "article", "highlights")


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose ids repeat: each is doubled whole, and different ones share ``id % 100``."""
    table = filled(spark, sf_dir).withColumn("id", F.col("id") % 100)
    return table.unionAll(table)


def vocabulary_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the table, numbered in order of frequency with a gap after each number."""
    table = pairs(spark, sf_dir)
    vocab = features.build_vocab(table, size=None)
    return vocab.withColumn("token_id", F.col("token_id") * 2 - features.FIRST_ID)


def encode_pairs_large_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As with a vocabulary too large to be sent to every task."""
    codes = features.encode_pairs(pairs(spark, sf_dir), vocabulary_with_gaps(spark, sf_dir), prefix=PREFIX, in_memory=0)
    return joined_with_commas(codes.select("id", "input_ids", "labels"))


def decode_ids_large_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = materialize(vocabulary_with_gaps(spark, sf_dir), "vocab")
    return features.decode_ids(features.encode_pairs(pairs(spark, sf_dir), vocab), vocab, "input_ids", in_memory=0)


def load_subset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = {"train": 10, "validation": 0, "test": None}
    return sampling.load_subset(pairs(spark, sf_dir), sizes).select("id", "split", "article", "highlights")


def processed_empty_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per split read back from a processed table whose validation rows were all filtered."""
    folder = scratch_path(spark, "processed")
    kept = preprocess(pairs(spark, sf_dir)).where("split <> 'validation'")
    sinks.write_processed(kept, folder)
    counts = [
        readers.read_split(spark, folder, s).agg(F.lit(s).alias("split"), F.count("*").alias("num_rows")) for s in readers.SPLITS
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


def dash_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning over texts whose blanks have become runs of dashes."""
    dashed = F.replace(F.col("article"), F.lit(" "), F.when(F.col("id") % 3 == 0, " --- ").otherwise("--"))
    return pairs(spark, sf_dir).select("id", cleaning.text.clean_text(dashed).alias("article"))


def summarize_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "summaries")
    sinks.write_csv(pairs(spark, sf_dir).select("id", "article"), source)
    made = scoring.summarize_csv(spark, source, generation.extractive_predictor(), target)
    return made.select(F.col("id").cast("bigint").alias("id"), "generated_summary")


def evaluate_table_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = scoring.evaluate_table(
        preprocess(pairs(spark, sf_dir)), generation.extractive_predictor(), preset={"test": None}, max_samples=20, latency=False
    )
    return rounded(results)


def processed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocess, write one folder per split, read the three splits back."""
    folder = scratch_path(spark, "processed")
    sinks.write_processed(preprocess(pairs(spark, sf_dir)), folder)
    back = cleaning.union_splits(*[readers.read_split(spark, folder, s) for s in readers.SPLITS])
    return back.select("id", "split", "article", "highlights")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "csv")
    sinks.write_csv(pairs(spark, sf_dir), folder)
    back = readers.read_csv(spark, folder)
    return back.select(F.col("id").cast("bigint").alias("id"), "split", "article", "highlights")


def predictions_vs_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and references from two tables, brought together by id."""
    predicted = lead_predictions(spark, sf_dir).select("id", "generated_summary")
    references = cleaning.clean_pairs(filled(spark, sf_dir)).select("id", "article", "highlights")
    return generation.comparison(generation.pair_predictions(predicted, references))


def joined_with_commas(df: DataFrame) -> DataFrame:
    """Arrays as text, so that both engines hash the same values."""
    return df.select(
        *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    )


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pairs(spark, sf_dir)
    return features.encode_pairs(table, features.build_vocab(table, size=VOCAB), prefix=PREFIX)


def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_with_commas(encoded(spark, sf_dir).select("id", "labels"))


def decode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pairs(spark, sf_dir)
    vocab = materialize(features.build_vocab(table, size=VOCAB), "vocab")
    codes = features.encode_pairs(table, vocab, prefix=PREFIX)
    restored = codes.select("id", features.unmask_labels(F.col("labels")).alias("labels"))
    return features.decode_ids(restored, vocab)


def token_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a token-embedding table: the label is the pair, odd and even vectors are its sides."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.select(
        F.col("label").cast("bigint").alias("id"),
        F.when(F.col("vec_id") % 2 == 0, "pred").otherwise("ref").alias("side"),
        F.col("vec_id").alias("pos"),  # sparse within a pair
        F.col("embedding").alias("vec"),
    )


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(pairs(spark, sf_dir)).select("num_rows", "num_columns", "text_bytes")


def turn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROUGE-1 without stems of assistant turns against the user turns before them."""
    turns = turn_pairs(spark, sf_dir).withColumnsRenamed(
        {"article": "reference_summary", "highlights": "generated_summary"}
    )
    return rounded(rouge.rouge_n(turns, 1, stem=False))


def evaluate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test split, extractive predictor, all scores; the latency is left out, it differs from run to run."""
    results = scoring.evaluate_table(preprocess(pairs(spark, sf_dir)), generation.extractive_predictor(), preset="full")
    return rounded(results.drop("avg_latency_sec_per_sample"))


def eda_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row report as (section, key, value) rows."""
    return report.flattened(report.eda_report(pairs(spark, sf_dir), sample=None))


def sample_exact_many_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 400 ids for each pair: so many that some share the leading digits of their digests."""
    many = pairs(spark, sf_dir).select(F.explode(F.sequence(F.col("id") * 400, F.col("id") * 400 + 399)).alias("id"))
    return sampling.sample_exact(many, 1000)


def predictor_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and batches per task, and whether the predictor's seconds were measured."""
    dealt = pairs(spark, sf_dir).repartitionById(8, (F.col("id") % 8).cast("int"))
    made = generation.summarize_table(dealt, generation.extractive_predictor(1), batch_size=16, timing_col="timing")
    seconds = generation.predictor_seconds(materialize(made.select("id", "timing"), "timed"))
    return seconds.select(F.col("task").cast("bigint").alias("task"), "num_rows", "num_batches", (F.col("seconds") > 0).cast("bigint").alias("measured"))


def run_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after each step, as counted by the job that wrote the table."""
    return scoring.write_preprocessed(pairs(spark, sf_dir), scratch_path(spark, "processed"))


def rouge_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rouge.with_f1(lead_predictions(spark, sf_dir), stem=False)
    return rouge.rouge_interval(materialize(scored.select("id", "rouge1", "rouge2"), "scored"), ("rouge1", "rouge2"))


def preprocess_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a folder, the second of which finds nothing new."""
    source, target, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "checkpoint"))
    pairs(spark, sf_dir).write.parquet(source)
    for _ in range(2):
        stateless.run_preprocess_stream(spark, source, target, checkpoint)
    return spark.read.parquet(target)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have a field too many or a quote that is never closed: good rows and lines set aside."""
    folder, aside = scratch_path(spark, "lines"), scratch_path(spark, "quarantine")
    value = F.concat(F.lit('"'), F.replace("highlights", F.lit('"'), F.lit('""')), F.lit('"'))
    fields = F.concat_ws(",", F.col("id").cast("string"), F.col("split"), F.coalesce(value, F.lit("")))
    broken = F.concat(F.col("id").cast("string"), F.lit(',"'), F.col("split"), F.lit(","), F.coalesce(F.replace("highlights", F.lit('"')), F.lit("")))
    last = F.col("id") % 7
    line = F.when(last == 0, F.concat(fields, F.lit(",more"))).when(last == 1, broken)
    pairs(spark, sf_dir).select(line.otherwise(fields)).write.text(folder)
    good = readers.read_csv_strict(spark, folder, ["id", "split", "highlights"], aside, header=False)
    rows = good.select(F.lit("row").alias("kind"), F.concat_ws(",", "id", "split", F.coalesce("highlights", F.lit("-"))).alias("value"))
    return rows.unionAll(spark.read.parquet(aside).select(F.lit("line"), "line"))


def read_text_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of all texts in folders of text files: one line per text, read as whole documents by split."""
    folder = scratch_path(spark, "texts")
    lines = pairs(spark, sf_dir).select("split", F.replace("highlights", F.lit("\n"), F.lit(" ")).alias("value"))
    lines.where("value IS NOT NULL").write.partitionBy("split").text(folder)
    found = None
    for split in readers.SPLITS:
        texts = readers.read_text_folder(spark, f"{folder}/split={split}")
        named = F.concat(cleaning.text.file_stem("file_name"), F.lit(".txt")) == F.col("file_name")
        rows = texts.agg(
            F.lit(split).alias("split"), F.sum(F.char_length("text")).alias("num_chars"),
            F.sum(F.regexp_count("text", F.lit("\n"))).cast("bigint").alias("num_lines"), F.count_if(~named).alias("odd_names"),
        )
        found = rows if found is None else found.unionAll(rows)
    return found


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length totals written as a JSON report and read back."""
    folder = scratch_path(spark, "report")
    totals = profile.length_totals(_lengths(spark, sf_dir)).select("num_rows", "empty_articles", "empty_summaries")
    sinks.write_report_json(totals, folder)
    return spark.read.schema("num_rows bigint, empty_articles bigint, empty_summaries bigint").json(folder)


def summarize_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary and scores of each text next to its reference."""
    texts = cleaning.clean_pairs(pairs(spark, sf_dir)).withColumnRenamed("highlights", "reference_summary")
    made = scoring.summarize_single(texts, generation.extractive_predictor())
    return made.select("id", "generated_summary", "rouge1", "rouge2", "rougeL")


def letter_tokens(value: Column) -> Column:
    """A user's tokenizer: runs of ASCII letters, counted in Python."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pc.cast(pc.count_substring_regex(texts, "[A-Za-z]+"), pa.int64())

    return count(value)


def user_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's step, tokenizer and analysis beside the library's own: two columns folded into the profile's one pass."""
    table = pairs(spark, sf_dir).transform(lambda df: df.where(cleaning.text.word_count("article") > 3))
    measured = profile.lengths(table, count_tokens=letter_tokens)
    analyses = {
        "tokens": [F.sum("article_tokens").alias("article"), F.sum("summary_tokens").alias("summary")],
        "longest": [F.max("article_chars").alias("article"), F.max("summary_chars").alias("summary")],
    }
    return report.shared_scan(measured, analyses)


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.lengths(pairs(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "pairs_union_splits": pairs_union_splits,
    "drop_na": filled,
    "drop_duplicates": lambda s, d: dedup.drop_duplicates(filled(s, d)).select("id", "split", "article", "highlights"),
    "drop_duplicates_repeated_ids": lambda s, d: dedup.drop_duplicates(repeated_ids(s, d)).select(
        "id", "split", "article", "highlights"
    ),
    "sample_exact_repeated_ids": lambda s, d: sampling.sample_exact(repeated_ids(s, d), 150).agg(F.count("*").alias("num_rows")),
    "encode_pairs_large_vocab": encode_pairs_large_vocab,
    "decode_ids_large_vocab": decode_ids_large_vocab,
    "load_subset_sizes": load_subset_sizes,
    "processed_empty_split": processed_empty_split,
    "dash_runs": dash_runs,
    "summarize_csv_roundtrip": summarize_csv_roundtrip,
    "evaluate_table_subset": evaluate_table_subset,
    "clean_text": lambda s, d: cleaning.clean_pairs(pairs(s, d)),
    "length_filter": lambda s, d: cleaning.length_filter(filled(s, d)),
    "preprocess_rows": lambda s, d: preprocess(pairs(s, d)),
    "preprocess_counts": lambda s, d: profile.split_sizes(preprocess(pairs(s, d))),
    "step_row_counts": lambda s, d: step_row_counts(pairs(s, d)),
    "processed_roundtrip": processed_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "overview": overview,
    "missing_values": lambda s, d: profile.missing_values(pairs(s, d)),
    "duplicate_counts": lambda s, d: dedup.duplicate_counts(pairs(s, d)),
    "length_stats": lambda s, d: rounded(profile.length_stats(_lengths(s, d))),
    "compression_ratio": lambda s, d: rounded(profile.compression_ratio(_lengths(s, d))),
    "empty_counts": lambda s, d: profile.empty_counts(_lengths(s, d)),
    "row_counts": lambda s, d: profile.row_counts(pairs(s, d)),
    "split_sizes": lambda s, d: profile.split_sizes(pairs(s, d)),
    "split_inspection": lambda s, d: rounded(profile.split_inspection(_lengths(s, d))),
    "length_histogram": lambda s, d: profile.length_histogram(_lengths(s, d)),
    "non_empty_articles": lambda s, d: cleaning.non_empty_articles(pairs(s, d)),
    "sample_exact": lambda s, d: sampling.sample_exact(pairs(s, d), 500).select("id", "split", "article", "highlights"),
    "load_subset_dev": lambda s, d: sampling.load_subset(pairs(s, d), "dev").select("id", "split", "article", "highlights"),
    "token_counts": lambda s, d: rounded(profile.token_counts(_lengths(s, d), 5000)),
    "token_counts_all": lambda s, d: rounded(profile.token_counts(_lengths(s, d), None)),
    "sample_pairs": lambda s, d: sampling.sample_pairs(pairs(s, d)),
    "scatter_sample": lambda s, d: profile.scatter_sample(_lengths(s, d), 5000),
    "top_words": lambda s, d: words.top_words(pairs(s, d), sample=None),
    "top_ngrams": lambda s, d: words.top_ngrams(pairs(s, d), sample=None),
    "summarize_lead": lambda s, d: generation.summarize_lead(pairs(s, d)).select("id", "generated_summary"),
    "summarize_extractive": lambda s, d: generation.summarize_extractive(pairs(s, d)).select("id", "generated_summary"),
    "summarize_table": lambda s, d: generation.summarize_table(
        pairs(s, d), generation.extractive_predictor(1), prefix=PREFIX, batch_size=16, num_beams=2
    ).select("id", "split", "generated_summary"),
    "generation_length_stats": lambda s, d: rounded(generation.generation_length_stats(lead_predictions(s, d))),
    "predictions_vs_references": predictions_vs_references,
    "stem_map": lambda s, d: rouge.stem_map(pairs(s, d), "article"),
    "rouge1_rows": lambda s, d: rounded(rouge.rouge_n(lead_predictions(s, d), 1, stem=False)),
    "rouge2_rows": lambda s, d: rounded(rouge.rouge_n(lead_predictions(s, d), 2, stem=False)),
    "rouge1_stem_rows": lambda s, d: rounded(rouge.rouge_n(lead_predictions(s, d), 1)),
    "rouge1_turn_rows": turn_scores,
    "rouge_l_rows": lambda s, d: rounded(rouge.rouge_l(lead_predictions(s, d))),
    "rouge_lsum_rows": lambda s, d: rounded(rouge.rouge_lsum(line_predictions(s, d))),
    "rouge_rows": lambda s, d: rouge.rouge_rows(optional_reference_predictions(s, d)),
    "rouge_corpus_nostem": lambda s, d: rouge.rouge_corpus(lead_predictions(s, d), stem=False).select("rouge1", "rouge2"),
    "rouge_corpus": lambda s, d: rouge.rouge_corpus(lead_predictions(s, d)),
    "evaluate": lambda s, d: rounded(scoring.evaluate(lead_predictions(s, d))),
    "evaluate_table": evaluate_table,
    "build_vocab": lambda s, d: features.build_vocab(pairs(s, d), size=VOCAB),
    "encode_pairs": lambda s, d: joined_with_commas(encoded(s, d)),
    "label_mask": label_mask,
    "decode_ids": decode_ids,
    "truncation_report": lambda s, d: rounded(features.truncation_report(pairs(s, d), prefix=PREFIX)),
    "greedy_match_score": lambda s, d: rounded(matching.greedy_match_score(token_embeddings(s, d))),
    "greedy_match_corpus": lambda s, d: matching.greedy_match_corpus(token_embeddings(s, d)),
    "report_rows": lambda s, d: report.report_rows(pairs(s, d), sample=None),
    "eda_report": eda_report,
    "sample_exact_many_ids": sample_exact_many_ids,
    "predictor_throughput": predictor_throughput,
    "run_step_counts": run_step_counts,
    "rouge_interval": rouge_interval,
    "preprocess_stream": preprocess_stream,
    "split_leakage": lambda s, d: dedup.split_leakage(cleaning.clean_pairs(filled(s, d)), readers.SPLITS),
    "top_words_first_seen": lambda s, d: words.top_words(pairs(s, d), sample=None, ties="first"),
    "csv_quarantine": csv_quarantine,
    "read_text_folder": read_text_folder,
    "report_json": report_json,
    "summarize_single": summarize_single,
    "user_extensions": user_extensions,
    "length_stats_empty": lambda s, d: rounded(profile.length_stats(profile.lengths(pairs(s, d).where("id < 0")))),
}
