"""Scoring predictions, and the pipelines that read, summarise, score and write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pairlab.functions import text
from pairlab.operators import cleaning, generation, matching, profile, rouge, sampling
from pairlab.plans import report
from pairlab.plans.preprocess import POINTS, preprocess, step_row_counts, steps_from
from pairlab.sources import readers, sinks
from pairlab.sources.scratch import materialize, scratch_path


def evaluate(
    df: DataFrame,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    group_cols: Sequence[str] = (),
    stem: bool = True,
    separators: str = text.ROUGE_SEPARATORS,
    token_embeddings: DataFrame | None = None,
    throughput: sinks.Throughput | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Corpus ROUGE and prediction lengths from one pass, optionally with embedding matching and latency.

    With groups the embedding match of a group is the mean over its own rows, brought together by ``id_col``; a group without
    matched rows has null there.
    """
    scored = rouge.with_f1(df.select(*group_cols, pred_col, ref_col), stem, pred_col, ref_col, separators)
    count = text.word_count(text.null_to_text(pred_col))
    result = scored.groupBy(*group_cols).agg(
        *[rouge.corpus_score(s) for s in rouge.SCORES],
        F.avg(count).alias("mean_words"),
        F.min(count).alias("min_words"),
        F.max(count).alias("max_words"),
    )
    if throughput is not None:
        result = result.withColumn("avg_latency_sec_per_sample", F.lit(throughput.seconds_per_row))
    if token_embeddings is not None and group_cols:
        rows = df.select(F.col(id_col).alias("id"), *group_cols)
        matched = matching.greedy_match_score(token_embeddings)
        means = matching.corpus_means(matched.join(rows.withColumnsRenamed({c: f"_{c}" for c in group_cols}), "id"), [f"_{c}" for c in group_cols])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group_cols]
        result = result.join(means, same, "left").drop(*[f"_{c}" for c in group_cols])
    elif token_embeddings is not None:
        # Three single numbers of the whole corpus.
        match = matching.greedy_match_corpus(token_embeddings)
        numbers = match.select(F.struct(*match.columns).alias("m")).scalar()
        result = result.withColumn("_m", numbers).select("*", "_m.*").drop("_m")
    return result


def evaluate_table(
    df: DataFrame,
    predictor_factory: Callable[[], generation.Predictor],
    output_dir: str | None = None,
    preset: str | Mapping[str, int | None] = "full",
    max_samples: int | None = None,
    text_col: str = "article",
    summary_col: str = "highlights",
    id_col: str = "id",
    seed: int = 42,
    batch_size: int = 8,
    prefix: str = "",
    token_embeddings: Callable[[DataFrame], DataFrame] | None = None,
    latency: bool = True,
    **overrides,
) -> DataFrame:
    """Test subset, generate, score, write results and the comparison table.

    Predictions are written before they are scored, and so are the scores: nothing runs twice.  ``token_embeddings`` maps
    the stored predictions to a table for the embedding match; ``latency`` adds seconds per sample.  ``overrides`` reach
    the predictor, ``max_input_length`` among them.
    """
    subset = sampling.load_subset_split(df, "test", preset, seed, id_col)
    subset = sampling.head(subset, max_samples, seed, id_col)
    predicted = generation.summarize_table(subset, predictor_factory, text_col, batch_size, prefix, **overrides)
    compared = predicted.select(
        id_col,
        text_col,
        text.null_to_text(summary_col, "nan").alias("reference_summary"),
        "generated_summary",
    )
    path = scratch_path(df.sparkSession, "predictions")
    measured = sinks.timed_write(compared, path)
    stored = df.sparkSession.read.schema(compared.schema).parquet(path)
    embedded = None if token_embeddings is None else token_embeddings(stored)
    scored = evaluate(stored, throughput=measured if latency else None, token_embeddings=embedded)
    results = materialize(scored, "results")
    if output_dir is not None:
        sinks.write_report_json(results, f"{output_dir}/evaluation_results")
        table = generation.comparison(stored, text_col, "reference_summary", id_col=id_col)
        sinks.write_csv(table.drop(id_col), f"{output_dir}/predictions_vs_references")
    return results


def summarize_single(
    df: DataFrame,
    predictor_factory: Callable[[], generation.Predictor],
    text_col: str = "article",
    ref_col: str = "reference_summary",
    id_col: str = "id",
    **overrides,
) -> DataFrame:
    """Summary and, where a reference is given, its scores.  One text is a table of one row."""
    predicted = generation.summarize_table(df, predictor_factory, text_col, **overrides)
    given = predicted.withColumn(ref_col, F.nullif(F.col(ref_col), F.lit("")))
    scored = rouge.with_f1(given, ref_col=ref_col)
    return scored.withColumns({s: F.round(100 * F.col(s), 4) for s in rouge.SCORES})


def summarize_csv(
    spark: SparkSession,
    input_csv: str,
    predictor_factory: Callable[[], generation.Predictor],
    output_dir: str,
    text_col: str = "article",
    batch_size: int = 8,
    **overrides,
) -> DataFrame:
    """CSV in, the same rows with a summary out: as CSV in ``output_dir``, and as the stored table that is returned.

    One task reads a CSV file; its rows are dealt out before the predictor sees them.
    """
    rows = cleaning.require_columns(readers.read_csv(spark, input_csv), text_col)
    dealt = rows.repartition(spark.sparkContext.defaultParallelism)
    predicted = materialize(generation.summarize_table(dealt, predictor_factory, text_col, batch_size, **overrides), "summaries")
    sinks.write_csv(predicted, output_dir)
    return predicted


def summarize_folder(
    spark: SparkSession,
    input_dir: str,
    predictor_factory: Callable[[], generation.Predictor],
    output_dir: str,
    **overrides,
) -> DataFrame:
    """Text files in, (file_stem, generated_summary) out, in file order when read."""
    predicted = generation.summarize_table(
        readers.read_text_folder(spark, input_dir), predictor_factory, "text", **overrides
    )
    sinks.write_text_summaries(predicted, output_dir)
    return spark.read.parquet(output_dir).orderBy("file_stem")


def run_preprocessing(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    text_col: str = "article",
    summary_col: str = "highlights",
    **options,
) -> DataFrame:
    """CSV splits to a processed table and its row counts per split.

    The multi-line CSV is read once, into a scratch table with stored ids; everything after it runs on Parquet. The rows
    before and after each step are counted by the job that writes the table, and stored beside it
    (``read_step_counts``). A split of which no row is left has a count of 0.
    """
    raw = materialize(readers.with_id(readers.read_pairs_csv(spark, raw_dir, text_col, summary_col, require_any=False)), "raw")
    write_preprocessed(raw, processed_dir, text_col, summary_col, **options)
    counts = profile.split_sizes(raw.limit(0))
    for split, _ in readers.split_files(spark, raw_dir):
        rows = readers.read_split(spark, processed_dir, split) if raw.take(1) else raw.limit(0)
        counts = counts.unionAll(rows.agg(F.lit(split).alias("split"), F.count("*").alias("num_rows")))
    stats = counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "num_rows")))).alias("num_rows"))
    sinks.write_report_json(stats, f"{processed_dir}_stats")
    return counts


def write_preprocessed(
    df: DataFrame, processed_dir: str, text_col: str = "article", summary_col: str = "highlights", **options
) -> DataFrame:
    """Preprocess and write by split; (step, rows_before, rows_after) of that run, stored under ``<processed_dir>_steps``.

    The numbers come out of the writing job itself. Where one of its stages had to run again they are counted anew.
    """
    seen = {point: Observation() for point in POINTS}
    cleaned = preprocess(df, text_col, summary_col, seen=seen, **options)
    found = sinks.counted_write(cleaned, seen, lambda rows: sinks.write_processed(rows, processed_dir))
    if found is None:
        again = dict(options)
        plain = again.pop("use_drop_na", True) and again.pop("use_drop_duplicates", True)
        within = again.pop("within", None) or (("split",) if "split" in df.columns else ())
        again.pop("id_col", None)
        if not plain:
            raise RuntimeError("a stage ran again and the counts of the steps are lost; the table is written")
        steps = step_row_counts(df, text_col, summary_col, within, **again)
    else:
        steps = steps_from(df.sparkSession.createDataFrame([tuple(found[p] for p in POINTS)], ", ".join(f"{p} long" for p in POINTS)))
    steps.write.mode("overwrite").parquet(f"{processed_dir}_steps")
    return read_step_counts(df.sparkSession, processed_dir)


def read_step_counts(spark: SparkSession, processed_dir: str) -> DataFrame:
    return spark.read.parquet(f"{processed_dir}_steps")


def run_profile(spark: SparkSession, raw_dir: str, output_dir: str, text_col: str = "article",
                summary_col: str = "highlights", **options) -> DataFrame:
    """CSV splits in, all analyses as one JSON report out."""
    raw = materialize(readers.with_id(readers.read_pairs_csv(spark, raw_dir, text_col, summary_col)), "raw")
    made = materialize(report.eda_report(raw, text_col, summary_col, **options), "report")
    sinks.write_report_json(made, output_dir)
    return made
