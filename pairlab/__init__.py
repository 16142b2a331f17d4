"""Text-pair corpus preparation and summary scoring on Spark.

Every operator takes and returns a Spark DataFrame; column names are parameters.
"""

from pairlab.operators.cleaning import clean_pairs, drop_na, length_filter, require_columns, union_splits
from pairlab.operators.dedup import drop_duplicates, duplicate_counts
from pairlab.operators.features import build_vocab, decode_ids, encode_pairs, truncation_report
from pairlab.operators.generation import (
    extractive_predictor,
    generation_length_stats,
    summarize_extractive,
    summarize_lead,
    summarize_table,
)
from pairlab.operators.matching import greedy_match_corpus, greedy_match_score
from pairlab.operators.profile import (
    length_histogram,
    length_stats,
    length_totals,
    lengths,
    missing_values,
    overview,
    split_inspection,
    split_sizes,
    token_counts,
)
from pairlab.operators.rouge import rouge_corpus, rouge_l, rouge_lsum, rouge_n, rouge_rows, stem_map
from pairlab.operators.sampling import load_subset, load_subset_split, sample_exact, sample_pairs, top_k
from pairlab.operators.words import top_ngrams, top_words
from pairlab.plans.evaluate import evaluate, evaluate_table, run_preprocessing, summarize_csv, summarize_folder
from pairlab.plans.preprocess import preprocess, step_row_counts
from pairlab.plans.report import eda_report, report_rows
from pairlab.session import builder, ship

__all__ = [name for name in dir() if not name.startswith("_")]
