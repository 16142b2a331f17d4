"""Times the headline queries and prints one JSON line.

Each query runs twice into a sink that takes every row and keeps none; the faster run counts, so start-up and
code generation are not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairlab.queries import QUERIES  # noqa: E402
from pairlab.session import builder, ship  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

HEADLINE = [
    "clean_text", "drop_duplicates", "preprocess_rows", "preprocess_counts", "step_row_counts", "duplicate_counts",
    "length_stats", "length_histogram", "split_inspection", "token_counts", "sample_exact", "load_subset_dev",
    "top_words", "top_ngrams", "summarize_lead", "summarize_extractive", "stem_map", "rouge1_rows", "rouge2_rows",
    "rouge_l_rows", "rouge_lsum_rows", "rouge_corpus", "evaluate", "build_vocab", "encode_pairs", "decode_ids",
    "greedy_match_score", "report_rows",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        builder("pairlab-bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    chosen = sys.argv[1:] or HEADLINE
    times = {
        name: round(min(seconds(lambda: QUERIES[name](spark, SF_DIR)) for _ in range(RUNS)), 3) for name in chosen
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
