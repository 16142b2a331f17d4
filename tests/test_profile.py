import statistics

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from pairlab.operators import dedup, profile, words
from pairlab.plans import report


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, ["train", "test"][i % 2], "w " * (i * 7 % 13), "s " * (i % 5) if i % 4 else None) for i in range(1, 41)]
    return spark.createDataFrame(rows, "id long, split string, article string, highlights string")


def test_length_stats_match_pandas(table):
    got = {r.metric: r.asDict() for r in profile.length_stats(profile.lengths(table)).collect()}
    frame = table.toPandas()
    article, summary = frame.article.fillna(""), frame.highlights.fillna("")
    series = {"article_chars": article.str.len(), "summary_chars": summary.str.len(),
              "article_words": article.str.count(r"\S+"), "summary_words": summary.str.count(r"\S+")}
    assert set(got) == set(series)
    for name, s in series.items():
        want = {"mean": s.mean(), "median": s.median(), "std": s.std(ddof=0), "min": s.min(), "max": s.max(),
                "p90": s.quantile(0.9), "p95": s.quantile(0.95), "p99": s.quantile(0.99)}
        for key, value in want.items():
            assert got[name][key] == pytest.approx(value, abs=1e-9), (name, key)


def test_empty_table_gives_zeros(table):
    measured = profile.lengths(table.limit(0))
    rows = profile.length_stats(measured).collect()
    assert len(rows) == 4 and all(v == 0 for r in rows for k, v in r.asDict().items() if k != "metric")
    totals = profile.length_totals(measured).first()
    assert totals.num_rows == 0 and totals.compression_ratio_mean == 0.0


def test_compression_ratio_skips_empty_articles(spark):
    df = spark.createDataFrame([(1, "", "x"), (2, "a b c d", "x y"), (3, "a b", None)], "id long, article string, highlights string")
    row = profile.length_totals(profile.lengths(df)).first()
    assert row.compression_ratio_mean == pytest.approx(statistics.mean([0.5, 0.0]))
    assert (row.empty_articles, row.empty_summaries) == (1, 1)


def test_missing_values(spark, table):
    assert [tuple(r) for r in profile.missing_values(table).collect()] == [("highlights", 10)]
    none = table.na.fill("")
    assert [tuple(r) for r in profile.missing_values(none).collect()] == [("missing", 0)]
    floats = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, y string")
    assert {tuple(r) for r in profile.missing_values(floats).collect()} == {("x", 2), ("y", 1)}


def test_overview(table):
    row = profile.overview(table).first()
    assert (row.num_rows, row.num_columns) == (40, 4)
    assert [(c.name, c.dtype) for c in row.columns][0] == ("id", "bigint")


def test_duplicate_counts_match_pandas(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), ("a", None), (None, "x"), (None, None), (None, None), ("b", "y")]
    df = spark.createDataFrame(rows, "article string, highlights string")
    frame = pd.DataFrame(rows, columns=["article", "highlights"])
    row = dedup.duplicate_counts(df).first()
    assert row.duplicate_articles == frame.duplicated(["article"]).sum()
    assert row.duplicate_summaries == frame.duplicated(["highlights"]).sum()
    assert row.duplicate_pairs == frame.duplicated(["article", "highlights"]).sum()


def test_split_inspection(spark, table):
    got = {r.split: (r.num_rows, r.avg_article_words, r.avg_summary_words) for r in profile.split_inspection(profile.lengths(table)).collect()}
    frame = table.toPandas()
    frame["a"] = frame.article.fillna("nan").str.split().str.len()
    frame["s"] = frame.highlights.fillna("nan").str.split().str.len()
    for split, part in frame.groupby("split"):
        assert got[split] == (len(part), pytest.approx(part.a.mean()), pytest.approx(part.s.mean()))
    note = profile.split_inspection(profile.lengths(table.drop("split"))).first()
    assert "no split column" in note.note


def test_histogram_matches_numpy(table):
    got = {(r.side, r.bucket): r.n for r in profile.length_histogram(profile.lengths(table), 5).collect()}
    frame = table.toPandas()
    for side, column in (("article", "article"), ("summary", "highlights")):
        counts, _ = np.histogram(frame[column].fillna("nan").str.split().str.len(), bins=5)
        assert [got.get((side, b), 0) for b in range(1, 6)] == list(counts)


def test_histogram_of_constant_lengths(spark):
    df = spark.createDataFrame([(i, "a b c", "x") for i in range(9)], "id long, article string, highlights string")
    got = {(r.side, r.bucket): r.n for r in profile.length_histogram(profile.lengths(df)).collect()}
    counts, _ = np.histogram([3] * 9, bins=50)
    assert got == {("article", int(np.argmax(counts)) + 1): 9, ("summary", int(np.argmax(counts)) + 1): 9}


def test_token_counts_with_a_tokenizer(table):
    measured = profile.lengths(table, count_tokens=lambda c: F.char_length(c))
    row = profile.token_counts(measured, None).first()
    assert row.sample_size == 40
    assert row.article_tokens_mean == pytest.approx(table.toPandas().article.str.len().mean())


def test_top_words_and_ngrams(spark):
    df = spark.createDataFrame([(1, "The cat sat the cat ran"), (2, None), (3, "cat sat"), (4, "dog")], "id long, highlights string")
    top = [tuple(r) for r in words.top_words(df, 3).collect()]
    assert top == [("cat", 3), ("sat", 2), ("dog", 1)]
    assert ("nan", 1) in [tuple(r) for r in words.top_words(df).collect()]
    grams = [tuple(r) for r in words.top_ngrams(df, 2).collect()]
    assert grams == [("cat sat", 2), ("cat ran", 1)]


def test_top_k_needs_no_full_sort(table):
    assert "TakeOrderedAndProject" in plan_of(words.top_words(table, sample=None))


def test_report(table):
    rows = {(r.section, r.key): r.value for r in report.report_rows(table).collect()}
    assert rows[("totals", "num_rows")] == "40"
    assert rows[("splits", "train")] == "20"
    made = report.eda_report(table).first()
    assert made.num_total_rows == 40 and len(made.sample_pairs) == 5
    assert made.duplicates.duplicate_pairs == dedup.duplicate_counts(table).first().duplicate_pairs
