"""Frequent words and n-grams of the summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions import text
from pairlab.functions.arrays import ngrams
from pairlab.operators.sampling import sample_exact, top_k


def counted_words(value: Column) -> Column:
    """Lower-case words of letters only, stop words removed."""
    return F.filter(text.words(F.lower(value)), text.is_counted_word)


def word_counts(df: DataFrame, text_col: str = "highlights", id_col: str | None = None) -> DataFrame:
    """(term, n) over the whole table.  Counts are combined map-side, so a frequent word costs one row per task.  With
    ``id_col`` also where a term stands first: (id, position), the least of all its places."""
    words = text.words(F.lower(text.null_to_text(text_col, "nan")))
    if id_col is None:
        exploded = df.select(F.explode(words).alias("term"))
        return exploded.where(text.is_counted_word("term")).groupBy("term").agg(F.count("*").alias("n"))
    exploded = df.select(F.col(id_col).alias("id"), F.posexplode(words).alias("at", "term"))
    first = F.min(F.struct("id", "at")).alias("first")
    return exploded.where(text.is_counted_word("term")).groupBy("term").agg(F.count("*").alias("n"), first)


def ngram_counts(df: DataFrame, ngram_range: tuple[int, int] = (2, 3), text_col: str = "highlights") -> DataFrame:
    """(term, n) of n-grams over the words left after filtering; all sizes in one table."""
    grams = ngrams(counted_words(text.null_to_text(text_col, "nan")), *ngram_range)
    return df.select(F.explode(grams).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def top_words(
    df: DataFrame, top_n: int = 30, sample: int | None = None, seed: int = 42, text_col: str = "highlights",
    id_col: str = "id", ties: str = "term",
) -> DataFrame:
    """The most frequent words of the table, or of a sample of given size.  Equal counts come in the order of the terms, or
    with ``ties="first"`` in that of their first places, rows in the order of their ids."""
    if ties not in ("term", "first"):
        raise ValueError(f"ties go by term or by first place, not by {ties!r}")
    rows = sample_exact(df, sample, seed, id_col)
    if ties == "term":
        return top_k(word_counts(rows, text_col), top_n)
    return top_k(word_counts(rows, text_col, id_col), top_n, tie_col="first").select("term", "n")


def top_ngrams(
    df: DataFrame, top_n: int = 30, ngram_range: tuple[int, int] = (2, 3), sample: int | None = None, seed: int = 42,
    text_col: str = "highlights", id_col: str = "id",
) -> DataFrame:
    return top_k(ngram_counts(sample_exact(df, sample, seed, id_col), ngram_range, text_col), top_n)
