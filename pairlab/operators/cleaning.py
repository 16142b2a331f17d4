"""Row-local preprocessing steps: checks, null removal, cleaning, length bounds.

All are ``DataFrame -> DataFrame`` and fit ``df.transform``.  None shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions import text

# The default character bounds.
MIN_ARTICLE_CHARS, MAX_ARTICLE_CHARS = 200, 20_000
MIN_SUMMARY_CHARS, MAX_SUMMARY_CHARS = 20, 2_000


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
    return df


def tag_split(df: DataFrame, split: str) -> DataFrame:
    return df.withColumn("split", F.lit(split))


def drop_na(df: DataFrame, text_col: str = "article", summary_col: str = "highlights") -> DataFrame:
    return df.na.drop(subset=[text_col, summary_col])


def clean_pairs(
    df: DataFrame, text_col: str = "article", summary_col: str = "highlights", lowercase: bool = False
) -> DataFrame:
    """Clean both text columns in place; a null text is cleaned as the text ``nan``.

    The cleaned texts come out of a one-row generator, not a plain projection: a later filter on them cannot be
    pushed below it, so the patterns run once per text and not again for the filter.
    """
    cleaned = F.struct(
        *[text.clean_text(text.null_to_text(c, "nan"), lowercase).alias(c) for c in (text_col, summary_col)]
    )
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (text_col, summary_col)]
    return df.select(*kept, F.inline(F.array(cleaned))).select(*[F.col(f"`{c}`") for c in df.columns])


def within_length(
    text_value: Column | str,
    summary_value: Column | str,
    min_article_chars: int = MIN_ARTICLE_CHARS,
    max_article_chars: int = MAX_ARTICLE_CHARS,
    min_summary_chars: int = MIN_SUMMARY_CHARS,
    max_summary_chars: int = MAX_SUMMARY_CHARS,
) -> Column:
    """Inclusive character bounds on both texts."""
    return F.char_length(text.null_to_text(text_value, "nan")).between(min_article_chars, max_article_chars) & (
        F.char_length(text.null_to_text(summary_value, "nan")).between(min_summary_chars, max_summary_chars)
    )


def length_filter(
    df: DataFrame, text_col: str = "article", summary_col: str = "highlights", **bounds: int
) -> DataFrame:
    return df.where(within_length(text_col, summary_col, **bounds))


def non_empty_articles(df: DataFrame, text_col: str = "article") -> DataFrame:
    return df.where(text.word_count(text.null_to_text(text_col)) > 0)


def union_splits(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column one split lacks is null there."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
