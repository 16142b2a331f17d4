"""Profile of a pair table: sizes, nulls, length distributions, per-split statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairlab.functions import text
from pairlab.operators.cleaning import require_columns
from pairlab.operators.sampling import sample_exact

LENGTH_METRICS = ("article_chars", "summary_chars", "article_words", "summary_words")
PERCENTILES = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def _zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns with their types, and bytes of text (stands in for in-memory size)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    text_bytes = sum((F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in strings), F.lit(0))
    described = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(kind).alias("dtype")) for name, kind in df.dtypes]
    )
    return df.agg(
        F.count("*").alias("num_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("num_columns"),
        text_bytes.cast("bigint").alias("text_bytes"),
    ).withColumn("columns", described)


def missing_values(df: DataFrame) -> DataFrame:
    """Nulls per column, only columns that have some; one row ``missing, 0`` if none does."""

    def is_missing(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        floating = isinstance(field.dataType, (T.FloatType, T.DoubleType))
        return column.isNull() | F.isnan(column) if floating else column.isNull()

    counted = df.agg(*[F.count_if(is_missing(f)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    per_column = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("n_missing")) for i, name in enumerate(df.columns)]
    )
    found = F.filter(per_column, lambda x: x["n_missing"] > 0)
    none = F.array(F.struct(F.lit("missing").alias("column_name"), F.lit(0).cast("bigint").alias("n_missing")))
    return counted.select(F.inline(F.when(F.size(found) > 0, found).otherwise(none)))


def lengths(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    count_tokens: Callable[[Column], Column] = text.word_count,
) -> DataFrame:
    """Characters, words and tokens of both texts; the texts themselves are left behind.

    All statistics below run on this table of numbers: write it once (``materialize``) when several are wanted.
    Characters and words take a null for an empty text, tokens take it for the text ``nan``.  ``count_tokens``
    maps a text column to a count; the default splits at whitespace, a tokenizer's Arrow UDF fits in its place.
    """
    require_columns(df, text_col, summary_col)
    kept = [c for c in ("id", "split") if c in df.columns]
    sides = {"article": text_col, "summary": summary_col}
    measured, tokens = [], []
    for side, column in sides.items():
        filled = text.null_to_text(column)
        measured += [text.char_count(filled).alias(f"{side}_chars"), text.word_count(filled).alias(f"{side}_words")]
        if count_tokens is text.word_count:
            # Counted already; only a null differs, it is one word.
            measured.append(F.col(column).isNull().alias(f"{side}_null"))
            counted = F.when(F.col(f"{side}_null"), F.lit(1).cast("bigint")).otherwise(F.col(f"{side}_words"))
        else:
            measured.append(count_tokens(text.null_to_text(column, "nan")).cast("bigint").alias(f"{side}_count"))
            counted = F.col(f"{side}_count")
        tokens.append(counted.alias(f"{side}_tokens"))
    return df.select(*kept, *measured).select(*kept, *LENGTH_METRICS, *tokens)


def _zero_rows(df: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """One (metric, null, 0) per metric, so that an empty table still gives a row for each."""
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(None).cast("bigint").alias("value"), F.lit(0).cast("bigint").alias("n"))
        for m in metrics
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def value_counts(measured: DataFrame, metrics: tuple[str, ...] = LENGTH_METRICS) -> DataFrame:
    """(metric, value, n): how many rows have each length.  Reduced map-side, so the shuffle carries distinct
    lengths and the exact percentiles below never see the rows."""
    long_form = measured.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    )
    return long_form.groupBy("metric", "value").agg(F.count("*").alias("n"))


def length_stats(measured: DataFrame, metrics: tuple[str, ...] = LENGTH_METRICS) -> DataFrame:
    """Mean, median, population deviation, extremes and exact p90/p95/p99 per metric; zeros on an empty table."""
    counts = value_counts(measured, metrics).unionByName(_zero_rows(measured, metrics))
    exact = lambda c: c.cast("decimal(38,0)")
    rows, total, squares = (
        F.sum("n"),
        F.sum(exact(F.col("value") * F.col("n"))),
        F.sum(exact(F.col("value")) * exact(F.col("value") * F.col("n"))),
    )
    per_metric = counts.groupBy("metric").agg(
        rows.cast("double").alias("rows"),
        total.cast("double").alias("total"),
        squares.cast("double").alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile("value", F.array(*[F.lit(p) for p in PERCENTILES.values()]), F.col("n")).alias("p"),
    )
    mean = F.try_divide("total", "rows")
    variance = F.greatest(F.try_divide("squares", "rows") - mean * mean, F.lit(0.0))
    at = {name: F.get("p", F.lit(i)) for i, name in enumerate(PERCENTILES)}
    return per_metric.select(
        "metric",
        _zero_if_null(mean).alias("mean"),
        _zero_if_null(at["median"]).alias("median"),
        _zero_if_null(F.sqrt(variance)).alias("std"),
        _zero_if_null(F.col("min")).alias("min"),
        _zero_if_null(F.col("max")).alias("max"),
        *[_zero_if_null(at[name]).alias(name) for name in ("p90", "p95", "p99")],
    )


def length_totals(measured: DataFrame) -> DataFrame:
    """Rows, mean words, mean compression ratio over rows with an article, empty texts: one aggregate."""
    ratio = F.avg(F.when(F.col("article_words") > 0, F.col("summary_words") / F.col("article_words")))
    return measured.agg(
        F.count("*").alias("num_rows"),
        _zero_if_null(F.avg("article_words")).alias("article_words_mean"),
        _zero_if_null(F.avg("summary_words")).alias("summary_words_mean"),
        _zero_if_null(ratio).alias("compression_ratio_mean"),
        F.count_if(F.col("article_words") == 0).alias("empty_articles"),
        F.count_if(F.col("summary_words") == 0).alias("empty_summaries"),
    )


def compression_ratio(measured: DataFrame) -> DataFrame:
    return length_totals(measured).select("compression_ratio_mean")


def empty_counts(measured: DataFrame) -> DataFrame:
    return length_totals(measured).select("empty_articles", "empty_summaries")


def token_counts(measured: DataFrame, sample_size: int | None = None, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Mean and p95 tokens of both texts of the table, or of a sample of given size."""
    sides = ("article_tokens", "summary_tokens")
    sampled = sample_exact(measured, sample_size, seed, id_col)
    counts = value_counts(sampled, sides).unionByName(_zero_rows(measured, sides))
    per_side = counts.groupBy("metric").agg(
        F.sum("n").alias("rows"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("mean"),
        F.percentile("value", F.lit(0.95), F.col("n")).alias("p95"),
    )

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("metric") == side, F.col(column)))

    return per_side.agg(
        of(sides[0], "rows").alias("sample_size"),
        *[of(side, column).alias(f"{side}_{column}") for side in sides for column in ("mean", "p95")],
    )


def row_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("num_rows"))


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count("*").alias("num_rows"))


def split_inspection(measured: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and mean words per split; a table without a split column gives one row holding a note."""
    if split_col not in measured.columns:
        note = "the table has no split column"
        return measured.sparkSession.range(1).select(F.lit(note).alias("note"))
    return measured.groupBy(split_col).agg(
        F.count("*").alias("num_rows"),
        F.avg("article_tokens").alias("avg_article_words"),
        F.avg("summary_tokens").alias("avg_summary_words"),
    )


def length_histogram(measured: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width word-count histogram per side, buckets 1..bins, empty buckets left out.

    Runs on the distinct counts, so the rows are read once.  When all counts are equal they fall into the
    middle bucket, as with bounds half a word to each side.
    """
    sides = measured.select(F.col("article_tokens").alias("article"), F.col("summary_tokens").alias("summary"))
    counts = value_counts(sides, ("article", "summary"))
    bounds = counts.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    span = F.col("hi") - F.col("lo")
    scaled = F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, span)).cast("bigint") + 1
    bucket = F.when(span == 0, F.lit(bins // 2 + 1)).otherwise(F.least(scaled, F.lit(bins)))
    # Two rows, one per side.
    return (
        counts.join(F.broadcast(bounds), "metric")
        .groupBy(F.col("metric").alias("side"), bucket.cast("bigint").alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )


def scatter_sample(measured: DataFrame, n: int | None = None, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Points (article words, summary words) of the table, or of a sample of given size."""
    return sample_exact(measured, n, seed, id_col).select(
        id_col, F.col("article_tokens").alias("article_words"), F.col("summary_tokens").alias("summary_words")
    )
