"""The profile of a raw pair table as one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairlab.operators import dedup, profile, sampling, words
from pairlab.sources.scratch import materialize


def _rows(df: DataFrame, section: str, key: Column, value: Column) -> DataFrame:
    return df.select(F.lit(section).alias("section"), key.alias("key"), value.alias("value"))


def _number(value: Column) -> Column:
    return F.format_string("%.6f", value.cast("double"))


def _columns_as_rows(df: DataFrame, section: str, names: list[str], floating: bool = False) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(n).alias("key"), (_number(F.col(n)) if floating else F.col(n).cast("string")).alias("value")) for n in names]
    )
    return df.select(F.lit(section).alias("section"), F.inline(pairs))


def report_rows(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    top: int = 15,
    sample: int | None = None,
    token_sample: int | None = None,
) -> DataFrame:
    """(section, key, value) digest: totals, duplicates, mean lengths, compression, p95 tokens, rows per split,
    first words.  Numbers with a fraction have six decimals."""
    measured = materialize(profile.lengths(df, text_col, summary_col), "lengths")
    totals = profile.length_totals(measured)
    duplicates = dedup.duplicate_counts(df, text_col, summary_col)
    tokens = profile.token_counts(measured, token_sample)
    top_words = words.top_words(df, top, sample, text_col=summary_col)
    pieces = [
        _columns_as_rows(totals, "totals", ["num_rows"]),
        _columns_as_rows(duplicates, "duplicates", ["duplicate_articles", "duplicate_summaries", "duplicate_pairs"]),
        _columns_as_rows(
            totals, "lengths", ["article_words_mean", "summary_words_mean", "compression_ratio_mean"], floating=True
        ),
        _columns_as_rows(tokens, "tokens", ["article_tokens_p95", "summary_tokens_p95"], floating=True),
        _rows(top_words, "top_words", F.col("term"), F.col("n").cast("string")),
    ]
    if "split" in df.columns:
        pieces.append(_rows(profile.split_sizes(measured), "splits", F.col("split"), F.col("num_rows").cast("string")))
    report, *others = pieces
    for piece in others:
        report = report.unionByName(piece)
    return report


def eda_report(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    top_n: int = 30,
    ngram_range: tuple[int, int] = (2, 3),
    sample: int | None = None,
    token_sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """All analyses as one row with one nested column each, ready for ``write_report_json``.

    Lengths and word counts are computed once and written to scratch as a table of numbers.  What goes into the
    row is bounded: a few statistics per metric, column and split, the top lists, five pairs.
    """
    spark = df.sparkSession
    measured = materialize(profile.lengths(df, text_col, summary_col), "lengths")

    def one(piece: DataFrame) -> Column:
        return piece.select(F.struct(*piece.columns).alias("v")).scalar()

    def many(piece: DataFrame, order: Column | None = None) -> Column:
        rows = F.collect_list(F.struct(*piece.columns))
        return piece.agg((F.sort_array(rows) if order is None else F.array_sort(rows)).alias("v")).scalar()

    def ranked(piece: DataFrame) -> Column:
        by_count = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "term", "n")))
        return piece.agg(F.transform(by_count, lambda x: F.struct(x["term"].alias("term"), x["n"].alias("n"))).alias("v")).scalar()

    return spark.range(1).select(
        profile.row_counts(measured).scalar().alias("num_total_rows"),
        one(profile.overview(df)).alias("overview"),
        many(profile.missing_values(df)).alias("missing_values"),
        one(dedup.duplicate_counts(df, text_col, summary_col)).alias("duplicates"),
        many(profile.length_stats(measured)).alias("length_distribution"),
        one(profile.length_totals(measured)).alias("length_totals"),
        one(profile.token_counts(measured, token_sample, seed)).alias("token_counts"),
        ranked(words.top_words(df, top_n, sample, seed, summary_col)).alias("top_words"),
        ranked(words.top_ngrams(df, top_n, ngram_range, sample, seed, summary_col)).alias("top_ngrams"),
        many(profile.split_inspection(measured)).alias("split_inspection"),
        many(sampling.sample_pairs(df, 5, seed, text_col, summary_col)).alias("sample_pairs"),
    )




def shared_scan(df: DataFrame, analyses: Mapping[str, Sequence[Column]]) -> DataFrame:
    """(section, key, value) of any number of analyses in one pass over ``df``.

    An analysis is a list of named aggregates; the names are its keys.  All of them are columns of one aggregate, so a user's
    analysis costs no further read of the texts.  Numbers with a fraction have six decimals.
    """
    flat = [(section, column) for section, columns in analyses.items() for column in columns]
    totals = df.agg(*[column.alias(f"v{k}") for k, (_, column) in enumerate(flat)])
    keys = [df.agg(column).columns[0] for _, column in flat]
    kinds = dict(totals.dtypes)
    values = [
        _number(F.col(f"v{k}")) if kinds[f"v{k}"] in ("double", "float") else F.col(f"v{k}").cast("string") for k in range(len(flat))
    ]
    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), value.alias("value"))
        for (section, _), key, value in zip(flat, keys, values)
    ]
    return totals.select(F.inline(F.array(*rows)))


def flattened(report: DataFrame) -> DataFrame:
    """A report of ``eda_report`` as (section, key, value) rows; numbers with a fraction have six decimals."""

    def text(value: Column, kind: T.DataType) -> Column:
        return _number(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value.cast("string")

    def rows(section: str, prefix: Column, value: Column, kind: T.StructType, skipped: str | None = None) -> list[Column]:
        return [
            F.struct(
                F.lit(section).alias("section"), F.concat(prefix, F.lit(f.name)).alias("key"),
                text(value[f.name], f.dataType).alias("value"),
            )
            for f in kind.fields if f.name != skipped and not isinstance(f.dataType, T.ArrayType)
        ]

    def entries(section: str, column: Column, kind: T.StructType) -> Column:
        """Of an array of entries, each named by its first field."""
        named = kind.fields[0].name
        return F.flatten(
            F.transform(column, lambda x: F.array(*rows(section, F.concat(x[named].cast("string"), F.lit(".")), x, kind, named)))
        )

    parts = []
    for field in report.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.StructType):
            parts.append(F.array(*rows(field.name, F.lit(""), column, kind)))
        elif isinstance(kind, T.ArrayType):
            parts.append(entries(field.name, column, kind.elementType))
        else:
            one = F.struct(F.lit(field.name).alias("section"), F.lit("").alias("key"), text(column, kind).alias("value"))
            parts.append(F.array(one))
    return report.select(F.inline(F.concat(*parts)))
