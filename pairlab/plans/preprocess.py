"""The preprocessing pipeline over all splits as one plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F

from pairlab.operators import cleaning, dedup

# Points of the pipeline at which its rows can be counted while it runs.
POINTS = ("read", "filled", "unique", "fitting")


def preprocess(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    id_col: str = "id",
    within: tuple[str, ...] | None = None,
    use_drop_na: bool = True,
    use_drop_duplicates: bool = True,
    lowercase: bool = False,
    seen: Mapping[str, Observation] | None = None,
    **bounds: int,
) -> DataFrame:
    """Null removal, exact dedup on the raw texts, cleaning, length bounds.

    Duplicates are decided on raw text, so pairs that become equal only by cleaning all stay.  ``within`` is the split column
    where there is one.  ``seen`` may hold an observation for each of POINTS: it counts the rows that pass there in the
    job that uses the result.
    """
    cleaning.require_columns(df, text_col, summary_col)
    within = (("split",) if "split" in df.columns else ()) if within is None else within

    def counted(rows: DataFrame, point: str) -> DataFrame:
        return rows.observe(seen[point], F.count("*").alias("rows")) if seen else rows

    def filled(rows: DataFrame) -> DataFrame:
        return cleaning.drop_na(rows, text_col, summary_col) if use_drop_na else rows

    unique = counted(filled(counted(df, "read")), "filled")
    if use_drop_duplicates:
        repeated = dedup.repeated_pairs(filled(df), text_col, summary_col, within)
        # Every row passes the first branch, which counts; the second takes the repeated ones alone.
        alone, _ = dedup.split_by_repetition(unique, repeated, text_col, summary_col, within)
        _, others = dedup.split_by_repetition(filled(df), repeated, text_col, summary_col, within)
        unique = alone.unionByName(dedup.first_of_each(others, id_col, within)).select(*[f"`{c}`" for c in df.columns])
    cleaned = cleaning.clean_pairs(counted(unique, "unique"), text_col, summary_col, lowercase)
    return counted(cleaning.length_filter(cleaned, text_col, summary_col, **bounds), "fitting")


def steps_from(totals: DataFrame) -> DataFrame:
    """(step, rows_before, rows_after) of one row with the numbers at POINTS."""
    steps = [
        ("drop_na", "read", "filled"),
        ("drop_duplicates", "filled", "unique"),
        ("text_cleaning", "unique", "unique"),
        ("length_filter", "unique", "fitting"),
    ]
    rows = [
        F.struct(F.lit(step).alias("step"), F.col(before).alias("rows_before"), F.col(after).alias("rows_after"))
        for step, before, after in steps
    ]
    return totals.select(F.inline(F.array(*rows)))


def step_row_counts(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    within: tuple[str, ...] = ("split",),
    lowercase: bool = False,
    **bounds: int,
) -> DataFrame:
    """(step, rows_before, rows_after) of the pipeline from one shuffle of digests, no row of text kept.

    Rows of one group of equal pairs share every verdict, so per group the number of rows, the digest and one
    flag are enough.
    """
    marked = df.select(
        *within,
        (F.col(text_col).isNotNull() & F.col(summary_col).isNotNull()).alias("filled"),
        dedup.pair_digest(text_col, summary_col).alias("pair_key"),
        cleaning.within_length(
            cleaning.text.clean_text(text_col, lowercase), cleaning.text.clean_text(summary_col, lowercase), **bounds
        ).alias("fits"),
    )
    # Rows with a null are all one group per split: their digest no longer matters.
    key = F.when(F.col("filled"), F.col("pair_key"))
    groups = marked.groupBy(*within, "filled", key.alias("pair_key")).agg(
        F.count("*").alias("n"), F.bool_and("fits").alias("fits")
    )
    zero = F.lit(0).cast("bigint")
    totals = groups.agg(
        F.coalesce(F.sum("n"), zero).alias("read"),
        F.coalesce(F.sum(F.when(F.col("filled"), F.col("n"))), zero).alias("filled"),
        F.count_if(F.col("filled")).alias("unique"),
        F.count_if(F.col("filled") & F.col("fits")).alias("fitting"),
    )
    return steps_from(totals)
