"""Exact duplicates of (article, summary) pairs, found by digests; rows whose pair stands alone are never shuffled for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions.text import joint_digest, text_digest
from pairlab.sources.scratch import materialize

_KEY = "_pairlab_pair"


def pair_digest(text_col: str, summary_col: str) -> Column:
    return joint_digest(text_digest(text_col), text_digest(summary_col))


def repeated_pairs(
    df: DataFrame, text_col: str = "article", summary_col: str = "highlights", within: Sequence[str] = ("split",)
) -> DataFrame:
    """(split, digest) of the pairs with more than one row, written to scratch: their true size is known when rows are held
    against them.

    The shuffle carries (split, digest), counted map-side: a pair with a third of all rows is one row per map task.
    """
    keys = df.groupBy(*within, pair_digest(text_col, summary_col).alias(_KEY)).agg(F.count("*").alias("n"))
    return materialize(keys.where("n > 1").drop("n"), "repeated-pairs")


def split_by_repetition(
    df: DataFrame,
    repeated: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    within: Sequence[str] = ("split",),
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose pair stands alone, and the others."""
    keyed = df.withColumn(_KEY, pair_digest(text_col, summary_col))
    same = [F.col(f"k.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in (*within, _KEY)]
    joined = [keyed.alias("k").join(repeated.alias("r"), same, how) for how in ("left_anti", "left_semi")]
    return joined[0].drop(_KEY), joined[1]


def first_of_each(keyed: DataFrame, id_col: str = "id", within: Sequence[str] = ("split",)) -> DataFrame:
    """One row per pair of rows that have a digest: that of the smallest id, null ids last, equal ids in the order of a hash
    of the row.  Rows that agree in all of it are equal, and any of them stands for the others."""
    names = [c for c in keyed.columns if c != _KEY]
    columns = [F.col(f"`{c}`") for c in names]
    by_id = [F.col(id_col).isNull(), F.col(id_col)] if id_col in names else []
    first = F.min_by(F.struct(*columns), F.struct(*by_id, F.xxhash64(*columns))).alias("first")
    return keyed.groupBy(*within, _KEY).agg(first).select("first.*")


def drop_duplicates(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    id_col: str = "id",
    within: Sequence[str] = ("split",),
) -> DataFrame:
    """Keep one row of each identical pair, per split; null equals null.

    Ids may repeat or be null: the row kept is chosen by its content.  Rows whose pair stands alone pass a filter where they
    are; of the others each map task hands on one row per pair.
    """
    alone, others = split_by_repetition(df, repeated_pairs(df, text_col, summary_col, within), text_col, summary_col, within)
    return alone.unionByName(first_of_each(others, id_col, within)).select(*[f"`{c}`" for c in df.columns])


def duplicate_counts(df: DataFrame, text_col: str = "article", summary_col: str = "highlights") -> DataFrame:
    """Rows beyond the first, for articles, summaries and pairs, from one shuffle of digests."""
    digests = df.select(text_digest(text_col).alias("a"), text_digest(summary_col).alias("s"))
    keys = {"article": F.col("a"), "summary": F.col("s"), "pair": joint_digest("a", "s")}
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()])
    keyed = digests.select(F.inline(kinds))
    extra = keyed.groupBy("kind", "key").agg((F.count("*") - 1).alias("extra"))

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("extra"))), F.lit(0).cast("bigint"))

    return extra.agg(
        total("article").alias("duplicate_articles"),
        total("summary").alias("duplicate_summaries"),
        total("pair").alias("duplicate_pairs"),
    )


def split_leakage(
    df: DataFrame,
    splits: Sequence[str],
    text_col: str = "article",
    summary_col: str = "highlights",
    split_col: str = "split",
) -> DataFrame:
    """(split_a, split_b, n_pairs) for every two splits: distinct pairs that both have.

    Each pair's splits are one bit mask, put together map-side; what is left is one count per mask.  At most 62 splits.
    """
    if len(splits) > 62:
        raise ValueError("a mask has room for 62 splits")
    bit = F.coalesce(*[F.when(F.col(split_col) == s, F.lit(1 << k).cast("bigint")) for k, s in enumerate(splits)])
    masks = df.groupBy(pair_digest(text_col, summary_col).alias(_KEY)).agg(F.bit_or(bit).alias("mask"))
    counts = masks.groupBy("mask").agg(F.count("*").alias("n"))

    def shared(a: int, b: int) -> Column:
        both = F.lit(1 << a | 1 << b).cast("bigint")
        return F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(both) == both, F.col("n"))), F.lit(0).cast("bigint"))

    numbers = [(a, b) for b in range(len(splits)) for a in range(b)]
    totals = counts.agg(*[shared(a, b).alias(f"n{a}_{b}") for a, b in numbers])
    rows = [
        F.struct(F.lit(splits[a]).alias("split_a"), F.lit(splits[b]).alias("split_b"), F.col(f"n{a}_{b}").alias("n_pairs"))
        for a, b in numbers
    ]
    return totals.select(F.inline(F.array(*rows)))
