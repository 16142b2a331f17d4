"""Exact, reproducible samples and ranked heads.

A row's place in the sample is the order of ``md5(seed:id)``, rows of one id in the order of a hash of the row. The n
smallest are found by selection: rows are counted per leading digits of the digest, then per whole digest within the digits
at which the running count reaches n. Both counts read ids alone; the cut they give, one digest per group, is a constant of
the scan that takes the rows. Only where an id repeats at the cut itself are its rows looked at, in the same way by the
hash of the row. Ids need not be unique or filled, and no row set of size n is ever sorted, joined or collected.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pairlab.functions import text

# Rows taken per split by each preset; None takes all.
PRESETS = {
    "dev": {"train": 500, "validation": 100, "test": 100},
    "medium": {"train": 20_000, "validation": 2_000, "test": 2_000},
    "full": {"train": None, "validation": None, "test": None},
}

# Leading digits counted first: at most 65,536 counts per group, whatever the size of the table.
DIGITS = 4


@dataclass(frozen=True)
class Cut:
    """The rank at which a group's sample ends: ``wanted`` of the ``tied`` rows of this rank belong to it."""

    rank: str
    wanted: int
    tied: int


def sample_rank(seed: int, id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def cuts(ranked: DataFrame, limits: Mapping[str, int]) -> dict[str, Cut]:
    """Where the samples of the groups of (_grp, _rank) rows end; a group with fewer rows than its limit has no cut. One row
    per group of the caller's limits reaches the driver, twice."""

    def reached(counts: DataFrame, by: str, wanted: Column) -> DataFrame:
        upto = F.sum("n").over(W.partitionBy("_grp").orderBy(by))
        placed = counts.withColumns({"wanted": wanted, "upto": upto}).where("upto >= wanted")
        return placed.groupBy("_grp").agg(F.min_by(F.struct(by, "n", (F.col("wanted") - F.col("upto") + F.col("n")).alias("left")), by).alias("at"))

    def of_group(values: Mapping[str, object]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("_grp"))

    digits = F.substring("_rank", 1, DIGITS)
    counts = ranked.where(F.col("_grp").isin(list(limits))).groupBy("_grp", digits.alias("digits")).agg(F.count("*").alias("n"))
    first = {r["_grp"]: r["at"] for r in reached(counts, "digits", of_group(limits).cast("long")).toLocalIterator()}
    if not first:
        return {}
    edges, left = ({g: at[field] for g, at in first.items()} for field in ("digits", "left"))
    inside = ranked.where(F.col("_grp").isin(list(edges))).where(digits == of_group(edges))
    whole = reached(inside.groupBy("_grp", "_rank").agg(F.count("*").alias("n")), "_rank", of_group(left))
    return {r["_grp"]: Cut(r["at"]["_rank"], r["at"]["left"], r["at"]["n"]) for r in whole.toLocalIterator()}


def _below(limits: Mapping[str, int], found: Mapping[str, Cut]) -> Column:
    """Whether a row is in the sample by its rank alone; groups without a cut are taken whole."""
    chosen = F.lit(False)
    for group in limits:
        cut = found.get(group)
        if cut is None:
            passed = F.lit(True)
        else:
            passed = F.col("_rank") <= cut.rank if cut.wanted == cut.tied else F.col("_rank") < cut.rank
        chosen = F.when(F.col("_grp") == group, passed).otherwise(chosen)
    return chosen


def sample_rows(
    df: DataFrame, limits: Mapping[str, int], seed: int = 42, id_col: str = "id", by: str | None = None
) -> DataFrame:
    """The sampled rows.  ``limits`` gives the rows per value of ``by`` (or of ``""`` without groups).  The cuts are worked
    out at once, from the ids; the rows are read when the result is."""
    names = [f"`{c}`" for c in df.columns]
    ranked = df.select("*", (F.col(by) if by else F.lit("")).alias("_grp"), sample_rank(seed, id_col).alias("_rank"))
    found = cuts(ranked.select("_grp", "_rank"), limits)
    taken = ranked.where(_below(limits, found)).select(names)
    for group, cut in found.items():
        if 0 < cut.wanted < cut.tied:
            tied = ranked.where((F.col("_grp") == group) & (F.col("_rank") == cut.rank)).select(names)
            taken = taken.unionAll(_of_one_id(tied, cut.wanted))
    return taken


def _of_one_id(rows: DataFrame, n: int) -> DataFrame:
    """n rows of one id, in the order of a hash of the row.  Of rows that are equal throughout, a count decides: they are
    reduced to one row and written out as often as they belong to the sample."""
    names = [f"`{c}`" for c in rows.columns]
    digest = F.lpad(F.hex(F.xxhash64(*[F.col(c) for c in names])), 16, "0")
    ranked = rows.select("*", F.lit("").alias("_grp"), digest.alias("_rank"))
    found = cuts(ranked.select("_grp", "_rank"), {"": n})
    taken = ranked.where(_below({"": n}, found)).select(names)
    cut = found.get("")
    if cut is None or not 0 < cut.wanted < cut.tied:
        return taken
    alike = ranked.where(F.col("_rank") == cut.rank).groupBy(*names).agg(F.count("*").alias("_n"))
    # All but always one row; several only if their hashes collide.
    before = F.sum("_n").over(W.orderBy(*names).rowsBetween(W.unboundedPreceding, -1))
    wanted = F.least(F.col("_n"), F.lit(cut.wanted) - F.coalesce(before, F.lit(0)))
    again = alike.withColumn("_n", wanted).where("_n > 0").select(*names, F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return taken.unionAll(again.select(names))


def sample_exact(df: DataFrame, n: int | None, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly n rows without replacement; all rows when n is None or not below the row count."""
    return df if n is None else sample_rows(df, {"": n}, seed, id_col)


def _sizes(preset: str | Mapping[str, int | None]) -> Mapping[str, int | None]:
    return PRESETS[preset] if isinstance(preset, str) else preset


def load_subset(
    df: DataFrame, preset: str | Mapping[str, int | None] = "full", seed: int = 42, id_col: str = "id",
    split_col: str = "split",
) -> DataFrame:
    """The splits cut to the sizes of a preset or to given ones (0: none, None: all) in one pass.  Unknown preset:
    KeyError."""
    sizes = _sizes(preset)
    limits = {split: n for split, n in sizes.items() if n is not None}
    known = df.where(F.col(split_col).isin(list(sizes)))
    if not limits:
        return known
    whole = known.where(~F.col(split_col).isin(list(limits)))
    cut = sample_rows(known, limits, seed, id_col, by=split_col)
    return cut if len(limits) == len(sizes) else whole.unionAll(cut)


def load_subset_split(
    df: DataFrame, split: str, preset: str | Mapping[str, int | None] = "full", seed: int = 42, id_col: str = "id",
    split_col: str = "split",
) -> DataFrame:
    sizes = _sizes(preset)
    if split not in sizes:
        raise ValueError(f"no split named {split!r}; there are {', '.join(sizes)}")
    return sample_exact(df.where(F.col(split_col) == split), sizes[split], seed, id_col)


def sample_pairs(
    df: DataFrame,
    n: int = 5,
    seed: int = 42,
    text_col: str = "article",
    summary_col: str = "highlights",
    id_col: str = "id",
) -> DataFrame:
    """A few pairs to look at, the article cut at 500 characters."""
    return sample_exact(df, n, seed, id_col).select(
        id_col,
        text.preview(text.null_to_text(text_col, "nan"), 500).alias("article"),
        text.null_to_text(summary_col, "nan").alias("summary"),
    )


def head(df: DataFrame, max_samples: int | None, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Cap the rows to score; None or 0 means no cap.  The head is that of the sample order."""
    return sample_exact(df, max_samples or None, seed, id_col)


def top_k(
    counts: DataFrame, k: int, term_col: str = "term", count_col: str = "n", tie_col: str | None = None
) -> DataFrame:
    """The k most frequent; ties in term order, or in that of ``tie_col``.

    Terms per count are counted first, which gives the count at the cut.  Terms above it pass a filter, and only
    those at the cut itself are ranked, so no task ever sorts more than about k terms and the ties.
    """
    order = [F.desc(count_col), *([F.asc(tie_col)] if tie_col else []), F.asc(term_col)]
    sizes = counts.groupBy(F.col(count_col).alias("_c")).agg(F.count("*").alias("_terms"))
    upto = sizes.withColumn("_upto", F.sum("_terms").over(W.orderBy(F.desc("_c"))))
    cut = upto.where(F.col("_upto") >= k).agg(F.max("_c").alias("c")).scalar()
    return counts.where(cut.isNull() | (F.col(count_col) >= cut)).orderBy(*order).limit(k)
