"""ROUGE-1/2/L/Lsum of a predicted against a reference text.

Both texts sit in one row, so no score needs a shuffle: n-gram overlap is built from array functions inside the
JVM, stems and longest common subsequences come from Arrow UDFs.  The only exchange is that of the final mean.

The usual scorer reports the median of bootstrap means; the mean it estimates is reported here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions import text
from pairlab.functions.arrays import multiset_overlap, ngrams
from pairlab.functions.lcs import lcs, union_lcs
from pairlab.functions.stem import stem_lines, stem_tokens, stem_word

SCORES = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def token_lines(value: Column | str, separators: str = text.ROUGE_SEPARATORS) -> Column:
    """Tokens per line; empty lines are left out."""
    lines = F.array_remove(F.split(text.as_column(value), "\n"), "")
    return F.transform(lines, lambda line: text.rouge_tokens(line, separators))


def stem_map(df: DataFrame, text_col: str) -> DataFrame:
    """(token, stem) of every distinct token, stemmed once each."""
    tokens = df.select(F.explode(text.rouge_tokens(text_col)).alias("token")).distinct()
    return tokens.select("token", stem_word(F.col("token")).alias("stem"))


def _precision_recall_f1(overlap: Column, predicted: Column, referenced: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    p = F.coalesce(F.try_divide(overlap, predicted), zero)
    r = F.coalesce(F.try_divide(overlap, referenced), zero)
    return {"p": p, "r": r, "f1": F.coalesce(F.try_divide(2 * p * r, p + r), zero)}


def _f1(overlap: Column, predicted: Column, referenced: Column) -> Column:
    return _precision_recall_f1(overlap, predicted, referenced)["f1"]


def _named(scores: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in scores.items()]


def _token_pairs(df: DataFrame, pred_col: str, ref_col: str, id_col: str, separators: str) -> DataFrame:
    """Rows with a reference, as token arrays."""
    return df.where(F.col(pred_col).isNotNull() & F.col(ref_col).isNotNull()).select(
        id_col,
        text.rouge_tokens(pred_col, separators).alias("pred"),
        text.rouge_tokens(ref_col, separators).alias("ref"),
    )


def rouge_n(
    df: DataFrame,
    n: int,
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    id_col: str = "id",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    """(id, p, r, f1) of the clipped n-gram overlap; 0 where a side has no n-gram."""
    tokens = _token_pairs(df, pred_col, ref_col, id_col, separators)
    if stem:
        tokens = tokens.select(id_col, stem_tokens(F.col("pred")).alias("pred"), stem_tokens(F.col("ref")).alias("ref"))
    grams = tokens.select(
        id_col, ngrams(F.col("pred"), n, n).alias("pred"), ngrams(F.col("ref"), n, n).alias("ref")
    )
    counted = grams.select(
        id_col,
        multiset_overlap(F.col("pred"), F.col("ref")).alias("overlap"),
        F.size("pred").alias("n_pred"),
        F.size("ref").alias("n_ref"),
    )
    return counted.select(id_col, *_named(_precision_recall_f1(F.col("overlap"), F.col("n_pred"), F.col("n_ref"))))


def rouge_l(
    df: DataFrame,
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    id_col: str = "id",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    """(id, p, r, f1) of the longest common token subsequence."""
    pred, ref = F.col("pred"), F.col("ref")
    # Stems stay inside: a UDF over two others would hold a second Python worker per task.
    common = lcs(pred, ref, stem)
    counted = _token_pairs(df, pred_col, ref_col, id_col, separators).select(
        id_col, common.alias("common"), F.size(pred).alias("n_pred"), F.size(ref).alias("n_ref")
    )
    return counted.select(id_col, *_named(_precision_recall_f1(F.col("common"), F.col("n_pred"), F.col("n_ref"))))


def rouge_lsum(
    df: DataFrame,
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    id_col: str = "id",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    """(id, p, r, f1) of the summary-level LCS over the lines of both texts."""
    lines = df.where(F.col(pred_col).isNotNull() & F.col(ref_col).isNotNull()).select(
        id_col, token_lines(pred_col, separators).alias("pred"), token_lines(ref_col, separators).alias("ref")
    )
    pred, ref = F.col("pred"), F.col("ref")
    hits = union_lcs(ref, pred, stem)
    counted = lines.select(
        id_col,
        hits.alias("hits"),
        F.size(F.flatten(pred)).alias("n_pred"),
        F.size(F.flatten(ref)).alias("n_ref"),
    )
    return counted.select(id_col, *_named(_precision_recall_f1(F.col("hits"), F.col("n_pred"), F.col("n_ref"))))


def with_f1(
    df: DataFrame,
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    """The table with ``rouge1 .. rougeLsum`` F1 columns (0..1), null where the reference is null.

    All Python work of the four scores is in one Arrow pass: tokens go out once, stems and LCS lengths come
    back.  Lines are sent only for rows with several lines, the others have Lsum = L.
    """
    referenced = F.col(ref_col).isNotNull()
    lines = df.withColumns(
        {
            "_pl": F.when(referenced, token_lines(text.null_to_text(pred_col), separators)),
            "_rl": F.when(referenced, token_lines(ref_col, separators)),
        }
    )
    flat = lines.withColumns({"_p": F.flatten("_pl"), "_r": F.flatten("_rl")})
    p, r = F.col("_p"), F.col("_r")
    many = (F.size("_pl") > 1) | (F.size("_rl") > 1)
    pl, rl = F.when(many, F.col("_pl")), F.when(many, F.col("_rl"))
    if stem:
        p, r, pl, rl = stem_tokens(p), stem_tokens(r), stem_lines(pl), stem_lines(rl)
    measured = flat.withColumns(
        {"_ps": p, "_rs": r, "_l": lcs(p, r), "_s": union_lcs(rl, pl)}
    ).drop("_pl", "_rl", "_p", "_r")
    ps, rs = F.col("_ps"), F.col("_rs")
    grams = measured.withColumns({"_p2": ngrams(ps, 2, 2), "_r2": ngrams(rs, 2, 2)})
    # Overlaps are columns of their own: each is used several times below and must be worked out once.
    counted = grams.withColumns(
        {
            "_o1": multiset_overlap(ps, rs),
            "_o2": multiset_overlap(F.col("_p2"), F.col("_r2")),
            "_np": F.size(ps), "_nr": F.size(rs), "_np2": F.size("_p2"), "_nr2": F.size("_r2"),
        }
    ).drop("_p2", "_r2", "_rs")
    n_pred, n_ref = F.col("_np"), F.col("_nr")
    scored = {
        "rouge1": _f1(F.col("_o1"), n_pred, n_ref),
        "rouge2": _f1(F.col("_o2"), F.col("_np2"), F.col("_nr2")),
        "rougeL": _f1(F.col("_l"), n_pred, n_ref),
        "rougeLsum": _f1(F.coalesce(F.col("_s"), F.col("_l")), n_pred, n_ref),
    }
    present = ps.isNotNull()
    return counted.withColumns({name: F.when(present, value) for name, value in scored.items()}).drop(
        "_ps", "_l", "_s", "_o1", "_o2", "_np", "_nr", "_np2", "_nr2"
    )


def rouge_rows(
    df: DataFrame,
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    id_col: str = "id",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    """Single-pair scores as percentages with four decimals; null without a reference, also an empty one.

    In a corpus mean an empty reference counts as 0 instead.
    """
    given = df.select(id_col, pred_col, F.nullif(F.col(ref_col), F.lit("")).alias(ref_col))
    scored = with_f1(given, stem, pred_col, ref_col, separators)
    return scored.select(id_col, *[F.round(100 * F.col(s), 4).alias(s) for s in SCORES])


def corpus_score(name: str) -> Column:
    """Corpus score of one F1 column: mean x 100, four decimals."""
    return F.round(100 * F.avg(name), 4).alias(name)


def rouge_corpus(
    df: DataFrame,
    group_cols: Sequence[str] = (),
    stem: bool = True,
    pred_col: str = "generated_summary",
    ref_col: str = "reference_summary",
    separators: str = text.ROUGE_SEPARATORS,
) -> DataFrame:
    scored = with_f1(df.select(*group_cols, pred_col, ref_col), stem, pred_col, ref_col, separators)
    return scored.groupBy(*group_cols).agg(*[corpus_score(s) for s in SCORES])


# Cumulative probabilities of 0, 1, 2 ... events of a Poisson law of mean 1.
POISSON = (
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.999916758850712, 0.9999897508033253, 0.999998874797402, 0.9999998885745217,
)


def resample_weight(resample: Column, id_col: str) -> Column:
    """How often a row stands in a resample: the Poisson quantile of a digest of both, the same on every cluster."""
    digest = F.md5(F.concat_ws(":", resample.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    uniform = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32
    return sum((F.when(uniform >= p, 1).otherwise(0) for p in POISSON), F.lit(0))


def rouge_interval(
    scored: DataFrame, scores: Sequence[str] = SCORES, resamples: int = 100, coverage: float = 0.95, id_col: str = "id"
) -> DataFrame:
    """(score, low, mid, high): the interval that holds ``coverage`` of the corpus scores of ``resamples`` resamples, and
    their median, in percent.

    ``scored`` has F1 columns per row (``with_f1``).  Each row goes into each resample as often as a Poisson law of mean 1
    says, so all resamples are one aggregate that every task does for its own rows; no row is drawn, moved or gathered.
    Rows without a score play no part; no scored rows give null bounds.
    """
    numbers = F.explode(F.sequence(F.lit(1), F.lit(resamples))).alias("resample")
    drawn = scored.select(F.col(id_col).alias("_id"), *scores, numbers).withColumn("w", resample_weight(F.col("resample"), "_id"))
    means = drawn.where("w > 0").groupBy("resample").agg(
        *[F.try_divide(F.sum(F.col("w") * F.col(s)), F.sum(F.when(F.col(s).isNotNull(), F.col("w")))).alias(s) for s in scores]
    )
    bounds = [F.lit(x) for x in ((1 - coverage) / 2, 0.5, (1 + coverage) / 2)]
    # One row per resample.
    at = means.agg(*[F.percentile(s, F.array(*bounds)).alias(s) for s in scores])
    rows = [
        F.struct(F.lit(s).alias("score"), *[F.round(100 * F.get(s, F.lit(k)), 4).alias(n) for k, n in enumerate(("low", "mid", "high"))])
        for s in scores
    ]
    return at.select(F.inline(F.array(*rows)))
