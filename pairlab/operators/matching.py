"""Greedy embedding matching (T. Zhang et al., "BERTScore", 2020) over a token-embedding table.

Input: one row per token ``(id, side, pos, vec)``, side ``pred`` or ``ref``, positions unique per id and side but
otherwise free: they may be sparse or negative.  The embeddings are the caller's.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions.stem import flat_values

# Tokens per block, on average.  A cell holds about this many vectors of each side, whatever the size of its pair.
BLOCK = 1024


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    values, offsets = flat_values(vectors)
    flat = np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 1)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _best(own: Column, other: Column) -> Column:
    """For every vector of ``own`` its highest cosine to a vector of ``other``; null if there is none."""

    @F.arrow_udf("array<double>")
    def best(a: pa.Array, b: pa.Array) -> pa.Array:
        (av, ao), (bv, bo) = flat_values(a), flat_values(b)
        au, bu = _unit_rows(av), _unit_rows(bv)
        out = np.full(len(au), np.nan)
        starts_a, starts_b = ao.to_pylist(), bo.to_pylist()
        for i in range(len(a)):
            x, y = au[starts_a[i]:starts_a[i + 1]], bu[starts_b[i]:starts_b[i + 1]]
            if len(x) and len(y):
                out[starts_a[i]:starts_a[i + 1]] = (x @ y.T).max(axis=1)
        return pa.ListArray.from_arrays(ao, pa.array(out, from_pandas=True))

    return best(own, other)


def greedy_match_score(
    tokens: DataFrame,
    id_col: str = "id",
    side_col: str = "side",
    pos_col: str = "pos",
    vec_col: str = "vec",
    block: int = BLOCK,
) -> DataFrame:
    """(id, precision, recall, f1): per token the best cosine to the other side, averaged per side.

    Token pairs are never rows.  The tokens of a side are dealt by a hash of their position into as many blocks as
    their number asks for; a cell is one block of each side and is worked as one matrix product that returns maxima.  A
    pair of ordinary size is one cell; a huge one becomes many cells on many tasks, and its rows are copied once per
    block of the other side.  Cost depends on the number of tokens alone, not on their positions.
    """
    is_pred = F.col("side") == "pred"
    rows = tokens.select(
        F.col(id_col).alias("id"),
        F.col(side_col).alias("side"),
        F.col(pos_col).alias("pos"),
        F.col(vec_col).alias("vec"),
    )
    # One row per pair; counted map-side, and joined on the pair: a very large one is split at run time.
    extent = rows.groupBy("id").agg(
        F.greatest(F.ceil(F.count_if(is_pred) / block), F.lit(1)).cast("int").alias("pred_blocks"),
        F.greatest(F.ceil(F.count_if(~is_pred) / block), F.lit(1)).cast("int").alias("ref_blocks"),
    ).withColumns({"last_pred": F.col("pred_blocks") - 1, "last_ref": F.col("ref_blocks") - 1})
    placed = rows.join(extent, "id").withColumn(
        "block", F.pmod(F.xxhash64("pos"), F.when(is_pred, F.col("pred_blocks")).otherwise(F.col("ref_blocks"))).cast("int")
    )
    own = F.array(F.col("block"))
    cells = placed.withColumn(
        "pred_block", F.explode(F.when(is_pred, own).otherwise(F.sequence(F.lit(0), F.col("last_pred"))))
    ).withColumn("ref_block", F.explode(F.when(is_pred, F.sequence(F.lit(0), F.col("last_ref"))).otherwise(own)))

    def side(of_pred: bool, column: str) -> Column:
        return F.collect_list(F.when(is_pred if of_pred else ~is_pred, F.struct("pos", "vec"))).alias(column)

    gathered = cells.groupBy("id", "pred_block", "ref_block").agg(side(True, "pred"), side(False, "ref"))
    pred_vecs, ref_vecs = F.col("pred.vec"), F.col("ref.vec")
    matched = gathered.select(
        "id",
        F.col("pred.pos").alias("pred_pos"),
        F.col("ref.pos").alias("ref_pos"),
        _best(pred_vecs, ref_vecs).alias("pred_best"),
        _best(ref_vecs, pred_vecs).alias("ref_best"),
    )
    maxima = matched.select(
        "id",
        F.inline(
            F.concat(
                F.zip_with("pred_pos", "pred_best", lambda p, b: F.struct(F.lit("pred").alias("side"), p.alias("pos"), b.alias("best"))),
                F.zip_with("ref_pos", "ref_best", lambda p, b: F.struct(F.lit("ref").alias("side"), p.alias("pos"), b.alias("best"))),
            )
        ),
    )
    per_token = maxima.groupBy("id", "side", "pos").agg(F.max("best").alias("best"))
    zero = F.lit(0.0)
    per_pair = per_token.groupBy("id").agg(
        F.coalesce(F.avg(F.when(F.col("side") == "pred", F.col("best"))), zero).alias("precision"),
        F.coalesce(F.avg(F.when(F.col("side") == "ref", F.col("best"))), zero).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return per_pair.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))


def corpus_means(scored: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*group_cols).agg(*[F.round(F.avg(c), 4).alias(f"match_{c}") for c in ("precision", "recall", "f1")])


def greedy_match_corpus(tokens: DataFrame, **columns) -> DataFrame:
    """Means over all pairs, four decimals."""
    return corpus_means(greedy_match_score(tokens, **columns))
