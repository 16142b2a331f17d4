"""Exact top-k by inner product: a kNN join over Voronoi cells."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pairlab.llm.arrow import map_batches, stored

PIVOTS, MOST_PIVOTS = 16, 1024
DATA_BLOCK = 8192
QUERY_BLOCK = 1024


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, zeros after the end of shorter ones."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    if len(column):
        rows = np.repeat(np.arange(len(column)), lengths)
        places = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[rows, places] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lifted(vectors: np.ndarray, top: float, query: bool = False) -> np.ndarray:
    """One coordinate more, so that all data lie on one sphere: then the nearest point has the largest product."""
    x = vectors.astype(float)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(top - (x * x).sum(1), 0))
    return np.concatenate([x, extra[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v): components floor(scale * x); rows without an id, and vectors null or holding null or non-finite components,
    go; of rows that share an id the least vector stays. A component beyond a long is the nearest long."""
    x = F.col(vector_column)
    whole = x.isNotNull() & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    made = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return (
        df.where(F.col(id_column).isNotNull() & F.coalesce(whole, F.lit(False)))
        .select(F.col(id_column).cast("long").alias("id"), made.alias("v"))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while no sum can pass 2^53, in longs below 2^63, in wide integers beyond."""
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * x.shape[1]
    if most < 2**53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    if most < 2**62:
        return q @ x.T
    return q.astype(object) @ x.T.astype(object)


def _spread(vectors: np.ndarray, n: int) -> np.ndarray:
    """n of the vectors far from each other: the next one is always the farthest from those chosen."""
    chosen, far = [0], np.full(len(vectors), np.inf)
    while len(chosen) < min(n, len(vectors)):
        far = np.minimum(far, _distances(vectors, vectors[chosen[-1:]])[:, 0])
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return vectors[chosen]


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query, positions of its k best, their scores) of each query; ``ids`` ascend, so equal scores come by id."""
    for at in range(0, len(q), 64):
        for own, line in zip(q_ids[at : at + 64], _products(q[at : at + 64], x), strict=True):
            other = np.flatnonzero(ids != own)
            line = line[other]
            good = np.arange(len(line))
            if len(line) > k:
                edge = np.sort(line)[len(line) - k] if line.dtype == object else np.partition(line, len(line) - k)[len(line) - k]
                good = np.flatnonzero(line >= edge)
            good = good[np.argsort(-line[good], kind="stable")][:k]
            yield own, other[good], line[good]


def top_products(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
                 every: int = 100, scale: int = 1024, pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every``, the ``k`` others of largest
    integer inner product, ties to the smaller id.

    Vectors are assigned to the nearest pivot; pivots are spread far apart over a bounded sample, as many as the square root
    of the table's blocks of DATA_BLOCK, PIVOTS at least and MOST_PIVOTS at most, if not given. Each query first looks into
    the cell nearest to it, which bounds how far its k best can be. Per group of queries and cell, the least and largest
    distance to the cell's pivot that any of the group's queries can still need are a summary of fixed size (pivots x
    pivots); a vector is copied to those groups alone whose interval holds its own distance. Where the vectors have no
    clusters, as with independent random ones in many dimensions, distances are all alike and every interval holds nearly
    all of them: then nothing can be left out by bounds on distances, and each vector goes to each group once.
    Groups are cut into blocks of queries and of data, so no task holds more than one of each.

    For the vectors that take part see ``integer_vectors``; a shorter vector counts as padded with zeros. With fewer
    than k others all of them are returned. A score beyond a long raises. An empty table gives an empty result; other
    columns are not read.
    """
    spark = df.sparkSession
    empty = "query_id long, rank int, vec_id long, score long"
    vectors = stored(integer_vectors(df, id_column, vector_column, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, top, total = vectors.agg(F.max(F.size("v")), F.max(square), F.count("*")).first()
    if width is None:
        return spark.createDataFrame([], empty)
    blocks = max(1, -(-total // DATA_BLOCK))
    wanted = pivots or min(MOST_PIVOTS, max(PIVOTS, math.isqrt(4 * blocks)))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(16 * wanted).toArrow()
    centres = _spread(_lifted(_matrix(sample["v"].combine_chunks(), width), top), wanted)
    slack = 1e-6 * (math.sqrt(top) + 1)  # floats only choose what is compared; scores are integers

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column("v"), width)
        ids = batch.column("id").to_numpy()
        data, query = _distances(_lifted(x, top), centres), _distances(_lifted(x, top, True), centres)
        cell, group = data.argmin(1), query.argmin(1)
        asks = pa.array(np.where(ids % every == 0, group, -1), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cell, pa.int32()), pa.array(data[np.arange(len(x)), cell]), asks],
            names=["id", "v", "cell", "far", "asks"],
        )

    cells = stored(map_batches(vectors, assign, "id long, v array<long>, cell int, far double, asks int"), "cells")
    asking = cells.where("asks >= 0")
    asked = {r["asks"]: max(1, -(-r["n"] // QUERY_BLOCK)) for r in asking.groupBy("asks").agg(F.count("*").alias("n")).collect()}
    if not asked:
        return spark.createDataFrame([], empty)
    parts_of = F.create_map(*[F.lit(x) for i, n in asked.items() for x in (i, n)])
    keys, schema = ["group", "part", "block"], "query_id long, vec_id long, score long"
    queries = asking.select(
        F.col("asks").alias("group"),
        F.pmod(F.xxhash64("id"), parts_of[F.col("asks")]).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "id",
        "v",
    )

    def best(key, asking: pa.Table, given: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not asking.num_rows or not given.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        given = given.sort_by("id").combine_chunks()
        ids = given["id"].to_numpy()
        found = _best(
            asking["id"].to_numpy(), _matrix(asking["v"].combine_chunks(), width), ids, _matrix(given["v"].combine_chunks(), width), k
        )
        out = [(np.full(len(at), own), ids[at], score) for own, at, score in found]
        return pa.table([pa.array(np.concatenate(c).tolist(), pa.int64()) for c in zip(*out, strict=True)], names=names)

    def met(data: DataFrame) -> DataFrame:
        """The best of each query among the data that its group has been given."""
        return queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(best, schema)

    block = F.pmod("id", F.lit(blocks)).cast("int").alias("block")
    own = cells.where(F.col("cell").isin(list(asked))).select(
        F.col("cell").alias("group"), F.explode(F.sequence(F.lit(0), parts_of[F.col("cell")] - 1)).alias("part"), block, "id", "v"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # The k-th best score of a query in its nearest cell; the query looks everywhere where that cell has fewer.
    edge = met(own).withColumn("n", place).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("edge"))
    bounded = asking.select("id", "v", "asks").join(edge, "id", "left")

    def intervals(batches):
        low = {i: np.full(len(centres), np.inf) for i in asked}
        high = {i: np.full(len(centres), -np.inf) for i in asked}
        for batch in batches:
            x = _lifted(_matrix(batch.column("v"), width), top, True)
            away = _distances(x, centres)
            # Nearer than this: |q - x|^2 = |q|^2 + top - 2 q.x for all x on the sphere.
            score = batch.column("edge").to_numpy(zero_copy_only=False).astype(float)
            reach = np.sqrt(np.maximum((x * x).sum(1) + top - 2 * score, 0)) + slack
            reach = np.where(np.isnan(score), np.inf, reach)[:, None]
            for i in np.unique(batch.column("asks").to_numpy()).tolist():
                rows = np.flatnonzero(batch.column("asks").to_numpy() == i)
                low[i] = np.minimum(low[i], (away[rows] - reach[rows]).min(0))
                high[i] = np.maximum(high[i], (away[rows] + reach[rows]).max(0))
        for i in asked:
            cell = np.flatnonzero(low[i] <= high[i])
            if len(cell):
                columns = (np.full(len(cell), i), cell, low[i][cell], high[i][cell])
                kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["asks", "cell", "low", "high"])

    limits = bounded.mapInArrow(intervals, "asks int, cell int, low double, high double").groupBy("asks", "cell").agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    )
    low, high = np.full((2, len(centres), len(centres)), np.inf)
    high *= -1
    for r in limits.toLocalIterator():  # at most pivots x pivots
        low[r["asks"], r["cell"]], high[r["asks"], r["cell"]] = r["low"], r["high"]

    def copy(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        cell, far = batch.column("cell").to_numpy(), batch.column("far").to_numpy()
        block = batch.column("id").to_numpy() % blocks
        hits = [(i, q, np.flatnonzero((low[i, cell] <= far) & (far <= high[i, cell]))) for i, n in asked.items() for q in range(n)]
        rows = np.concatenate([hit for _, _, hit in hits])
        if not len(rows):
            return None
        which, part = (np.repeat([h[c] for h in hits], [len(h[2]) for h in hits]) for c in (0, 1))
        take = pa.array(rows)
        columns = [pa.array(c, pa.int32()) for c in (which, part, block[rows])]
        return pa.RecordBatch.from_arrays([*columns, batch.column("id").take(take), batch.column("v").take(take)], names=[*keys, "id", "v"])

    data = map_batches(cells.select("id", "v", "cell", "far"), copy, "group int, part int, block int, id long, v array<long>")
    return met(data).withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
