"""Consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairlab.llm.arrow import map_batches

VIRTUAL_NODES = 64
BINS_PER_ARC = 64
RING = 1 << 32


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise."""
    return sorted(
        (int(hashlib.md5(f"shard-{s}-{v}".encode()).hexdigest()[:8], 16), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )


def place_of(key: Column) -> Column:
    """Place on the ring of a key: the first 32 bits of its MD5; null keys share one place."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def flows(nodes: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): which keys of each arc go where.

    Capacities differ by one at most and add up to the number of keys. First each arc fills its own shard, in ring
    order; then what is over goes on clockwise, node by node, into the free room it meets.
    """
    total = sum(counts.values())
    free = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out, over = [], []

    def give(arc: int, first: int, end: int, shard: int) -> int:
        n = min(end - first, free[shard])
        if n:
            out.append((arc, first, first + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return first + n

    for arc, (_, shard) in enumerate(nodes):
        n = counts.get(arc, 0)
        first = give(arc, 0, n, shard)
        if first < n:
            over.append((arc, first, n))
    for arc, first, n in over:
        step = 0
        while first < n:
            step += 1
            first = give(arc, first, n, nodes[(arc + step) % len(nodes)][1])
    return out


def assign_shards(df: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text",
                  virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row, row counts of shards at most one apart.

    A key's place is a hash of its id; the next virtual node clockwise owns it. Keys are counted per arc (a fixed
    number of arcs, whatever the table's size), the loads are levelled on those counts, and each key finds its shard by
    its rank within its arc, so no text and no row leaves its partition for it. Within an arc keys are ranked by place,
    id and text digest; equal rows take neighbouring ranks. Null and repeated ids share a place and spread like any
    other keys of their arc: they too overflow. A null text has size 1 and digest 0. An empty table gives an empty
    table. Other columns are not read.
    """
    nodes = ring(shards, virtual_nodes)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        place_of(F.col(id_column)).alias("place"),
    )
    places = np.array([p for p, _ in nodes])

    def own_arc(batch: pa.RecordBatch) -> pa.RecordBatch:
        arc = np.searchsorted(places, batch.column("place").to_numpy()) % len(places)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(arc, pa.int32())], names=[*batch.schema.names, "arc"])

    kind = rows.schema["id"].dataType.simpleString()
    rows = map_batches(rows, own_arc, f"id {kind}, size long, crc long, place long, arc int").withColumn(
        "bin", F.pmod(F.xxhash64("id", "crc", "size"), F.lit(BINS_PER_ARC))
    )
    bins = rows.groupBy("arc", "bin").agg(F.count("*").alias("n"))
    counted = [tuple(r) for r in bins.orderBy("arc", "bin").collect()]  # at most nodes x BINS_PER_ARC rows
    counts: dict[int, int] = {}
    starts = []
    for arc, part, n in counted:
        starts.append((arc, part, counts.get(arc, 0)))
        counts[arc] = counts.get(arc, 0) + n
    spark = df.sparkSession
    first = spark.createDataFrame(starts, "arc int, bin long, before long")
    moves: dict[int, list] = {}
    for arc, start, end, shard, slot in flows(nodes, counts, shards):
        moves.setdefault(arc, []).append((start, end, shard, slot))
    plan = spark.createDataFrame(list(moves.items()), "arc int, moves array<struct<start:long,end:long,shard:int,slot:long>>")
    table = F.broadcast(first.join(plan, "arc"))  # bounded by the number of nodes and bins
    rank = F.row_number().over(Window.partitionBy("arc", "bin").orderBy("place", "id", "crc", "size")) - 1
    ranked = rows.withColumn("rank", rank).join(table, ["arc", "bin"]).withColumn("rank", F.col("rank") + F.col("before"))
    move = F.filter("moves", lambda m: (m["start"] <= F.col("rank")) & (F.col("rank") < m["end"]))[0]
    return ranked.withColumn("move", move).select(
        F.col("id").alias(id_column),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("move.shard").alias("shard"),
        (F.col("move.slot") + F.col("rank") - F.col("move.start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

