"""Arrow batches in and out of the operators' Python parts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.sources.scratch import materialize

BATCH_BYTES = 8 << 20
FILTER_LEAST, FILTER_BITS, FILTER_SHARE = 1 << 24, 1 << 28, 16
BLOCK_BITS = 1 << 15  # of Spark's bitmap aggregate


def whole_text(name: str) -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def give_back() -> None:
    """Return freed memory to the system at a task's end: workers are used again by other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
                slice_bytes: int = BATCH_BYTES, before: Callable[[], None] | None = None) -> DataFrame:
    """One batch of about ``slice_bytes`` in, one batch (or none) out. ``before`` runs at a task's start, to claim the worker
    for what the work puts aside there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if before is not None:
            before()
        for batch in batches:
            for part in parts(batch, slice_bytes):
                made = work(part) if part.num_rows else None
                if made is not None and made.num_rows:
                    yield made
        give_back()

    return df.mapInArrow(run, schema)


def parts(batch: pa.RecordBatch, slice_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``slice_bytes``, so that very long texts don't add up in memory."""
    if batch.nbytes <= slice_bytes or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from parts(batch.slice(0, half), slice_bytes)
    yield from parts(batch.slice(half), slice_bytes)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes one after another, n + 1 offsets) of an array of texts without nulls."""
    wide = texts.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    data = wide.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def batch_of(schema: dict[str, pa.DataType], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read again: a lost executor costs nothing before it."""
    return materialize(df, name)


def repeated(df: DataFrame, key: str, order: list[str], place: str | None = None) -> DataFrame:
    """Rows whose long ``key`` another row has too, sorted by key and ``order`` within each partition, numbered from 0
    within their run in column ``place`` if asked. Rows pass in a stream; a run of any length needs no memory."""
    names = df.columns
    at = names.index(key)
    out = df.select("*", *([F.lit(0).cast("long").alias(place)] if place else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, before, count = None, None, 0

        def emit(rows: pa.RecordBatch, last: bool) -> pa.RecordBatch | None:
            """All rows but the last one, which waits for its successor."""
            nonlocal before, count
            keys = rows.column(at).to_numpy()
            same = np.concatenate([[before is not None and keys[0] == before], keys[1:] == keys[:-1]])
            after = np.append(same[1:], False)
            n = len(keys) if last else len(keys) - 1
            columns = list(rows.columns)
            index = np.arange(len(keys))
            first = np.maximum.accumulate(np.where(same, -count, index))
            number = index - first
            if place:
                columns.append(pa.array(number, pa.int64()))
            if n:
                before, count = keys[n - 1], int(number[n - 1]) + 1
            keep = np.flatnonzero((same | after)[:n])
            if not len(keep):
                return None
            return pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in columns], names=out.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if pending is None else pa.Table.from_batches([pending, batch]).combine_chunks().to_batches()[0]
            made = emit(rows, last=False)
            pending = rows.slice(rows.num_rows - 1)
            if made is not None:
                yield made
        if pending is not None and (made := emit(pending, last=True)) is not None:
            yield made

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, out)


def sized_filter(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap with the bit of each long value of a stored table set: FILTER_SHARE bits per value, FILTER_LEAST at least and
    FILTER_BITS at most, so it may be broadcast. Beyond FILTER_BITS / FILTER_SHARE values it lets more pass; what passes it by chance has to be dropped
    by a join afterwards."""
    wanted = FILTER_SHARE * df.count()
    bits = min(FILTER_BITS, max(FILTER_LEAST, 1 << (wanted - 1).bit_length()))
    bit = F.pmod(F.col(column), F.lit(bits))
    # A row for the driver is a block of bits, not a word: hundreds of thousands of rows would be as many Python objects there.
    blocks = (
        df.where(F.col(column).isNotNull())
        .select(F.floor(bit / BLOCK_BITS).alias("block"), (bit % BLOCK_BITS).alias("bit"))
        .repartition("block")
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    table = np.zeros(bits // 8, np.uint8)
    for block, made in blocks.collect():
        table[block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8] = np.frombuffer(made, np.uint8)
    return table.view("<u8")


def passes(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the filter's bit of each 64-bit value is set; filters have a power of two of bits."""
    bit = values.view(np.int64) & np.int64(64 * len(table) - 1)
    return ((table[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
