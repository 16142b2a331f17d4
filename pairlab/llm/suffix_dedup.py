"""Repeated byte strings, found by building the suffix order of a collection column by column."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import batch_of, flat_bytes, map_batches
from pairlab.llm.passages import SLICE_BYTES, Symbols, covered, union_of
from pairlab.llm.words import mix

GRAM = 32
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def _read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat, offsets = flat_bytes(texts)
    return _BYTES[flat], offsets, flat


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low:high]`` for each pair, high > low, from a table of doubling widths."""
    width = high - low
    level = np.int64(np.floor(np.log2(width)))
    out = np.empty(len(low), values.dtype)
    table, step = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            table = np.minimum(table[:-step], table[step:])
            step *= 2
        rows = np.flatnonzero(level == k)
        out[rows] = np.minimum(table[low[rows]], table[high[rows] - step])
    return out


def columnwise(pieces: list[np.ndarray], anchors: np.ndarray, window: int) -> np.ndarray:
    """For every window of every piece, whether an earlier piece has an equal window in the same column.

    Columns are places relative to the anchor, and equal windows always stand in one column. Columns are taken from
    right to left; in each, every piece that reaches it gets one more symbol at its front. The pieces stay sorted by
    what they hold so far: the new order is a stable sort of the old one by the new symbol, and the common prefix of
    neighbours is one longer than the least of those between them before, or empty where the symbols differ. Runs of
    neighbours with a common prefix of a whole window hold equal windows; all but the earliest piece are repeats.
    """
    m = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    left = -anchors.astype(np.int64)
    right = left + lengths
    counts = lengths - window + 1
    firsts = np.cumsum(counts) - counts
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate(pieces)
    again = np.zeros(int(counts.sum()), bool)
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int32)
    by_end = np.argsort(-right, kind="stable")
    ends = -right[by_end]
    for column in range(int(right.max()) - 1, int(left.min()) - 1, -1):
        kept = left[order] <= column
        if not kept.all():
            at = np.flatnonzero(kept)
            if len(at):
                common = np.concatenate([[0], _range_min(common, at[:-1] + 1, at[1:] + 1)]).astype(np.int32) if len(at) > 1 else np.zeros(1, np.int32)
            else:
                common = np.zeros(0, np.int32)
            order = order[at]
        fresh = by_end[np.searchsorted(ends, -(column + 1), "left") : np.searchsorted(ends, -(column + 1), "right")]
        if len(fresh):
            order = np.concatenate([fresh, order])
            common = np.concatenate([np.zeros(len(fresh), np.int32), common])
            if len(common) > len(fresh):
                common[len(fresh)] = 0
        if not len(order):
            continue
        symbol = flat[offsets[order] + column - left[order]]
        moved = np.argsort(symbol, kind="stable")
        grown = np.zeros(len(order), np.int32)
        symbol = symbol[moved]
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        if len(same):
            grown[same] = 1 + _range_min(common, moved[same - 1] + 1, moved[same] + 1)
        order, common = order[moved], grown
        long = common >= window
        if long.any():
            starts = np.flatnonzero(~long)
            earliest = np.minimum.reduceat(order, starts)
            run = np.cumsum(~long) - 1
            later = order[order != earliest[run]]
            again[firsts[later] + column - left[later]] = True
    return again


def _found(docs: DataFrame, id_column: str, text_column: str, width: int, whole_rows: bool = False) -> DataFrame:
    symbols = Symbols(_read, np.uint8, width, GRAM)
    return covered(docs, id_column, text_column, symbols, lambda p, at: columnwise(p, at, width), whole_rows)


def _texts_and_runs(batch: pa.RecordBatch, width: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """Each text of a batch of ``covered`` with the maximal runs of bytes to remove."""
    out = []
    for text, whole, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "spans")), strict=True):
        size = len(text.encode()) if whole else 0
        out.append((text, [(0, size)] if size >= width else union_of([(s["a"], s["b"]) for s in spans or ()])))
    return out


def repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 100) -> DataFrame:
    """(id, text, spans) per row: ``spans`` are the maximal runs of UTF-8 bytes of the text that are covered by strings of
    ``width`` bytes with an earlier start, in a document of smaller id or earlier in the same one.

    A null text is empty. Texts shorter than ``width`` have no spans. Strings never cross documents. Null and
    repeated ids: see ``passages.covered``. Empty tables give empty ones; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[{"a": a, "b": b} for a, b in runs] for _, runs in _texts_and_runs(batch, width)]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text"), pa.array(out, span)], names=[id_column, "text", "spans"]
        )

    found = _found(docs, id_column, text_column, width)
    return map_batches(found, work, f"`{id_column}` {kind}, text string, spans array<struct<a:int,b:int>>", SLICE_BYTES)


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def kept_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a character goes only if all its bytes do."""
    raw, whole = text.encode(), []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b < len(raw) and b > a and raw[b] & 0xC0 == 0x80:
            b -= 1
        whole.append((a, max(a, b)))
    return kept_bytes(raw, whole).decode()


def digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 100) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row; edge cases as for ``repeated_bytes``."""
    kind = docs.schema[id_column].dataType.simpleString()
    fields = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, runs in _texts_and_runs(batch, width):
            raw = text.encode()
            kept = kept_bytes(raw, runs)
            rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
        rest = batch_of(fields, *(list(c) for c in zip(*rows, strict=True)))
        return pa.RecordBatch.from_arrays([batch.column("id"), *rest.columns], names=[id_column, *fields])

    return map_batches(
        _found(docs, id_column, text_column, width),
        work,
        f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        SLICE_BYTES,
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 100) -> DataFrame:
    """All rows and columns of ``docs``, the repeated spans taken out of the texts, characters kept whole. A null text
    stays null; edge cases as for ``repeated_bytes``."""
    found = _found(docs, id_column, text_column, width, whole_rows=True)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [kept_text(text, runs) if runs else text for text, runs in _texts_and_runs(batch, width)]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "kept"])

    schema = found.select("row", F.col("text").alias("kept")).schema
    made = map_batches(found, work, schema, SLICE_BYTES)
    return made.select(
        *(
            F.when(F.col(f"row.`{c}`").isNotNull(), F.col("kept")).alias(c) if c == text_column else F.col(f"row.`{c}`")
            for c in docs.columns
        )
    )
