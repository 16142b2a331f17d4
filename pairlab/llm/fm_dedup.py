"""Repeated word windows, found by backward search in an FM-index over a wavelet matrix."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import batch_of, map_batches
from pairlab.llm.passages import Symbols, covered, union_of
from pairlab.llm.words import hashed_words

GRAM = 8
STREAM = 1 << 16


def _read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, offsets = hashed_words(texts)
    return values, offsets, values


class Bits:
    """Packed bits with a count before each 64 of them: rank takes one lookup and one population count."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])[: len(counts)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Burrows-Wheeler transform of a collection of symbol sequences in a wavelet matrix, with C counts and the text
    place of each suffix."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, depth: int):
        """``symbols`` from 1 up; each sequence is followed by a 0 (at ``ends``); suffixes are sorted to ``depth``."""
        n = len(symbols)
        rank = symbols.astype(np.int64)
        rank[ends] = 0
        width = 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[: n - width] = rank[width:] + 1 if width < n else 0
            key = rank * (int(follow.max()) + 1) + follow
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            width *= 2
            if width >= depth + 1 or fresh[-1] == n - 1:
                break
        self.suffixes = order
        self.levels = max(1, int(symbols.max()).bit_length())
        last = symbols[order - 1]
        # Sorting stops at ``depth`` symbols: with ends in the text as ordinary symbols, ranks stay right to that depth.
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))])
        self.matrix, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = ((last >> level) & 1).astype(np.uint8)
            self.matrix.append(Bits(bit))
            self.zeros.append(int((bit == 0).sum()))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        every = np.arange(int(symbols.max()) + 1)
        self.base = self._descend(every, np.zeros(len(every), np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(reversed(range(self.levels))):
            ones = self.matrix[k].rank(at)
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol at their front."""
        start = self.starts[symbol] - self.base[symbol]
        return start + self._descend(symbol, low), start + self._descend(symbol, high)


def repeats(pieces: list[np.ndarray], anchors: np.ndarray, window: int) -> np.ndarray:
    """For every window of every piece (in document order), whether it also starts earlier.

    The pieces make one index; their windows are streamed against it in blocks, all windows of a block taking one step
    of backward search at a time. A window whose interval has shrunk to itself is given up; an interval that is still
    longer after the whole window holds all its starts, the least of which is the first.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    words = np.concatenate(pieces)
    _, ids = np.unique(words, return_inverse=True)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    text = np.zeros(len(words) + len(pieces), np.int64)
    text[np.arange(len(words)) + piece] = ids + 1
    ends = np.cumsum(lengths + 1) - 1
    index = FmIndex(text, ends, window)
    counts = lengths - window + 1
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(ends - lengths, counts) + inside
    again = np.zeros(len(starts), bool)
    suffixes = np.append(index.suffixes, len(text))
    for at in range(0, len(starts), STREAM):
        rows = np.arange(at, min(at + STREAM, len(starts)))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(text))
        for step in range(window - 1, -1, -1):
            low, high = index.extend(text[starts[rows] + step], low, high)
            alive = high - low > 1
            if not alive.all():
                rows, low, high = rows[alive], low[alive], high[alive]
            if not len(rows):
                break
        if len(rows):
            spots, which = np.unique(low, return_inverse=True)
            stops = np.zeros(len(spots), np.int64)
            stops[which] = high
            least = np.minimum.reduceat(suffixes, np.stack([spots, stops], 1).ravel())[::2]
            again[rows] = starts[rows] > least[which]
    return again


def repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 20) -> DataFrame:
    """(id, n_words, n_removed, spans, kept) per row: ``spans`` are the maximal runs of words covered by windows that also
    start earlier (smaller id, or earlier in the same document), ``kept`` the other words joined by one space.

    Words are runs of anything but ASCII white space. Null and empty texts have 0 words and keep the empty text. Texts
    shorter than a window have no spans. Null and repeated ids: see ``passages.covered``. Empty tables give empty ones;
    other columns are not read.
    """
    symbols = Symbols(_read, np.uint64, window, GRAM)
    found = covered(docs, id_column, text_column, symbols, lambda pieces, at: repeats(pieces, at, window))
    kind = docs.schema[id_column].dataType.simpleString()
    fields = {
        "n_words": pa.int64(), "n_removed": pa.int64(),
        "spans": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), "kept": pa.string(),
    }

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("text", "whole", "spans"))
        for text, whole, spans in zip(*columns, strict=True):
            words = text.encode().split()
            n = len(words)
            runs = [(0, n)] if whole and n >= window else union_of([(s["a"], s["b"]) for s in spans or ()])
            for a, b in reversed(runs):
                del words[a:b]
            rows.append((n, n - len(words), [{"a": a, "b": b} for a, b in runs], b" ".join(words).decode()))
        rest = batch_of(fields, *(list(c) for c in zip(*rows, strict=True)))
        return pa.RecordBatch.from_arrays([batch.column("id"), *rest.columns], names=[id_column, *fields])

    return map_batches(
        found, work,
        f"`{id_column}` {kind}, n_words long, n_removed long, spans array<struct<a:int,b:int>>, kept string",
    )


def digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 20) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row of ``repeated_words``."""
    return repeated_words(docs, id_column, text_column, window).select(
        id_column, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
