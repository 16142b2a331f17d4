"""Words of texts as numpy arrays of hashes, without an object per word."""

from __future__ import annotations

import weakref
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pairlab.llm.arrow import flat_bytes, give_back

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEGMENT = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers well mixed; the finaliser of a published generator (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_LOWERED = _BYTES[list(LOWER)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.cumprod(made, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, SEGMENT), _powers(_INVERSE, SEGMENT)


def hashed_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, n + 1 offsets) of the runs without ASCII white space of an array of texts without nulls; with
    ``lower``, A-Z count as a-z.

    A word's hash is a polynomial over random numbers of its bytes, read off running sums of the batch, so it is the same
    wherever the word stands. Sums run over segments of bounded size.
    """
    flat, offsets = flat_bytes(texts)
    solid = ~_SPACE[flat]
    # A word starts after a blank or at a text's first byte, and ends before a blank or at a text's last byte.
    before, after = np.concatenate([[True], ~solid])[:-1], np.concatenate([~solid, [True]])[1:]
    before[offsets[offsets < len(flat)]] = True
    after[offsets[offsets > 0] - 1] = True
    starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    table = _LOWERED if lower else _BYTES
    values = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        piece = flat[base : ends[j - 1]]
        up, down = (_UP, _DOWN) if len(piece) <= SEGMENT else (_powers(_BASE, len(piece)), _powers(_INVERSE, len(piece)))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(table[piece] * up[: len(piece)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        values[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        i = j
    return mix(values), np.searchsorted(starts, offsets).astype(np.int64)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Mixed hash of each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = values[:n].copy()
    for k in range(1, width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mix(total)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, n + 1 offsets) as ``str.split`` gives them, of an array of texts without nulls."""
    split = pc.utf8_split_whitespace(texts)
    words = split.flatten()
    solid = pc.not_equal(words, "")
    before = np.zeros(len(words) + 1, np.int64)
    np.cumsum(solid.to_numpy(zero_copy_only=False), out=before[1:])
    return words.filter(solid), before[split.offsets.to_numpy()]


class Recent(dict):
    """Results of ``work`` by key, of bounded number: the last ``limit`` made and the ``limit`` in use before them. Keys
    longer than ``longest`` are worked out each time. Tasks of one operator share it in their worker; ``claim`` drops it
    when the worker goes on to another."""

    made: list[weakref.ref] = []

    def __init__(self, work: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.work, self.limit, self.longest, self.before = work, limit, longest, {}
        Recent.made.append(weakref.ref(self))

    def __missing__(self, key):
        made = self.before.pop(key, None)
        if made is None:
            made = self.work(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[key] = made
        return made

    def forget(self) -> None:
        self.clear()
        self.before = {}


def claim(*own: Recent) -> None:
    """Called by a task before its work: forget what other operators have put aside in this worker, and return its memory."""
    others = [c for r in Recent.made if (c := r()) is not None and not any(c is o for o in own) and (c or c.before)]
    for cache in others:
        cache.forget()
    if others:
        give_back()
