"""Longest common subsequences of token arrays, one row at a time, as Arrow UDFs.

The dynamic program runs on Python integers used as bit vectors (H. Hyyro, "Bit-parallel LCS-length
computation revisited", 2004): one big-integer step per token of one side covers all tokens of the other.
Spark has no operator for it; the helper sees one pair of texts and never a group.
"""

from __future__ import annotations

from collections import Counter
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from pairlab.functions.stem import flat_values, stem_nested

_MASK_BUDGET = 128 << 20


class PositionMasks:
    """For a sequence: token -> integer with a bit set at each position of the token."""

    def __init__(self, sequence):
        self.width = len(sequence)
        self.positions = {}
        for i, token in enumerate(sequence):
            self.positions.setdefault(token, []).append(i)
        self._built = {}

    def of(self, token) -> int:
        mask = self._built.get(token)
        if mask is None:
            bits = bytearray((self.width >> 3) + 1)
            for p in self.positions.get(token, ()):
                bits[p >> 3] |= 1 << (p & 7)
            mask = int.from_bytes(bits, "little")
            if len(self._built) * len(bits) < _MASK_BUDGET:
                self._built[token] = mask
        return mask


def lcs_length(a, b) -> int:
    if len(a) > len(b):
        a, b = b, a
    masks = PositionMasks(b)
    full = (1 << masks.width) - 1
    row = full
    for token in a:
        if token in masks.positions:
            hit = row & masks.of(token)
            row = ((row + hit) | (row - hit)) & full
    return masks.width - row.bit_count()


def lcs_positions(ref, masks: PositionMasks, can, among=None) -> list[int]:
    """Positions in ``ref`` of one longest common subsequence with ``can``.

    Traces back from the end; where two ways are equally long it shortens ``ref`` first, as the common scorers
    do.  Every k-th row of the table is kept and the rows between are built again, so memory grows with the
    square root of the length of ``ref``.  Tokens of ``ref`` that ``can`` lacks change no row and are left out;
    ``among`` names the positions to look at if the caller knows more are of no use.
    """
    known = masks.positions
    shared = [i for i in (range(len(ref)) if among is None else among) if ref[i] in known]
    if not shared:
        return []
    ref = [ref[i] for i in shared]
    full = (1 << masks.width) - 1
    step = max(64, isqrt(len(ref)) + 1)

    def rows_after(row, lo, hi):
        rows = [row]
        for token in ref[lo:hi]:
            hit = row & masks.of(token)
            row = ((row + hit) | (row - hit)) & full
            rows.append(row)
        return rows

    kept = [full]
    rows = None
    for lo in range(0, len(ref), step):
        rows = rows_after(kept[-1], lo, min(lo + step, len(ref)))
        kept.append(rows[-1])

    def length_at(row, j):
        return j - (row & ((1 << j) - 1)).bit_count()

    found = []
    i, j, base = len(ref), len(can), (len(ref) - 1) // step * step
    left = length_at(kept[-1], j)
    while left > 0:
        if i <= base:
            base -= step
            rows = rows_after(kept[base // step], base, base + step)
        if ref[i - 1] == can[j - 1]:
            found.append(shared[i - 1])
            i, j, left = i - 1, j - 1, left - 1
        elif rows[i - base] >> (j - 1) & 1 and length_at(rows[i - 1 - base], j) < left:
            j -= 1
        else:
            i -= 1
    return found[::-1]


def union_lcs_hits(ref_lines, can_lines) -> int:
    """Summary-level LCS: per reference line the union of its LCS positions with every candidate line; a hit
    counts only while both sides still have that token left."""
    if len(ref_lines) == 1 and len(can_lines) == 1:
        return lcs_length(ref_lines[0], can_lines[0])
    left_ref = Counter(t for line in ref_lines for t in line)
    left_can = Counter(t for line in can_lines for t in line)
    masks = [PositionMasks(line) for line in can_lines]
    lines_with = {}
    for k, line_masks in enumerate(masks):
        for token in line_masks.positions:
            lines_with.setdefault(token, []).append(k)
    hits = 0
    for line in ref_lines:
        shared = [p for p, token in enumerate(line) if token in lines_with]
        touched = {k for token in {line[p] for p in shared} for k in lines_with[token]}
        union = set()
        for k in touched:
            union.update(lcs_positions(line, masks[k], can_lines[k], shared))
        for p in sorted(union):
            token = line[p]
            if left_can[token] > 0 and left_ref[token] > 0:
                hits += 1
                left_can[token] -= 1
                left_ref[token] -= 1
    return hits


def _codes(*values: pa.Array) -> list[np.ndarray]:
    """Strings as integers that are equal where the strings are."""
    codes = pa.concat_arrays(values).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.split(codes, np.cumsum([len(v) for v in values])[:-1])


def _valid(array: pa.Array) -> np.ndarray:
    return array.is_valid().to_numpy(zero_copy_only=False)


def lcs(left: Column, right: Column, stem: bool = False) -> Column:
    """LCS length of two token arrays, with ``stem`` of their stems; null where either is null."""

    @F.arrow_udf("bigint")
    def length(a: pa.Array, b: pa.Array) -> pa.Array:
        if stem:
            a, b = stem_nested(a), stem_nested(b)
        (av, ao), (bv, bo) = flat_values(a), flat_values(b)
        (av, bv), ao, bo = _codes(av, bv), ao.to_pylist(), bo.to_pylist()
        ok = _valid(a) & _valid(b)
        return pa.array(
            [
                lcs_length(av[ao[i]:ao[i + 1]].tolist(), bv[bo[i]:bo[i + 1]].tolist()) if ok[i] else None
                for i in range(len(a))
            ],
            pa.int64(),
        )

    return length(left, right)


def union_lcs(ref_lines: Column, can_lines: Column, stem: bool = False) -> Column:
    """Summary-level LCS hits of two arrays of token arrays, with ``stem`` of their stems; null where either is null."""

    @F.arrow_udf("bigint")
    def hits(a: pa.Array, b: pa.Array) -> pa.Array:
        if stem:
            a, b = stem_nested(a), stem_nested(b)
        (al, ao), (bl, bo) = flat_values(a), flat_values(b)
        (av, alo), (bv, blo) = flat_values(al), flat_values(bl)
        av, bv = _codes(av, bv)
        ao, bo, alo, blo = ao.to_pylist(), bo.to_pylist(), alo.to_pylist(), blo.to_pylist()
        ok = _valid(a) & _valid(b)

        def lines(values, starts, lo, hi):
            return [values[starts[k]:starts[k + 1]].tolist() for k in range(lo, hi)]

        return pa.array(
            [
                union_lcs_hits(lines(av, alo, ao[i], ao[i + 1]), lines(bv, blo, bo[i], bo[i + 1])) if ok[i] else None
                for i in range(len(a))
            ],
            pa.int64(),
        )

    return hits(ref_lines, can_lines)
