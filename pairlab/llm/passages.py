"""Repeated passages: what the two substring operators share.

A window is ``window`` consecutive symbols (bytes or words) of one document. Its anchor is the ``gram`` symbols in it
of least hash, the leftmost of equals; equal windows have equal anchors at equal places, so each window belongs to one
anchor and can only equal windows of anchors with the same hash. Consecutive windows of one anchor make a piece. Anchors
whose hash stands alone in the corpus go away before any text moves, and so do pieces whose content (a second hash) an
earlier one has: they are covered whole. Only the first piece of each content is compared with the others of its
anchor. An anchor with more than HOT of them is a phrase in ever other surroundings; its windows are brought together by
their own content, which needs no group of pieces. Texts without a piece to compare, or without a mark in the end, are
told by filters and are not shuffled; what a filter lets pass by chance is dropped by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.llm.arrow import batch_of, map_batches, parts, passes, repeated, sized_filter, stored, whole_text
from pairlab.llm.words import mix

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
HOT = 20_000


@dataclass(frozen=True)
class Symbols:
    """How texts become symbols: ``read`` gives the arrays of a batch (hash of each symbol, n + 1 offsets, symbol data
    whose items are cut into pieces)."""

    read: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]
    dtype: type
    window: int
    gram: int


def grams(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` symbols, a power of two, by doubling."""
    step = 1
    while step < width and len(values) > step:
        values = mix(values[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step)) + values[step:]
        step *= 2
    return mix(values) if step >= width else values[:0]


def contents(hashes: np.ndarray, start: np.ndarray, size: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``size`` symbols from each ``start`` on, from the hashes of the grams that cover them."""
    total = mix(hashes[start + size - gram] + size.astype(np.uint64))
    for k in range(int(size.max(initial=0)) // gram):
        inside = (k + 1) * gram <= size
        more = np.where(inside, hashes[np.where(inside, start + k * gram, 0)], np.uint64(0))
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + more)
    return total.view(np.int64)


def anchors(values: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, document, first window, windows, anchor place minus first window, content) of each piece of a batch of
    documents."""
    n = len(values)
    none = np.zeros(0, np.int64)
    if n < window:
        return (none,) * 6
    hashes = grams(values, gram)
    least = (hashes >> np.uint64(32)).astype(np.uint32)
    place = np.arange(len(least), dtype=np.int32)
    span, width = window - gram + 1, 1
    while width < span:
        step = min(width, span - width)
        right = least[step:] < least[: len(least) - step]
        m = len(right)
        place = np.where(right, place[step:], place[:m])
        least = np.where(right, least[step:], least[:m])
        width += step
    lengths = np.diff(offsets)
    counts = np.maximum(lengths - window + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), counts)
    if not len(doc):
        return (none,) * 6
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][doc]
    at = place[first]
    change = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    size = np.diff(np.append(change, len(doc)))
    start = first[change]
    content = contents(hashes, start, size + window - 1, gram)
    return hashes[at[change]].view(np.int64), doc[change], start - offsets[doc[change]], size, at[change] - start, content


def covered(docs: DataFrame, id_column: str, text_column: str, symbols: Symbols,
            duplicates: Callable[[list[np.ndarray], np.ndarray], np.ndarray], whole_rows: bool = False) -> DataFrame:
    """(id, text, whole, spans), and the row with ``whole_rows``, per row of ``docs``: whole marks a text that an earlier document has entirely; spans
    are the (start, end) symbols that windows with an earlier start cover, else.

    ``duplicates(pieces, anchor_offsets)`` gets pieces in document order and tells, as one flat boolean array over all
    their windows, which windows have an equal one in an earlier piece.

    Rows with a null id have no place in the order of documents: nothing in them is removed, nothing removed because of
    them. Rows with equal id and text are the same document and get equal results; of different texts under one id
    only that of least digest takes part.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    spark, window = docs.sparkSession, symbols.window
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole_rows else F.lit(None).cast("int")
    texts = docs.select(
        F.col(id_column).alias("id"), whole_text(text_column).alias("text"), others.alias("row")
    ).withColumn("x", F.xxhash64("text"))
    known = texts.where("id IS NOT NULL")
    firsts = (
        known.groupBy(F.md5("text").alias("digest"))
        .agg(F.min("id").alias("id"), F.any_value("x").alias("x"))
        .groupBy("id")
        .agg(F.min("x").alias("own"))
    )
    firsts = stored(firsts, "firsts")

    def among(table: DataFrame, key: Column) -> Callable[[pa.RecordBatch], np.ndarray]:
        """Which rows may have the key (column ``at``) of a row of ``table``."""
        shared = spark.sparkContext.broadcast(sized_filter(table.select(key.alias("at")), "at"))
        return lambda batch: passes(shared.value, batch.column("at").to_numpy())

    leading = known.select("id", "x", "text", F.xxhash64("id", "x").alias("at"))
    is_first = among(firsts, F.xxhash64("id", "own"))

    def find(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(is_first(batch)))
        values, offsets, _ = symbols.read(batch.column("text"))
        h, doc, start, size, anchor, content = anchors(values, offsets, window, symbols.gram)
        if not len(h):
            return None
        rest = batch_of({"h": pa.int64(), "place": pa.int64(), "c": pa.int64()}, h, start << 32 | size << 16 | anchor, content)
        own = [batch.column(c).take(pa.array(doc)) for c in ("id", "x")]
        return pa.RecordBatch.from_arrays([*own, *rest.columns], names=["id", "x", "h", "place", "c"])

    again = repeated(map_batches(leading, find, f"id {kind}, x long, h long, place long, c long", SLICE_BYTES), "h", [])
    # Other texts of an id that passed the filter by chance end here.
    places = stored(again.join(firsts.withColumnRenamed("own", "x"), ["id", "x"]).drop("x"), "places")
    content = [F.col("h"), F.col("c"), F.col("place").bitwiseAND(0xFFFF).alias("anchor")]
    lead = F.min(F.struct("id", "place")).alias("lead")
    leads = stored(places.groupBy(*content).agg(lead).select("h", "c", "anchor", "lead"), "leads")
    grams_of = leads.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    grams_of = stored(grams_of.select("h", (F.col("n") > HOT).alias("hot")), "grams")
    compared = leads.join(grams_of, "h").select("hot", "h", "lead.*").join(firsts, "id")
    # A piece that is no lead has an equal one before it: it is covered as a whole.
    copied = places.select("id", "place", *content).join(leads, ["h", "c", "anchor"]).where("id <> lead.id OR place <> lead.place")
    spans = copied.select("id", F.array(_span(F.col("place"), window)).alias("spans")).unionAll(
        _index_spans(leading, compared.where("NOT hot"), symbols, duplicates, among, kind)
    )
    if grams_of.where("hot").take(1):
        spans = spans.unionAll(_window_spans(leading, compared.where("hot"), symbols, among, kind))
    nothing = F.lit(None).cast("array<struct<a:int,b:int>>")
    spans = spans.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("spans")).join(firsts, "id")
    copies = known.select("id").distinct().join(firsts, "id", "left_anti")
    marks = stored(
        spans.where(F.size("spans") > 0).select("id", "own", F.lit(False).alias("whole"), "spans").unionAll(
            copies.select("id", F.lit(None).cast("long"), F.lit(True), nothing)
        ),
        "marks",
    )
    # Texts without a mark stay where they are; only the others are shuffled to their marks.
    is_marked = among(marks, F.xxhash64("id"))
    rows = texts.select("id", "text", "row", "x", F.xxhash64("id").alias("at"))

    def chosen(marked: bool) -> DataFrame:
        def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
            hit = is_marked(batch)
            return batch.filter(pa.array(hit if marked else ~hit))

        return map_batches(rows, keep, rows.schema)

    own = F.col("x") == F.col("own")
    found = chosen(True).join(marks, "id", "left").select(
        "id", "text", "row", F.coalesce("whole", F.lit(False)).alias("whole"), F.when(own, F.col("spans")).alias("spans")
    )
    rest = chosen(False).select("id", "text", "row", F.lit(False).alias("whole"), nothing.alias("spans"))
    return found.unionAll(rest).select("id", "text", "whole", "spans", *(["row"] if whole_rows else []))


def _span(place: Column, window: int) -> Column:
    """The symbols that the windows of a piece cover."""
    start, size = F.shiftright(place, 32).cast("int"), F.shiftright(place, 16).bitwiseAND(0xFFFF).cast("int")
    return F.struct(start.alias("a"), (start + size + F.lit(window - 1)).alias("b"))


def _with_places(texts: DataFrame, leads: DataFrame, among) -> DataFrame:
    """(id, text, places) of the texts that hold pieces to compare; no other text moves."""
    held = leads.groupBy("id", F.col("own").alias("x")).agg(F.collect_list(F.struct("h", "place")).alias("places"))
    held = stored(held, "held")
    is_held = among(held, F.xxhash64("id", "x"))

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(is_held(batch)))

    return map_batches(texts, keep, texts.schema).drop("at").join(held, ["id", "x"]).select("id", "text", "places")


def _pieces(batch: pa.RecordBatch, symbols: Symbols) -> tuple[np.ndarray, ...]:
    """(document, hash, start, windows, anchor, begin in the batch) of the places of a batch, the symbols' hashes and the
    symbols."""
    values, offsets, data = symbols.read(batch.column("text"))
    rows = batch.column("places")
    flat, count = rows.flatten(), np.diff(rows.offsets.to_numpy())
    doc = np.repeat(np.arange(batch.num_rows), count)
    h, packed = flat.field("h").to_numpy(), flat.field("place").to_numpy()
    start = packed >> 32
    return doc, h, start, packed >> 16 & 0xFFFF, packed & 0xFFFF, offsets[doc] + start, values, data


def _index_spans(texts: DataFrame, leads: DataFrame, symbols: Symbols, duplicates, among, kind: str) -> DataFrame:
    """(id, spans) of what an index over the pieces of each anchor shows to be repeated."""
    window = symbols.window
    place = {"h": pa.int64(), "start": pa.int32(), "n": pa.int32(), "anchor": pa.int32()}

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        doc, h, start, n, anchor, begin, _, data = _pieces(batch, symbols)
        pieces = [data[b : b + m + window - 1].tobytes() for b, m in zip(begin.tolist(), n.tolist(), strict=True)]
        small = (x.astype(np.int32) for x in (start, n, anchor))
        rest = batch_of({**place, "piece": pa.binary()}, h, *small, pieces)
        return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(doc)), *rest.columns], names=["id", *place, "piece"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            made = _judge(block, symbols, duplicates)
            if made.num_rows:
                yield made

    held = _with_places(texts, leads, among)
    pieces = map_batches(held, cut, f"id {kind}, h long, start int, n int, anchor int, piece binary", SLICE_BYTES)
    return pieces.repartition("h").sortWithinPartitions("h", "id", "start").mapInArrow(
        compare, f"id {kind}, spans array<struct<a:int,b:int>>"
    )


def _window_spans(texts: DataFrame, leads: DataFrame, symbols: Symbols, among, kind: str) -> DataFrame:
    """(id, spans) of the repeated windows of anchors with very many different pieces: every window but the first of its
    content. The first is found by a sum per task before the shuffle; no anchor is gathered anywhere."""
    window, gram = symbols.window, symbols.gram

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        doc, h, start, n, anchor, begin, values, _ = _pieces(batch, symbols)
        which = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        content = contents(grams(values, gram), begin[which] + step, np.full(len(which), window), gram)
        kinds = {"h": pa.int64(), "c": pa.int64(), "anchor": pa.int32(), "start": pa.int32()}
        rest = batch_of(kinds, h[which], content, (anchor[which] - step).astype(np.int32), (start[which] + step).astype(np.int32))
        return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(doc[which])), *rest.columns], names=["id", *kinds])

    held = _with_places(texts, leads, among)
    windows = stored(map_batches(held, cut, f"id {kind}, h long, c long, anchor int, start int", SLICE_BYTES), "windows")
    key = ["h", "c", "anchor"]
    firsts = windows.groupBy(*key).agg(F.min(F.struct("id", "start")).alias("lead"))
    again = windows.join(firsts, key).where("id <> lead.id OR start <> lead.start")
    return again.select("id", F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.lit(window)).alias("b"))).alias("spans"))


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of several; offsets of 64 bits, so that no size makes two of it."""
    table = pa.Table.from_batches(held)
    at = table.schema.get_field_index("piece")
    table = table.set_column(at, "piece", table.column(at).cast(pa.large_binary())).combine_chunks()
    (batch,) = table.to_batches()
    return batch


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h, in blocks of about BLOCK_BYTES that never cut a run of equal h; a run has at most HOT rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for whole in batches:
        for batch in parts(whole):
            if not batch.num_rows:
                continue
            keys = batch.column("h").to_numpy()
            if held and size >= BLOCK_BYTES:
                last = held[-1].column("h")[-1].as_py()
                cut = int(np.searchsorted(keys != last, True)) if keys[0] == last else 0
                if cut < len(keys):
                    yield _joined([*held, batch.slice(0, cut)] if cut else held)
                    held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.nbytes
    if held:
        yield _joined(held)


def _judge(block: pa.RecordBatch, symbols: Symbols, duplicates) -> pa.RecordBatch:
    """(id, covered spans) of every piece of a block that has some."""
    ids, start = block.column("id").to_numpy(zero_copy_only=False), block.column("start").to_numpy()
    n, anchor, h = (block.column(c).to_numpy() for c in ("n", "anchor", "h"))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(ids))]
    shared = np.concatenate([[False], h[1:] == h[:-1]])
    shared |= np.append(shared[1:], False)
    order = np.flatnonzero(shared)
    if len(order):
        order = order[np.lexsort((start[order], ids[order]))]
        raw = block.column("piece").take(pa.array(order)).to_pylist()
        pieces = [np.frombuffer(p, symbols.dtype) for p in raw]
        again = duplicates(pieces, anchor[order])
        firsts = np.concatenate([[0], np.cumsum(n[order])])
        piece = np.repeat(np.arange(len(order)), n[order])
        hit = np.flatnonzero(again)
        if len(hit):
            gap = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (piece[hit[1:]] != piece[hit[:-1]])]))
            ends = np.append(gap[1:], len(hit)) - 1
            for a, b in zip(hit[gap].tolist(), hit[ends].tolist(), strict=True):
                k = piece[a]
                base = int(start[order[k]]) - int(firsts[k])
                spans[order[k]].append((base + a, base + b + symbols.window))
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    marked = [k for k, s in enumerate(spans) if s]
    made = pa.array([[{"a": a, "b": b} for a, b in spans[k]] for k in marked], kind)
    return pa.RecordBatch.from_arrays([block.column("id").take(pa.array(marked, pa.int64())), made], names=["id", "spans"])


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of what (start, end) spans cover, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
