"""Benchmark decontamination by template windows: numbers, names and units become typed placeholders."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import batch_of, sized_filter, map_batches, passes, stored, whole_text
from pairlab.llm.words import claim, mix, split_words

WINDOW = 8
SHORTEST = 4
FEWEST = 3
COVERAGE = 0.6
DRIFT = 16
PASSAGE = 13
SLICE_BYTES = 2 << 20

# Units that stand after numbers; fixed values.
UNITS = set(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound "
    "pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years dollar dollars usd euro euros cent cents percent % degree degrees "
    "celsius fahrenheit kmh mph watt watts volt volts meter meters metre metres".split()
)
NUMBER = re.compile(r"^[-+$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?$")
EDGES = re.compile(r"^[^\w$€£+\-%]+|[^\w%]+$")
LITERAL, NUM, NAME, UNIT = range(4)
KINDS = np.array([0, 11, 22, 33], np.uint64)


def bare(word: str) -> str:
    return EDGES.sub("", word)


def _code(word: str) -> int:
    """One number: 60 bits of the bare word's hash, its kind inside a sentence (2 bits), whether it ends a sentence, whether
    nothing is left of it. Words of letters and digits, with one sign at most after them, are by far the most; they need no
    patterns."""
    ends = False
    if word.isalnum():
        core = word
    elif word[:-1].isalnum() and word[-1] not in "_%":
        core, ends = word[:-1], word[-1] in ".!?:;|"
    else:
        core, ends = bare(word), word.rstrip("\"')]»”’")[-1:] in ".!?:;|"
    low = core.lower()
    kind = LITERAL
    if not core.isalpha() and NUMBER.match(core):
        kind = NUM
    elif low in UNITS:
        kind = UNIT
    elif core[:1].isupper() and core[1:].islower():
        kind = NAME
    return xxhash.xxh3_64_intdigest(low) >> 5 << 4 | kind << 2 | ends << 1 | (not core)


def template(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, n + 1 offsets, values, kinds) of an array of texts without nulls, with a row of values and kinds for each
    reading: every word as it is; placeholders, a capitalised word being a name inside a sentence only; placeholders, a
    capitalised word being a name everywhere. A unit is one only after a number. Each distinct word is looked at once."""
    lines = pc.split_pattern(texts, "\n")
    words, line_starts = split_words(lines.flatten())
    coded = words.dictionary_encode()
    known = coded.dictionary.to_numpy(zero_copy_only=False)
    codes = np.fromiter(map(_code, known), np.int64, len(known))[coded.indices.to_numpy()]
    marks = np.bincount(line_starts[:-1], minlength=len(words) + 1)  # sentence ends and line starts before each word
    marks[1:] += codes >> 1 & 1
    marks = np.cumsum(marks)
    filled = np.flatnonzero(codes & 1 == 0)
    offsets = np.searchsorted(filled, line_starts[lines.offsets.to_numpy()])
    if len(filled) < len(words):
        codes, words = codes[filled], words.take(pa.array(filled))
    kinds = np.zeros((3, len(codes)), np.int8)
    kinds[1:] = codes >> 2 & 3
    start = np.diff(marks[filled], prepend=-1) > 0
    number_before = np.zeros(len(codes) + 1, bool)
    number_before[1:] = kinds[1] == NUM
    number_before[offsets] = False
    kinds[1:, (kinds[1] == UNIT) & ~number_before[:-1]] = LITERAL
    kinds[1, (kinds[1] == NAME) & start] = LITERAL
    values = np.where(kinds == LITERAL, mix((codes >> 4).view(np.uint64)), KINDS[kinds])
    return words, offsets, values, kinds


def _runs(values: np.ndarray, width: int) -> np.ndarray:
    """``rolling`` of each row, by doubling."""
    factor, step, size, total = 0x9E3779B97F4A7C15, 1, 0, values
    while True:
        scale = np.uint64(factor)
        if width & step:
            total = total[:, : values.shape[1] - size] * scale + values[:, size:] if size else values
            size += step
        if 2 * step > width:
            return mix(total)
        values = values[:, :-step] * scale + values[:, step:]
        factor, step = factor * factor % 2**64, 2 * step


def windows(offsets: np.ndarray, values: np.ndarray, kinds: np.ndarray,
            widths: list[int]) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(width, hashes, good, able) of what ``template`` gives, hashes and good with a row for each reading.

    Good tells which windows count in a reading: all as they are; with the first placeholders those with literals in more
    than half their places (able), with the second those with FEWEST literals. What a reading has in common with one
    before it counts once; windows of less than SHORTEST words, and passages, count as they are only. No window that
    goes from one text into the next is good."""
    text_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    literal = np.zeros((2, len(text_of) + 1), np.int32)
    np.cumsum(kinds[1:] == LITERAL, axis=1, out=literal[:, 1:])
    found = []
    for width in widths:
        if width > len(text_of):
            continue
        whole = text_of[width - 1 :] == text_of[: len(text_of) - width + 1]
        first, second = literal[:, width:] - literal[:, :-width]
        able = 2 * first > width
        if width < SHORTEST or width == PASSAGE:
            good, values_of = whole[None], values[:1]
        else:
            other = [able & (first < width), (second >= FEWEST) & (second < np.where(able, first, width))]
            good, values_of = np.stack([whole, *(o & whole for o in other)]), values
        found.append((width, _runs(values_of, width), good, able))
    return found


def _slots(words: pa.Array, kinds: np.ndarray, reading: np.ndarray, at: np.ndarray, width: int) -> pa.Array:
    """The words in the placeholders of each window, bare and in lower case."""
    places = at[:, None] + np.arange(width)
    held = kinds[reading[:, None], places] != LITERAL
    ends = np.concatenate([[0], np.cumsum(held.sum(1))])
    found = [bare(word).lower() for word in words.take(pa.array(places[held])).to_pylist()]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.string()))


def benchmark_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, h, width, at, slots, able, n_windows, n_able) of every window of every item in each reading that counts,
    ``at`` being its first word. An item shorter than a window is one window of its own length; items under SHORTEST
    words are found word for word only. Windows of PASSAGE words are those of which one is enough."""
    fields = {
        "h": pa.int64(), "width": pa.int32(), "at": pa.int32(), "slots": pa.list_(pa.string()), "able": pa.bool_(),
        "n_windows": pa.int64(), "n_able": pa.int64(),
    }
    kind = items.schema[id_column].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        made = []
        for k in range(batch.num_rows):
            words, offsets, values, kinds = template(batch.column(1).slice(k, 1))
            n = len(words)
            for width, hashes, good, able in windows(offsets, values, kinds, [min(WINDOW, n), PASSAGE] if n else []):
                reading, at = np.nonzero(good)
                made.append(pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.full(len(at), k))),
                    *batch_of(fields, hashes[reading, at].view(np.int64), np.full(len(at), width), at,
                              _slots(words, kinds, reading, at, width), able[at], np.full(len(at), len(able)),
                              np.full(len(at), able.sum())).columns,
                ], names=["item_id", *fields]))
        return pa.concat_batches(made) if made else None

    return map_batches(
        items.select(id_column, whole_text(text_column).alias("text")),
        work,
        f"item_id {kind}, h long, width int, at int, slots array<string>, able boolean, n_windows long, n_able long",
    )


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_id_column: str = "item_id", item_text_column: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """(id, item_id, coverage, n_slots, n_conflicts) per document and benchmark item it holds.

    An item counts as held when one occurrence in the document has at least ``coverage`` of its windows, or of those with
    literals in more than half their places, and the values in their placeholders are the item's own, or agree: each
    value of the item stands for one value of the document, but for a quarter at most. Words at the start of a sentence
    are read as names and as plain words. Items under SHORTEST words are held where they stand word for word, and any
    item of which PASSAGE words in a row do. An occurrence is what lies at one distance (place in the document minus place
    in the item), at distances up to DRIFT words apart (words put in or left out), or the document as a whole; what is
    given is that of the best one. Null texts and texts without words hold nothing and are no items; rows with a null id
    take no part; rows that share an id are read as one document, each text having its own places. Empty tables give an
    empty result; other columns are not read.
    """
    spark = docs.sparkSession
    known = benchmark_windows(items, item_id_column, item_text_column).where(F.col("item_id").isNotNull())
    known = stored(known, "benchmark-windows")
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())  # up to WINDOW, and PASSAGE
    table = sized_filter(known, "h")
    shared = spark.sparkContext.broadcast((table, widths))
    kind = docs.schema[id_column].dataType.simpleString()
    fields = {"h": pa.int64(), "width": pa.int32(), "part": pa.int64(), "doc_at": pa.int32(), "doc_slots": pa.list_(pa.string())}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        bits, sizes = shared.value
        texts = batch.column(1)
        words, offsets, values, kinds = template(texts)
        made = []
        for width, hashes, good, _ in windows(offsets, values, kinds, sizes):
            places = np.flatnonzero(good)
            found = hashes.ravel()[places].view(np.int64)
            hit = np.flatnonzero(passes(bits, found))
            found, (reading, at) = found[hit], np.divmod(places[hit], hashes.shape[1])
            of = np.searchsorted(offsets, at, "right") - 1
            if width < SHORTEST or width == PASSAGE:  # once in a text is enough
                once = np.unique(np.stack([of, found]), axis=1, return_index=True)[1]
                found, reading, at, of = found[once], reading[once], at[once], of[once]
            if not len(at):
                continue
            own, place = np.unique(of, return_inverse=True)
            part = np.array([xxhash.xxh3_64_intdigest(texts[k].as_py()) >> 1 for k in own.tolist()])[place]
            made.append(pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(of)),
                *batch_of(fields, found, np.full(len(at), width), part, at - offsets[of],
                          _slots(words, kinds, reading, at, width)).columns,
            ], names=["id", *fields]))
        return pa.concat_batches(made) if made else None

    hits = map_batches(
        docs.where(F.col(id_column).isNotNull()).select(id_column, whole_text(text_column).alias("text")),
        work,
        f"id {kind}, h long, width int, part long, doc_at int, doc_slots array<string>",
        SLICE_BYTES,
        claim,
    ).distinct()
    joined = stored(hits, "template-hits").join(known, ["h", "width"])
    passage = F.col("width") == PASSAGE
    passages = joined.where(passage).select("id", "item_id").distinct()
    return (
        _judged(joined.where(~passage), passages, coverage)
        .groupBy("id", "item_id")
        .agg(F.max(F.struct("coverage", F.negative("n_conflicts").alias("rank"), "n_slots", "n_conflicts")).alias("best"))
        .select(F.col("id").alias(id_column), "item_id", "best.coverage", "best.n_slots", "best.n_conflicts")
    )


def _judged(joined: DataFrame, passages: DataFrame, coverage: float) -> DataFrame:
    """(id, item_id, coverage, n_slots, n_conflicts) of each occurrence that counts; all do where a passage is held."""
    away = F.col("doc_at") - F.col("at")

    def occurrence(what: int, part, number):
        return F.struct(F.lit(what).alias("what"), part.alias("part"), number.cast("long").alias("number"))

    part, none = F.col("part"), F.lit(0).cast("long")
    placed = joined.withColumn("same", F.col("slots") == F.col("doc_slots")).withColumn(
        "o",
        F.explode(F.array(
            occurrence(0, part, away),
            # Two rows of stretches, each half a stretch off: distances up to DRIFT apart share one of them.
            occurrence(1, part, F.floor(away / (2 * DRIFT))),
            occurrence(2, part, F.floor((away + DRIFT) / (2 * DRIFT))),
            occurrence(3, none, none),
        )),
    )
    key = ["id", "item_id", "o"]
    held = (
        placed.groupBy(*key, "at").agg(F.max("same").alias("same"), *(F.first(c).alias(c) for c in ("able", "n_windows", "n_able")))
        .groupBy(*key)
        .agg(
            F.greatest(
                F.count("*") / F.first("n_windows"), F.count_if("able") / F.greatest(F.first("n_able"), F.lit(1))
            ).alias("coverage"),
            (F.count_if("same") / F.first("n_windows")).alias("plain"),
        )
        .join(passages.withColumn("passage", F.lit(True)), ["id", "item_id"], "left")
        .where((F.col("coverage") >= coverage) | F.col("passage"))
    )
    values = (
        placed.select(*key, F.explode(F.arrays_zip("slots", "doc_slots")).alias("s"))
        .groupBy(*key, F.col("s.slots").alias("value"))
        .agg((F.min("s.doc_slots") != F.max("s.doc_slots")).alias("conflict"))
        .groupBy(*key)
        .agg(F.count("*").alias("n_slots"), F.sum(F.col("conflict").cast("long")).alias("n_conflicts"))
    )
    none = F.lit(0).cast("long")
    return (
        held.join(values, key, "left")
        .withColumns({"n_slots": F.coalesce("n_slots", none), "n_conflicts": F.coalesce("n_conflicts", none)})
        .where(F.col("passage") | (F.col("plain") >= coverage) | (4 * F.col("n_conflicts") <= F.col("n_slots")))
        .drop("o", "plain", "passage")
    )
