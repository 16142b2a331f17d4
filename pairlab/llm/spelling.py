"""Spelling variants: words one edit apart, found by dense comparison of padded code-point matrices.

A single edit of a word leaves all outside a short stretch as it is. Words meet under what stands outside one half of
them; groups that grow too large for one tile meet again under what stands outside a quarter, an eighth and so on. In a
tile every word is compared with every other at once: common prefix plus common suffix reach the longer length minus one
exactly for single edits. A pair counts in the tile whose stretch holds the end of its common prefix, hence once.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import parts, stored, whole_text
from pairlab.llm.words import LOWER

LETTERS = "A-Za-zÀ-ÿ"
DAMAGE = 97
SHORTEST, LEAST = 5, 3
TILE_WORDS = 512
TILE_BYTES = 4 << 20
HELD_WORDS = 100_000
BLOCK_WORDS = 50_000


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damage: int | None = DAMAGE,
                shortest: int = SHORTEST) -> DataFrame:
    """(word, n): runs of letters (A-Z in lower case) of ``shortest`` or more code points with their number in all texts.

    With ``damage``, a run loses one code point where that number divides the checksum of ``<id>:<run>``; rows without
    an id keep their runs. Each task adds up its words, at most HELD_WORDS at a time.
    """
    runs = re.compile(rf"[{LETTERS}]{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return made

        for whole in batches:
            for batch in parts(whole):
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    found: dict[str, int] = defaultdict(int)
                    for run in runs.findall(text.encode().translate(LOWER).decode()):
                        found[run] += 1
                    start = None if damage is None or key is None else zlib.crc32(f"{key}:".encode())
                    for run, n in found.items():
                        if start is not None:
                            h = zlib.crc32(run.encode(), start)
                            if h % damage == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < shortest:
                                    continue
                        held[run] += n
                    if len(held) >= HELD_WORDS:
                        yield flush()
        if held:
            yield flush()

    texts = docs.select(F.col(id_column).cast("string").alias("id"), whole_text(text_column).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) twice, with either half of their stretch [a, b) and a key of what stands outside it. A word
    of m code points has b - a of them inside; one of m + 1 has one more there."""
    middle = "int((a + b) div 2)"
    halved = rows.select("word", "n", "m", F.expr(f"inline(array(struct(a AS a, {middle} AS b), struct({middle} AS a, b AS b)))"))
    before, after = F.expr("substring(word, 1, a)"), F.expr("substring(word, char_length(word) - (m - b) + 1)")
    return halved.withColumn("key", F.concat_ws("|", "m", "a", "b", before, after))


def _tiles(words: DataFrame, tile_words: int) -> DataFrame:
    """(key, a, b, m, word, n): the words of each group to be compared. No group has more than ``tile_words`` members, but
    for those whose stretch is a single place: the letters that can stand there bound them."""
    lengths = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("m")
    members = words.select("word", "n", lengths).selectExpr("*", "0 AS a", "m AS b")
    done = None
    while True:
        members = stored(_halved(members), "spelling-members")
        large = (F.col("size") > tile_words) & (F.col("b") - F.col("a") > 1)
        sizes = members.groupBy("key", "a", "b").agg(F.count("*").alias("size")).where("size > 1")
        sizes = stored(sizes.select("key", large.alias("large")), "spelling-groups")
        ready = members.join(sizes.where("NOT large").select("key"), "key")
        done = ready if done is None else done.unionByName(ready)
        if not sizes.where("large").take(1):
            return done
        members = members.join(sizes.where("large").select("key"), "key").drop("key")


def code_points(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """One row of code points per word, padded with zeros behind it, or before it with ``right``."""
    made = np.zeros((len(words), width), np.uint32)
    for row, word in zip(made, words):
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        row[width - len(points) if right else 0 : width if right else len(points)] = points
    return made


def _shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of ``left`` [group, word, column] equals each row of ``right``."""
    same = left[:, :, None, :] == right[:, None, :, :]
    return np.where(same.all(-1), same.shape[-1], same.argmin(-1))


def near(words: list[str], groups: int, m: int, a: int, b: int, tile_bytes: int = TILE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(near words, first of them or -1) of every word. ``words`` are ``groups`` groups of equal size, one after another,
    whose members have m or m + 1 code points and differ in the stretch [a, b) only. Tiles are blocks of rows against
    blocks of columns of as many groups as ``tile_bytes`` allows."""
    size, width = len(words) // groups, m + 1
    shape = (groups, size, width)
    heads = code_points(words, width).reshape(shape)
    tails = code_points(words, width, right=True)[:, ::-1].reshape(shape)
    lengths = np.fromiter(map(len, words), np.int64, len(words)).reshape(groups, size)
    count, first = np.zeros((groups, size), np.int64), np.full((groups, size), -1)
    side = max(1, min(size, int((tile_bytes / width) ** 0.5)))
    some = max(1, int(tile_bytes / (width * side * side)))
    for g in range(0, groups, some):
        at = slice(g, g + some)
        for i in range(0, size, side):
            rows = slice(i, i + side)
            for j in range(0, size, side):
                columns = slice(j, j + side)
                prefix = _shared(heads[at, rows], heads[at, columns])
                suffix = _shared(tails[at, rows], tails[at, columns])
                long = np.maximum(lengths[at, rows, None], lengths[at, None, columns])
                both_long = np.minimum(lengths[at, rows, None], lengths[at, None, columns]) > m
                inside = (prefix >= a) & ((prefix < b) | ((b == m) & (prefix == m)))
                hit = (prefix + suffix >= long - 1) & ~both_long & inside & (prefix < long)
                count[at, rows] += hit.sum(-1)
                found = np.where(hit.any(-1), hit.argmax(-1) + j, -1)
                first[at, rows] = np.where(first[at, rows] < 0, found, first[at, rows])
    return count.ravel(), first.ravel()


def _compared(tiles: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best): per group and word with near words in it their number and the most frequent one, the least of
    equals; a group's words come in that order."""

    def judge(rows: pa.Table) -> pa.RecordBatch | None:
        keys = rows.column("key").to_numpy(zero_copy_only=False)
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        m, a, b = (rows.column(c).to_numpy() for c in "mab")
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(words)))
        kinds = np.stack([size, m[start], a[start], b[start]], 1)
        kind, which = np.unique(kinds, axis=0, return_inverse=True)
        count, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
        for k, (s, *stretch) in enumerate(kind.tolist()):
            firsts = start[which.ravel() == k]
            places = (firsts[:, None] + np.arange(s)).ravel()
            found, first = near([words[p] for p in places.tolist()], len(firsts), *stretch)
            count[places] = found
            best[places] = np.where(first >= 0, np.repeat(firsts, s) + first, -1)
        hit = np.flatnonzero(count)
        if not len(hit):
            return None
        other = best[hit]
        pair = pa.StructArray.from_arrays([pa.array(-n[other]), pa.array([words[o] for o in other.tolist()])], names=["minus", "word"])
        return pa.RecordBatch.from_arrays(
            [pa.array([words[h] for h in hit.tolist()]), pa.array(count[hit]), pair], names=["word", "n_near", "best"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < block_words:
                continue
            rows = pa.Table.from_batches(held)
            keys = rows.column("key")
            at = len(keys) - 1
            while at and keys[at - 1].as_py() == keys[-1].as_py():
                at -= 1
            made = judge(rows.slice(0, at)) if at else None
            if made is not None:
                yield made
            held = rows.slice(at).to_batches()
        if held and (made := judge(pa.Table.from_batches(held))) is not None:
            yield made

    # Within a group the words with most occurrences come first, so that the first near word is the best.
    order = [F.col("key"), F.col("n").desc(), F.col("word")]
    schema = "word string, n_near long, best struct<minus:long,word:string>"
    return tiles.repartition("key").sortWithinPartitions(*order).mapInArrow(run, schema)


def spelling_forms(counts: DataFrame, least: int = LEAST, share: int = 2, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of a table (word, n) with ``least`` or more occurrences.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its most
    frequent near word, the least of equals in code-point order, if that has ``share`` times the word's occurrences or
    more; its root is where following the forms ends. Every word, however common its parts, meets all near words.
    An empty table gives an empty one.
    """
    if share < 2:
        raise ValueError("forms must be more frequent than their words, or following them may not end")
    words = stored(counts.where(F.col("n") >= least).select("word", "n"), "spelling-words")
    met = _compared(_tiles(words, tile_words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    known = words.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.expr(f"if(-best.minus >= {share} * n, best.word, null)").alias("form"),
        F.expr(f"if(-best.minus >= {share} * n, -best.minus, null)").alias("form_n"),
    )
    known = stored(known, "spelling-known")
    # Each round doubles the distance; occurrences double with each step, so a chain has at most 63.
    roots = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        roots = stored(roots, "spelling-roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(further, "root")
        if not moved.take(1):
            break
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damage: int | None = DAMAGE,
                      shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``spelling_forms`` of all words of ``docs`` (``word_counts``). Null and empty texts have no words; repeated rows and
    ids count each; very long words are words as any. Other columns are not read."""
    return spelling_forms(word_counts(docs, id_column, text_column, damage, shortest), least)
