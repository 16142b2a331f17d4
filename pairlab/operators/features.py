"""Vocabulary and fixed-width model features: ids, attention masks, labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from pairlab.functions import text
from pairlab.functions.arrays import pad
from pairlab.operators.sampling import top_k
from pairlab.sources.scratch import materialize

# Special ids, the label that losses skip, widths.
PAD, EOS, UNK, FIRST_ID = 0, 1, 2, 3
IGNORED_LABEL = -100
MAX_INPUT_LENGTH, MAX_TARGET_LENGTH = 512, 128

VOCAB_SIZE = 32_000
# Vocabularies of up to so many words are sent to every task; larger ones are joined.
IN_MEMORY = 1_000_000
_ROW = "_pairlab_place"


def build_vocab(
    df: DataFrame, cols: tuple[str, ...] = ("article", "highlights"), size: int | None = VOCAB_SIZE
) -> DataFrame:
    """(token, token_id, n): the ``size`` most frequent words (None: all), ids from 3 in order of (n desc, token).

    Only the limited table is numbered in one task; all words are numbered range by range (``numbered``).
    """
    texts = F.array_compact(F.array(*[F.col(c) for c in cols]))
    words = df.select(F.explode(F.flatten(F.transform(texts, text.words))).alias("token"))
    counts = words.groupBy("token").agg(F.count("*").alias("n"))
    if size is None:
        placed = numbered(counts, [F.desc("n"), F.asc("token")], "_place")
        return placed.select("token", (F.col("_place") + FIRST_ID).alias("token_id"), "n")
    place = F.row_number().over(W.orderBy(F.desc("n"), "token"))
    return top_k(counts, size, "token").select("token", (place + (FIRST_ID - 1)).cast("bigint").alias("token_id"), "n")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows numbered from 0 in an order that tells all of them apart, without one task that sees them all.

    Rows are dealt by range and sorted within their part; a stored column holds part and place, and what the parts before
    hold moves the places up: one number per part.
    """
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumns({"_part": part, name: place})
    sizes = rows.groupBy("_part").agg((F.max(name) + 1).alias("_size"))
    before = F.coalesce(F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    starts = sizes.select("_part", before.alias("_start"))
    return rows.join(starts, "_part").withColumn(name, F.col(name) + F.col("_start")).drop("_at", "_part", "_start")


def _in_memory(vocab: DataFrame, limit: int) -> tuple[DataFrame, pa.Table | None]:
    """The vocabulary stored, and as an Arrow table if it has at most ``limit`` rows."""
    kept = materialize(vocab, "vocab")
    return kept, kept.toArrow() if kept.count() <= limit else None


def _coded(words: Column, vocab: DataFrame, held: pa.Table) -> Column:
    """Arrays of words as arrays of ids; words that the vocabulary lacks are UNK."""
    shared = vocab.sparkSession.sparkContext.broadcast(held)  # at most IN_MEMORY rows

    @F.arrow_udf("array<int>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = shared.value["token"].combine_chunks()
        ids = np.append(shared.value["token_id"].to_numpy(), UNK)
        for lists in batches:
            place = pc.index_in(lists.flatten(), value_set=tokens).fill_null(len(tokens)).to_numpy()
            offsets = np.cumsum(np.concatenate([[0], pc.list_value_length(lists).fill_null(0).to_numpy()]))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[place], pa.int32()))

    return code(words)


def _spelled(ids: Column, vocab: DataFrame, held: pa.Table) -> Column:
    """Arrays of ids as texts; ids that the vocabulary lacks stand for nothing."""
    shared = vocab.sparkSession.sparkContext.broadcast(held)  # at most IN_MEMORY rows

    @F.arrow_udf("string")
    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = shared.value["token"].combine_chunks()
        known = shared.value["token_id"].combine_chunks()
        for lists in batches:
            place = pc.index_in(lists.flatten().cast(known.type), value_set=known)
            words, offsets = place.is_valid().to_numpy(zero_copy_only=False), np.zeros(len(lists) + 1, np.int64)
            np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(), out=offsets[1:])
            kept = np.concatenate([[0], np.cumsum(words)])[offsets]
            texts = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), tokens.take(place.drop_null()))
            yield pc.binary_join(texts, " ")

    return spell(ids)


def _looked_up(df: DataFrame, sides: tuple[str, ...], vocab: DataFrame, given: str, found: Column) -> DataFrame:
    """The array columns ``sides`` with each item replaced by ``found`` of the vocabulary row whose ``given`` equals it.

    Each Arrow batch of rows becomes a stored block: its distinct items, and the rows with places among them instead of
    items. Only the items of the blocks are joined, whose kind is left to the optimizer, and what they stand for goes back
    to their block; rows never meet their words again one by one, and ids may repeat or be null. Items for which ``found``
    is null go.
    """
    others = [c for c in df.columns if c not in sides]
    places = T.ArrayType(T.IntegerType())
    rows_type = T.StructType([*(df.schema[c] for c in others), *(T.StructField(s, places) for s in sides)])
    schema = T.StructType([T.StructField("items", df.schema[sides[0]].dataType), T.StructField("rows", T.ArrayType(rows_type))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(s) for s in sides]
            flat = [x.flatten() for x in lists]
            coded = pa.concat_arrays(flat).dictionary_encode()
            columns, at = [batch.column(c) for c in others], 0
            for values, part in zip(lists, flat):
                offsets = np.cumsum(np.concatenate([[0], pc.list_value_length(values).fill_null(0).to_numpy()]))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), coded.indices.slice(at, len(part)).cast(pa.int32())))
                at += len(part)
            rows = pa.StructArray.from_arrays(columns, names=[*others, *sides])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (coded.dictionary, rows)], names=["items", "rows"]
            )

    blocks = materialize(df.select(*others, *sides).mapInArrow(pack, schema).withColumn(_ROW, F.monotonically_increasing_id()), "blocks")
    cells = blocks.select(_ROW, F.posexplode("items").alias("pos", "item"))
    joined = cells.join(vocab.withColumnRenamed(given, "item"), "item", "left").select(_ROW, F.struct("pos", found.alias("value")).alias("cell"))
    values = joined.groupBy(_ROW).agg(F.transform(F.sort_array(F.collect_list("cell")), lambda x: x["value"]).alias("values"))

    def filled(row: Column, side: str) -> Column:
        return F.filter(F.transform(row[side], lambda i: F.get("values", i)), lambda x: x.isNotNull()).alias(side)

    whole = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in others], *[filled(r, s) for s in sides]))
    return blocks.drop("items").join(values, _ROW, "left").select(F.explode(whole).alias("row")).select("row.*")


def attention_mask(ids: Column) -> Column:
    return F.transform(ids, lambda x: F.when(x == PAD, 0).otherwise(1))


def label_mask(ids: Column) -> Column:
    return F.transform(ids, lambda x: F.when(x == PAD, IGNORED_LABEL).otherwise(x))


def unmask_labels(labels: Column) -> Column:
    return F.transform(labels, lambda x: F.when(x == IGNORED_LABEL, PAD).otherwise(x))


def encode_pairs(
    df: DataFrame,
    vocab: DataFrame,
    max_input_length: int = MAX_INPUT_LENGTH,
    max_target_length: int = MAX_TARGET_LENGTH,
    prefix: str = "",
    text_col: str = "article",
    summary_col: str = "highlights",
    id_col: str = "id",
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """(id, input_ids, attention_mask, labels), each of fixed width: prefix, split, truncate, end mark, pad.

    The given vocabulary is the whole vocabulary: words not in it are unknown.  It is stored once and counted: up to
    ``in_memory`` words it goes to every task and nothing is shuffled; beyond that the kept words are joined with it.
    """
    source = text.add_prefix(text.null_to_text(text_col, "nan"), prefix)
    kept = df.select(
        id_col,
        text.first_words(source, max_input_length - 1).alias("source"),
        text.first_words(text.null_to_text(summary_col, "nan"), max_target_length - 1).alias("target"),
    )
    known, held = _in_memory(vocab.select("token", "token_id"), in_memory)
    if held is not None:
        coded = kept.select(id_col, _coded(F.col("source"), known, held).alias("source"), _coded(F.col("target"), known, held).alias("target"))
    else:
        value = F.coalesce(F.col("token_id").cast("int"), F.lit(UNK))
        coded = _looked_up(kept, ("source", "target"), known, "token", F.when(F.col("item").isNotNull(), value))

    # Real ids are never PAD, so masks follow from lengths and need no look at each id.
    ended = coded.select(
        id_col,
        F.concat("source", F.array(F.lit(EOS))).alias("source"),
        F.concat("target", F.array(F.lit(EOS))).alias("target"),
    )
    return ended.select(
        id_col,
        pad(F.col("source"), max_input_length, PAD).alias("input_ids"),
        pad(F.array_repeat(F.lit(1), F.size("source")), max_input_length, 0).alias("attention_mask"),
        pad(F.col("target"), max_target_length, IGNORED_LABEL).alias("labels"),
    )


def decode_ids(
    df: DataFrame, vocab: DataFrame, ids_col: str = "labels", id_col: str = "id", in_memory: int = IN_MEMORY
) -> DataFrame:
    """(id, text): masked labels and special ids are dropped, the rest become words again; ids that the vocabulary does
    not hold stand for nothing.  The vocabulary goes to every task or is joined, as in ``encode_pairs``."""
    real = F.coalesce(F.filter(F.col(ids_col), lambda x: x >= FIRST_ID), F.array().cast("array<int>"))
    known, held = _in_memory(vocab.select("token", "token_id"), in_memory)
    if held is not None:
        return df.select(id_col, _spelled(real, known, held).alias("text"))
    words = _looked_up(df.select(id_col, real.alias("words")), ("words",), known, "token_id", F.col("token"))
    return words.select(id_col, F.array_join("words", " ").alias("text"))


def truncation_report(
    df: DataFrame,
    max_input_length: int = MAX_INPUT_LENGTH,
    max_target_length: int = MAX_TARGET_LENGTH,
    prefix: str = "",
    text_col: str = "article",
    summary_col: str = "highlights",
    split_col: str = "split",
) -> DataFrame:
    """Share of rows per split that lose words to each width (the end mark takes one place)."""

    def cut(value: Column, width: int) -> Column:
        return F.avg(F.when(text.word_count(value) > width - 1, 1.0).otherwise(0.0))

    source = text.add_prefix(text.null_to_text(text_col, "nan"), prefix)
    return df.groupBy(split_col).agg(
        cut(source, max_input_length).alias("article_truncated"),
        cut(text.null_to_text(summary_col, "nan"), max_target_length).alias("summary_truncated"),
    )
