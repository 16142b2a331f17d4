"""Near-duplicate groups: one-permutation MinHash with optimal densification, banded buckets, star-shaped edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions.stem import flat_values
from pairlab.llm.arrow import batch_of, sized_filter, map_batches, passes, repeated, stored, whole_text
from pairlab.llm.components import components
from pairlab.llm.words import hashed_words, mix, rolling

BANDS = 40
ROWS = 5
HUBS = 3
SLICE_BYTES = 2 << 20
_PROBES = mix(np.arange(1, 64 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(64, BANDS * ROWS)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's word hashes; a shorter text is one shingle, a text without words
    none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(rolling(words, min(width, len(words))) + np.uint64(min(width, len(words)) == width))


def text_key(words: np.ndarray) -> bytes:
    """128-bit digest of a word sequence."""
    return xxhash.xxh3_128_digest(words.tobytes())


def signature(found: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """One-permutation MinHash: the least hash in each bin. An empty bin asks the bins that a hash of its own number
    and of the attempt names, until one of them is filled; equal bins ask in equal order, so they borrow alike."""
    hashes = np.sort(mix(found))
    # Bins rise with the hashes, so the first hash of a bin is its least.
    which = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(which, np.arange(bins + 1))
    filled = first[1:] > first[:-1]
    least = np.append(hashes, np.uint64(0))[first[:-1]]
    made = least.copy()
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        probes = _PROBES[attempt, empty] if attempt < len(_PROBES) else mix(empty.astype(np.uint64) + np.uint64(attempt << 20))
        source = (probes % np.uint64(bins)).astype(np.int64)
        good = filled[source]
        made[empty[good]] = least[source[good]]
        empty = empty[~good]
        attempt += 1
    return made


def _sets(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """(id, n_shingles, key, bands): key is a 128-bit digest of the word sequence, null for a text without words."""
    kind = docs.schema[id_column].dataType.simpleString()
    fields = {"n_shingles": pa.int64(), "key": pa.binary(), "bands": pa.list_(pa.int64())}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, bands = [], [], []
        values, offsets = hashed_words(batch.column(1), lower=True)
        for words in np.split(values, offsets[1:-1]):
            found = shingles(words, width)
            sizes.append(len(found))
            if not len(found):
                keys.append(None)
                bands.append([])
                continue
            keys.append(text_key(words))
            rows = signature(found).reshape(BANDS, ROWS)
            total = np.arange(BANDS, dtype=np.uint64)
            for k in range(ROWS):
                total = mix(total * np.uint64(31) + rows[:, k])
            bands.append(total.view(np.int64))
        rest = batch_of(fields, sizes, keys, bands)
        return pa.RecordBatch.from_arrays([batch.column(0), *rest.columns], names=["id", *fields])

    return map_batches(
        docs.select(id_column, whole_text(text_column).alias("text")),
        work,
        f"id {kind}, n_shingles long, key binary, bands array<long>",
        SLICE_BYTES,
    )


def _sets_of(docs: DataFrame, id_column: str, text_column: str, wanted: DataFrame, width: int) -> DataFrame:
    """(key, items) of the wanted (key, least id) rows: the whole shingle set, once per key.

    The filter knows key and id, so of many copies of a text one is sent on; what passes by chance goes in the join. Rows
    of a key have equal sets: any of them will do."""
    wanted = stored(wanted.withColumn("place", _place("key").bitwiseXOR(F.xxhash64("least"))), "wanted-keys")
    shared = docs.sparkSession.sparkContext.broadcast(sized_filter(wanted, "place"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        values, offsets = hashed_words(batch.column(1), lower=True)
        words = np.split(values, offsets[1:-1])
        keys = [text_key(w) for w in words]
        places = np.array([int.from_bytes(k[:7], "big") for k in keys], np.int64) ^ batch.column(0).to_numpy()
        keep = np.flatnonzero(passes(shared.value, places))
        if not len(keep):
            return None
        found = [shingles(words[k], width).view(np.int64) for k in keep.tolist()]
        ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
        items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).take(pa.array(keep)), items], names=["key", "items"])

    texts = docs.select(F.xxhash64(id_column).alias("id"), whole_text(text_column).alias("text"))
    found = map_batches(texts, work, "key binary, items array<long>", SLICE_BYTES)
    # Both by key alone: the whole sets are dealt out once.
    return found.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


def _place(key: str) -> Column:
    """The first 56 bits of a binary key as a number."""
    return F.conv(F.substring(F.hex(key), 1, 14), 16, 10).cast("long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b, ...) whose full sets are alike enough."""
    first = sets.select(F.col("key").alias("a"), F.col("items").alias("a_items"))
    second = sets.select(F.col("key").alias("b"), F.col("items").alias("b_items"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    judged = pairs.join(second, "b").join(first, "a").withColumn("both", both)
    alike = F.expr(f"100L * both >= {percent}L * (size(a_items) + size(b_items) - both)")
    return judged.where(alike).select(pairs.columns)


def _joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The (key, root) table after further links (a_root, b_root) between its components."""
    further = components(links, "a_root", "b_root").select(F.col("node").alias("root"), F.col("root").alias("upper"))
    return roots.join(further, "root", "left").select("key", F.coalesce("upper", "root").alias("root"))


def _lengths_fit(percent: int) -> str:
    return f"100L * least(a_n, b_n) >= {percent}L * greatest(a_n, b_n)"


def _held(sets: DataFrame, open_keys: np.ndarray, shared_items: np.ndarray | None = None) -> DataFrame:
    """(key, n, items) of the sets whose key passes the one filter, with the items that pass the other; ``n`` counts all."""
    filters = sets.sparkSession.sparkContext.broadcast((open_keys, shared_items))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        keys, items = filters.value
        places = np.array([int.from_bytes(k[:7], "big") for k in batch.column(0).to_pylist()], np.int64)
        batch = batch.filter(pa.array(passes(keys, places)))
        values, offsets = flat_values(batch.column(1))
        offsets = offsets.to_numpy()
        n = pa.array(np.diff(offsets), pa.int32())
        if items is not None:
            keep = passes(items, values.to_numpy())
            offsets, values = np.concatenate([[0], np.cumsum(keep)])[offsets], values.filter(pa.array(keep))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
        return pa.RecordBatch.from_arrays([batch.column(0), n, lists], names=["key", "n", "items"])

    return map_batches(sets.select("key", "items"), work, "key binary, n int, items array<long>")


def _rare_shingles(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(item, key, n, at, alone): the rarest shingles of each set that two linked sets cannot both miss.

    In an order common to all sets, here by frequency among them, two sets of which one has n elements share one of its
    first n - ceil(n * percent / 100) + 1. Shingles of one set alone come first in it and are only counted (``alone``);
    ``at`` is a shingle's place.

    Most shingles are in one set alone: they are counted, but a filter keeps them from being dealt out with their keys.
    Sets that pass the filter of ``keys`` by chance take part; they add candidates at most.
    """
    opened = sized_filter(stored(keys.select(_place("key").alias("place")), "open-keys"), "place")
    counts = _held(sets, opened).select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("df"))
    counts = stored(counts.where("df > 1"), "shared-shingles")
    held = _held(sets, opened, sized_filter(counts, "item")).select("key", "n", F.explode("items").alias("item"))
    # A set's own shingles: its size bounds the list.
    common = F.sort_array(F.collect_list(F.struct("df", "item"))).alias("common")
    ranked = held.join(counts, "item").groupBy("key", "n").agg(common).withColumn("alone", F.expr("n - size(common)"))
    first = F.expr(f"slice(common, 1, greatest(0, n - int(({percent}L * n + 99) div 100) + 1 - alone))")
    return ranked.select("key", "n", "alone", F.posexplode(first).alias("at", "entry")).select(
        F.col("entry.item").alias("item"), "key", "n", (F.col("at") + F.col("alone")).alias("at"), "alone"
    )


def _placed_pairs(left: DataFrame, right: DataFrame, percent: int, once: str = "true") -> DataFrame:
    """Distinct pairs (a, b, a_root, b_root) of rows with a shingle in common that can reach the threshold: lengths fit, and
    what may follow the shared shingle in both sets is enough."""

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("item", F.col("key").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in rows.columns if c not in ("item", "key")])

    enough = f"{100 + percent}L * least(a_n - a_at, b_n - b_at) >= {percent}L * (a_n + b_n)"
    met = side(left, "a").join(side(right, "b"), "item").where(f"a_root <> b_root AND {once} AND {_lengths_fit(percent)} AND {enough}")
    return met.select("a", "b", "a_root", "b_root").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: groups of texts joined by links of Jaccard similarity of
    ``percent`` or more between their sets of ``width``-word shingles (A-Z in lower case).

    Texts with equal words are one node from the start. Nodes meet in the buckets of BANDS bands; in each bucket every
    node is paired with the bucket's HUBS hubs alone, so pairs are at most nodes x BANDS x HUBS. Pairs are confirmed on
    full sets. Nodes of buckets that do not come together whole are keyed again by their rare shingles, of which linked
    sets always share one: under each, every node is paired with one hub, the node with the fewest shingles of its own;
    what is then still apart from its hub is paired with the other components under the same shingle, as far as lengths
    and places allow a link. No pair that shares a bucket and can be a link goes untested. Two texts at the threshold share
    no bucket with probability (1 - 0.8^5)^40, about 1e-7.

    Null and empty texts and texts without words have 0 shingles and only themselves. Rows with equal ids are separate
    rows, joined where their texts are; a null id is never a component's smallest while another one exists. Empty
    tables give empty ones; other columns are not read.
    """
    signed = stored(_sets(docs, id_column, text_column, width), "shingle-sets")
    nodes = signed.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("id").alias("least"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")
    )
    members = stored(
        repeated(nodes.select(F.explode("bands").alias("value"), "key", "n"), "value", ["key"], place="place"), "members"
    )
    known = members.select("key").distinct()
    sets = stored(_sets_of(docs, id_column, text_column, known.join(nodes.select("key", "least"), "key"), width), "sets")

    # Hubs are few and spread over all buckets; each meets the members after it.
    hubs = members.where(F.col("place") < HUBS).select("value", F.col("key").alias("a"), F.col("n").alias("a_n"), F.col("place").alias("at"))
    pairs = members.withColumnsRenamed({"key": "b", "n": "b_n"}).join(hubs, "value").where(f"place > at AND {_lengths_fit(percent)}")
    linked = stored(_confirmed(pairs.select("a", "b").distinct(), sets, percent), "linked")
    found = components(linked).withColumnRenamed("node", "key")
    roots = stored(known.join(found, "key", "left").select("key", F.coalesce("root", "key").alias("root")), "roots")

    opened = members.join(roots, "key").groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    keys = members.join(opened, "value", "left_semi").select("key").distinct()
    rare = stored(_rare_shingles(keys, sets, percent), "rare-shingles")
    for last in (False, True):
        if not rare.take(1):
            break
        rooted = rare.join(roots, "key")
        hub = F.min(F.struct((F.col("alone") / F.col("n")).alias("own"), "key", "n", "at", "root")).alias("hub")
        groups = rooted.groupBy("item").agg(hub, F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        groups = stored(groups.select("item", "hub.key", "hub.n", "hub.at", "hub.root"), "hubs")
        if not last:
            pairs = _placed_pairs(groups, rooted, percent)
        else:
            # Nodes outside their hub's component against all others, each two of them once.
            around = rooted.join(groups.select("item", F.col("root").alias("hub"), F.col("key").alias("tried")), "item")
            pairs = _placed_pairs(around.where("root <> hub"), around.where("key <> tried"), percent, "(b_hub = b_root OR a < b)")
        linked = stored(_confirmed(pairs, sets, percent).select("a_root", "b_root"), "linked")
        roots = stored(_joined_roots(roots, linked), "roots")

    least = nodes.select("key", "least").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = stored(least.join(smallest, "root").select("key", "component_id"), "components")
    return (
        signed.select("id", "n_shingles", "key")
        .join(by_key.where("component_id IS NOT NULL"), "key", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
        .select(
            F.col("id").alias(id_column),
            "n_shingles",
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
