"""Byte-pair encoding with word ends: encoding by a priority queue of merges over a linked list, and decoding."""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pairlab.llm.arrow import batch_of, map_batches, whole_text
from pairlab.llm.token_counts import byte_symbols
from pairlab.llm.words import Recent, claim

# The published pattern of this tokenizer's words; a fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
CACHED_WORDS = 300_000
SLICE_BYTES = 2 << 20


class WordBpe:
    """Encoder and decoder for a tokenizers file of a lower-casing BPE whose last symbols carry a word end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.strings = {i: s for s, i in self.vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.specials.items()}
        self.end = model["end_of_word_suffix"]
        # A pair of symbols, as one number, to the rank of its merge and the symbol it makes.
        self.pairs: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = self.vocab[left] << 16 | self.vocab[right]
            self.pairs.setdefault(pair, rank << 16 | self.vocab[left + right])
        if len(self.vocab) + 512 > 1 << 16:
            raise ValueError("symbols are numbered in 16 bits")
        # Bytes as symbols, inside a word and at its end; those that the vocabulary lacks get numbers beyond it.
        symbols = byte_symbols()
        self.unknown = max(self.vocab.values()) + 1
        self.inside = [self.vocab.get(symbols[b], self.unknown + b) for b in range(256)]
        self.final = [self.vocab.get(symbols[b] + self.end, self.unknown + 256 + b) for b in range(256)]
        self.split = regex.compile(WORDS)
        self.sign = commonprefix(list(self.specials))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        self.words = Recent(self._word, CACHED_WORDS)

    def merge(self, symbols: list[int]) -> list[int]:
        """Join the pair of lowest rank, leftmost first, until no pair has a rank.

        Symbols form a doubly linked list; the queue holds rank, made symbol and place of the left symbol as one number. An
        entry is stale, and skipped, when the pair at its place is no longer the one it was made for.
        """
        n, pairs = len(symbols), self.pairs
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [
            found << 32 | k for k in range(n - 1) if (found := pairs.get(symbols[k] << 16 | symbols[k + 1])) is not None
        ]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            k, found = entry & 0xFFFFFFFF, entry >> 32
            after = right[k]
            if after < 0 or pairs.get(symbols[k] << 16 | symbols[after]) != found:
                continue
            symbols[k] = joined = found & 0xFFFF
            symbols[after] = -1
            right[k] = beyond = right[after]
            right[after] = -1
            if beyond >= 0:
                left[beyond] = k
                found = pairs.get(joined << 16 | symbols[beyond])
                if found is not None:
                    heappush(queue, found << 32 | k)
            before = left[k]
            if before >= 0:
                found = pairs.get(symbols[before] << 16 | joined)
                if found is not None:
                    heappush(queue, found << 32 | before)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        """The ids in 16 bits each: a seventh of what a tuple of them takes."""
        raw, inside = word.encode(), self.inside
        symbols = [inside[b] for b in raw]
        symbols[-1] = self.final[raw[-1]]
        return array("H", [s for s in self.merge(symbols) if s < self.unknown]).tobytes()

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text without special tokens. The lower case is that of each character alone: a capital sigma at a
        word's end is no exception."""
        normal = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
        return [i for word in self.split.findall(normal.lower()) for i in memoryview(self.words[word]).cast("H")]

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens in it become their ids."""
        if self.sign not in text or not any(s in text for s in self.specials):
            return self.encode_part(text)
        return [
            i
            for k, part in enumerate(self.cut.split(text))
            for i in ([self.specials[part]] if k % 2 else self.encode_part(part))
        ]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings, one space between tokens; this tokenizer declares no decoder that joins them."""
        return " ".join(self.strings[i] for i in ids)

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        ids = self.encode(chunk)
        return struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.strings.__getitem__, ids)).encode()

    def claim(self) -> None:
        claim(self.words)

    def encode_chunks(self, text: str) -> tuple[bytes, bytes]:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text as UTF-8) of each text of an array without nulls. No
        token crosses a space, so each distinct chunk between spaces is worked out once."""
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        pairs = list(map(self._chunk, coded.dictionary.to_numpy(zero_copy_only=False)))
        ends, places = split.offsets.to_pylist(), coded.indices.to_numpy()
        for k in range(len(texts)):
            own = [pairs[i] for i in places[ends[k] : ends[k + 1]].tolist()]
            yield b"".join([p[0] for p in own]), b" ".join([p[1] for p in own if p[1]])


@lru_cache(maxsize=2)
def codec(path: str) -> WordBpe:
    return WordBpe(path)


def encode(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids binary, decoded string) per row: token ids as little-endian unsigned 32-bit integers, and what decoding
    them gives.

    A null or empty text has no ids and decodes to the empty text. Null and repeated ids are kept, one row per input
    row; an empty table gives an empty table; other columns are not read. Texts are taken whole.
    """
    kind = df.schema[id_column].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = codec(path)
        pairs = list(made.encode_all(batch.column(1)))
        rest = batch_of({"ids": pa.binary(), "decoded": pa.string()}, [p[0] for p in pairs],
                        pa.array([p[1] for p in pairs], pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays([batch.column(0), *rest.columns], names=[id_column, "ids", "decoded"])

    return map_batches(
        df.select(id_column, whole_text(text_column).alias("text")),
        work,
        f"`{id_column}` {kind.simpleString()}, ids binary, decoded string",
        SLICE_BYTES,
        lambda: codec(path).claim(),
    )


def decode(df: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded) of packed ids; null ids decode to the empty text, an id outside the vocabulary raises."""
    kind = df.schema[id_column].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = codec(path)
        texts = [made.decode([i for (i,) in struct.iter_unpack("<I", ids or b"")]) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_column, "decoded"])

    return map_batches(df.select(id_column, ids_column), work, f"`{id_column}` {kind.simpleString()}, decoded string")


def digest(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: ``encode`` reduced to digests where it is made, so that decoded
    texts never leave the worker; with ``keep_ids`` also the ids. Edge cases as for ``encode``."""
    kind = df.schema[id_column].dataType
    fields = {"n_tokens": pa.int64(), "ids": pa.binary(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if not keep_ids:
        del fields["ids"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = codec(path)
        columns: dict[str, list] = {name: [] for name in fields}
        for ids, decoded in made.encode_all(batch.column(1)):
            columns["n_tokens"].append(len(ids) // 4)
            columns["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            columns["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            if keep_ids:
                columns["ids"].append(ids)
        rest = batch_of(fields, *columns.values())
        return pa.RecordBatch.from_arrays([batch.column(0), *rest.columns], names=[id_column, *fields])

    sql = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return map_batches(
        df.select(id_column, whole_text(text_column).alias("text")),
        work,
        ", ".join([f"`{id_column}` {kind.simpleString()}", *(f"{name} {sql[t]}" for name, t in fields.items())]),
        SLICE_BYTES,
        lambda: codec(path).claim(),
    )
