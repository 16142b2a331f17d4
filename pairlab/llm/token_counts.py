"""Exact token counts of a byte-level BPE at every prefix of a text, by dynamic programming.

The last token of the encoding of a prefix is the one token whose left neighbour (the last token of what stands
before it) keeps it under the merge rules; so ``count[i] = count[i - len(token)] + 1``, and one pass from left to right
gives the count at every byte. Words that the tokenizer cuts apart do not influence each other: each distinct word is
worked out once per worker, a text adds up its words.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pairlab.llm.arrow import batch_of, map_batches, whole_text

# The published pattern of this tokenizer's pre-splitting; a fixed value.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHED_WORDS = 600_000
LONG_WORD = 64


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each of the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


class PrefixCounter:
    """Token counts of words at every byte prefix; ``path`` is a tokenizers file of a byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of_symbol = {s: b for b, s in enumerate(byte_symbols())}
        raw = {bytes(of_symbol[c] for c in s): i for s, i in spec["model"]["vocab"].items()}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        joined = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            a, b = (bytes(of_symbol[c] for c in s) for s in (left, right))
            pair = (raw[a], raw[b])
            joined.setdefault(pair, (rank, raw[a + b]))
        self.joined = joined
        for (a, b), (rank, made) in joined.items():
            if made not in self.parts or rank < self.parts[made][0]:
                self.parts[made] = (rank, a, b)
        tokens = {t: i for t, i in raw.items() if len(t) == 1 or i in self.parts}
        # Every ending of a token, with the token's id or -1 where the ending is no token itself.
        self.endings = {t[k:]: tokens.get(t[k:], -1) for t in tokens for k in range(len(t))}
        self.valid: dict[tuple[int, int], bool] = {}
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.split = regex.compile(WORDS)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

    def _keeps(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are: no merge across their border comes before the merges
        that made them. Walks back through both tokens' last merges, the younger one first."""
        known = self.valid.get((left, right))
        if known is not None:
            return known
        a, b, limit, good = left, right, 1 << 60, True
        while True:
            merge = self.joined.get((a, b))
            if merge and merge[0] < limit:
                good = False
                break
            pa_, pb = self.parts.get(a), self.parts.get(b)
            if pa_ is None and pb is None:
                break
            # Undo the younger of the two last merges; on the border, an equal rank on the left came first.
            if pb is None or (pa_ is not None and pa_[0] > pb[0]):
                limit, a = pa_[0], pa_[2]
                merge = self.joined.get((a, b))
                if merge and merge[0] < limit:
                    good = False
                    break
            else:
                limit, b = pb[0] + 1, pb[1]
                merge = self.joined.get((a, b))
                if merge and merge[0] < limit:
                    good = False
                    break
        if len(self.valid) > CACHED_WORDS:
            self.valid.clear()
        self.valid[(left, right)] = good
        return good

    def extend(self, word: bytes, counts: list[int], last: list[int], done: int) -> None:
        """Fill counts and last for ``word[:i]``, i from done + 1 to its length, given those up to done."""
        ending, keeps, known = self.endings.get, self._keeps, self.valid.get
        del counts[done + 1 :], last[done + 1 :]
        for end in range(done + 1, len(word) + 1):
            ways = []
            for start in range(end - 1, -1, -1):
                token = ending(word[start:end])
                if token is None:
                    break
                if token >= 0:
                    ways.append((start, token))
            for start, token in reversed(ways):
                left = last[start]
                if left >= 0:
                    good = known((left, token))
                    if not (keeps(left, token) if good is None else good):
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                break
            else:
                raise ValueError(f"no token ends at byte {end} of {word[:80]!r}")

    def prefixes(self, word: bytes) -> list[int]:
        """Token count of ``word[:i]`` for every i from 0 to its length."""
        counts = [0]
        self.extend(word, counts, [-1], 0)
        return counts

    def learn(self, words: set[str]) -> None:
        """Count new words in sorted order, so that each goes on from the prefix it shares with the one before."""
        counts, last, before = [0], [-1], b""
        for word in sorted(w.encode() for w in words):
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            self.extend(word, counts, last, same)
            self.words[word.decode()] = counts[-1]
            before = word

    def count_word(self, word: str) -> int:
        found = self.words.get(word)
        return self.prefixes(word.encode())[-1] if found is None else found

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens in order; they concatenate to the text."""
        if not any(s in text for s in self.specials):
            return self.split.findall(text)
        return [
            word
            for k, part in enumerate(self.cut.split(text))
            for word in ((part,) if k % 2 else self.split.findall(part))
        ]

    def count_all(self, texts: list[str]) -> list[int]:
        """A word never holds a space after another character, so a text is the sum of its space-separated chunks,
        each with its space. Only where white space stands on both sides of a space, or with special tokens, does the
        cut depend on more; such texts are counted word by word."""
        if len(self.words) > CACHED_WORDS or len(self.chunks) > CACHED_WORDS:
            self.words.clear()
            self.chunks.clear()
        known = self.chunks
        split = [text.split(" ") for text in texts]
        new = set().union(*(chunks[1:] for chunks in split)) - known.keys()
        odd = {c for c in new if not c or c[0].isspace()}
        cut = {c: self.split.findall(" " + c) for c in new - odd}
        self.learn({w for words in cut.values() for w in words if len(w) <= LONG_WORD} - self.words.keys())
        known.update((c, sum(map(self.count_word, words))) for c, words in cut.items())
        totals = []
        for text, chunks in zip(texts, split, strict=True):
            if (odd and not odd.isdisjoint(chunks[1:])) or any(s in text for s in self.specials):
                totals.append(sum(1 if w in self.specials else self.count_word(w) for w in self.pieces(text)))
            else:
                head = sum(map(self.count_word, self.split.findall(chunks[0])))
                totals.append(head + sum(map(known.__getitem__, chunks[1:])))
        return totals

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def fitting_prefix(self, text: str, budgets: list[int]) -> list[int]:
        """For each budget, the number of characters of the longest prefix that ends between words or inside a word
        and whose count is within the budget, from one pass."""
        words = self.pieces(text)
        counts = [1 if w in self.specials else self.count_word(w) for w in words]
        before = [0, *accumulate(counts)]
        places = [0, *accumulate(map(len, words))]
        found = []
        for budget in budgets:
            k = bisect_right(before, budget) - 1
            place = places[k]
            if k < len(words) and words[k] not in self.specials:
                inside = self.prefixes(words[k].encode())
                reached = 0
                for width in accumulate(len(c.encode()) for c in words[k]):
                    if before[k] + inside[width] <= budget:
                        reached += 1
                    else:
                        break
                place += reached
            found.append(place)
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 512,
                 budgets: tuple[int, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fits) per row: ``fits`` maps nothing but holds, for each of ``budgets``, how
    many characters of the text the budget pays for.

    A null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids are kept as they are, one row per input row.
    An empty table gives an empty table; other columns are not read. Texts of any length are taken whole.
    """
    kind = df.schema[id_column].dataType
    fields = {"n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_(), "fits": pa.list_(pa.int64())}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, texts = counter(path), batch.column(1).to_pylist()
        counts = made.count_all(texts)
        fits = [made.fitting_prefix(t, list(budgets)) for t in texts] if budgets else [[]] * len(texts)
        sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
        rest = batch_of(fields, sizes, counts, [c > limit for c in counts], fits)
        return pa.RecordBatch.from_arrays([batch.column(0), *rest.columns], names=[id_column, *fields])

    return map_batches(
        df.select(id_column, whole_text(text_column).alias("text")),
        work,
        f"`{id_column}` {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fits array<long>",
    )
