"""Verdicts on URLs: rules for hosts and paths first, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairlab.llm.arrow import batch_of, flat_bytes, map_batches, whole_text
from pairlab.llm.words import LOWER

# Terms that tell by themselves what a page is, and terms that only do so together with others.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "porno", "roulette", "spam", "viagra", "xxx")
SOFT = (
    "ads", "babes", "bet", "bets", "bonus", "cam", "cheap", "crack", "dating", "deal", "download", "farm", "free", "hot",
    "jackpot", "keygen", "loan", "lottery", "nude", "pharmacy", "pills", "poker", "replica", "sex", "slots", "torrent",
    "track", "warez", "win",
)
DISTINCT_SOFT = 2

Rule = tuple[str, str, str]


class Automaton:
    """Aho-Corasick automaton over bytes: for each state and class of byte the next state, and the terms that end there."""

    def __init__(self, terms: Sequence[bytes]):
        self.terms = list(dict.fromkeys(terms))
        if not all(self.terms):
            raise ValueError("a term is empty")
        letters = sorted(set(b"".join(self.terms)))
        # Class 0 is every byte that no term has.
        self.classes = np.zeros(256, np.int32)
        self.classes[letters] = np.arange(1, len(letters) + 1)
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for number, term in enumerate(self.terms):
            state = 0
            for letter in self.classes[list(term)].tolist():
                if letter not in children[state]:
                    children[state][letter] = len(children)
                    children.append({})
                    ends.append([])
                state = children[state][letter]
            ends[state].append(number)
        # Breadth first: the failure state of a node is known, and its row complete, before its children need it.
        self.next = np.zeros((len(children), len(letters) + 1), np.int32)
        fail, queue = [0] * len(children), [0]
        for state in queue:
            row = self.next[fail[state]].copy() if state else self.next[0]
            for letter, child in children[state].items():
                fail[child] = int(row[letter]) if state else 0
                row[letter] = child
                queue.append(child)
            self.next[state] = row
            ends[state] = ends[state] + (ends[fail[state]] if state else [])
        self.ends = ends
        self.final = np.array([bool(e) for e in ends])

    def scan(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, end, term) of all hits in texts given as one array of bytes. All texts advance by one byte at a time, the
        longest first, so that those which have ended fall away at the end."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths, starts = lengths[order], offsets[:-1][order]
        state, found = np.zeros(len(order), np.int32), []
        for step in range(int(lengths.max(initial=0))):
            alive = int(np.searchsorted(-sorted_lengths, -step, side="left"))
            state = self.next[state[:alive], self.classes[flat[starts[:alive] + step]]]
            hit = np.flatnonzero(self.final[state])
            found += [(int(order[i]), step + 1, number) for i in hit.tolist() for number in self.ends[state[i]]]
        made = np.array(found, np.int64).reshape(-1, 3)
        return made[:, 0], made[:, 1], made[:, 2]


def _word_bytes() -> np.ndarray:
    """Bytes that a term must not touch on either side: letters, digits and all of other scripts."""
    made = np.zeros(256, bool)
    made[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)]] = True
    return made


def term_hits(automaton: Automaton, urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(url, term), each pair once, of the terms that stand in the lower-cased urls between boundaries."""
    flat, offsets = flat_bytes(urls)
    flat = np.frombuffer(flat.tobytes().translate(LOWER), np.uint8)
    row, end, term = automaton.scan(flat, offsets)
    start = end - np.array([len(t) for t in automaton.terms] or [0])[term]
    word = np.append(_word_bytes()[flat], False)
    before = np.where(start > 0, word[offsets[row] + start - 1], False)
    after = np.where(end < np.diff(offsets)[row], word[offsets[row] + end], False)
    pairs = np.unique(np.stack([row, term], 1)[~before & ~after], axis=0)
    return pairs[:, 0], pairs[:, 1]


def host_and_path(url: str) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    scheme, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    for sign in "#?":
        rest = rest.partition(sign)[0]
    host, slash, path = rest.partition("/")
    return host.encode().translate(LOWER).decode(), slash + path


class Rules:
    """Rules by host. A url asks once for each of its host's suffixes, however many rules there are."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"a rule can allow or block, not {verdict!r}")
            self.by_host.setdefault(host, []).append((path, verdict))
        for paths in self.by_host.values():
            paths.sort(key=lambda r: (-len(r[0]), r[1] != "block"))

    def best(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits: most characters of host and path together, the longer host and
        then ``block`` among equals."""
        found, length, suffix = None, -1, host
        while suffix:
            for own, verdict in self.by_host.get(suffix, ()):
                if path.startswith(own):
                    if len(suffix) + len(own) > length:
                        found, length = (suffix + own, verdict), len(suffix) + len(own)
                    break
            suffix = suffix.partition(".")[2]
        return found


def judge(pages: DataFrame, rules: Sequence[Rule], strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
          distinct_soft: int = DISTINCT_SOFT, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, n_strict, n_soft) per row.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains where the url's path starts with the
    rule's, and the longest one decides. Without a rule the vocabulary does: one strict term or ``distinct_soft`` different
    soft ones anywhere in the url block it. A term counts where no letter or digit touches it; upper and lower case
    are one (A-Z). Rules and terms are the caller's lists, sent to every task.

    A null or empty url, and one without ``://``, has an empty host and path, which no rule fits; the terms in it count
    (a null url has none). Null and repeated ids are kept, one row per input row; an empty table gives an empty table;
    other columns are not read. A url is one row's work, whatever its length.
    """
    kind = pages.schema[id_column].dataType.simpleString()
    fields = {"host": pa.string(), "path": pa.string(), "rule": pa.string(), "verdict": pa.string(),
              "n_strict": pa.int64(), "n_soft": pa.int64()}
    automaton = Automaton([t.encode().translate(LOWER) for t in [*strict, *soft]])
    known, n_hard = Rules(rules), len(dict.fromkeys(t.encode().translate(LOWER) for t in strict))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        urls = batch.column(1)
        row, term = term_hits(automaton, urls)
        hard = np.bincount(row[term < n_hard], minlength=len(urls)).tolist()
        mild = np.bincount(row[term >= n_hard], minlength=len(urls)).tolist()
        rows = []
        for url, h, m in zip(urls.to_pylist(), hard, mild, strict=True):
            host, path = host_and_path(url)
            rule, verdict = known.best(host, path) or (None, "block" if h or m >= distinct_soft else "allow")
            rows.append((host, path, rule, verdict, h, m))
        rest = batch_of(fields, *(list(c) for c in zip(*rows, strict=True)))
        return pa.RecordBatch.from_arrays([batch.column(0), *rest.columns], names=[id_column, *fields])

    return map_batches(
        pages.select(id_column, whole_text(url_column).alias("url")), work,
        f"`{id_column}` {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long",
    )
