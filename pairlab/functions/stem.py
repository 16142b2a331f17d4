"""Porter stemming of token arrays, one call per distinct word of an Arrow batch.

Rules: M. F. Porter, "An algorithm for suffix stripping", Program 14(3), 1980, with the small changes that the
scorers in common use make to it (NLTK's default mode): words of one or two letters stay, a few irregular
forms are listed, ``-ies``/``-ied`` after a single letter keep the ``e``, and ``y`` becomes ``i`` only after a
consonant that is not the first letter.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Irregular forms.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix -> replacement, applied when the rest of the word has a measure above 0.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}

# Suffixes dropped when the rest of the word has a measure above 1.
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
]


_SHAPES = str.maketrans({ch: "v" if ch in "aeiou" else "c" for ch in "abcdefghijklmnopqrstuvwxyz0123456789"})


def shape(word: str) -> str:
    """A word as a string of c (consonant) and v (vowel); y is a vowel after a consonant."""
    found = word.translate(_SHAPES)
    if "y" not in word:
        return found
    out = list(found)
    for i, ch in enumerate(word):
        if ch == "y":
            out[i] = "v" if i and out[i - 1] == "c" else "c"
    return "".join(out)


def measure(word: str) -> int:
    """Number of vowel-run/consonant-run pairs."""
    return shape(word).count("vc")


def _ends_cvc(word: str) -> bool:
    s = shape(word)
    return s == "vc" or (s.endswith("cvc") and word[-1] not in "wxy")


def _longest(word: str, suffixes) -> str | None:
    """The longest listed suffix of the word: only that rule may fire."""
    for n in range(min(len(word), 7), 1, -1):
        if word[-n:] in suffixes:
            return word[-n:]
    return None


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        rest = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in shape(rest):
            if rest.endswith(("at", "bl", "iz")):
                return rest + "e"
            if re.search(r"([^aeiou])\1$", rest) and shape(rest)[-1] == "c":
                return rest if rest[-1] in "lsz" else rest[:-1]
            return rest + "e" if measure(rest) == 1 and _ends_cvc(rest) else rest
    return word


def _final_y(word: str) -> str:
    s = shape(word)
    return word[:-1] + "i" if word.endswith("y") and len(word) > 2 and s[-2] == "c" else word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    suffix = _longest(word, STEP_2)
    if suffix is None:
        return word
    rest = word[: -len(suffix)]
    tested = word[:-3] if suffix == "logi" else rest
    return rest + STEP_2[suffix] if measure(tested) > 0 else word


def _third_suffix(word: str) -> str:
    suffix = _longest(word, STEP_3)
    if suffix is None or measure(word[: -len(suffix)]) == 0:
        return word
    return word[: -len(suffix)] + STEP_3[suffix]


def _fourth_suffix(word: str) -> str:
    suffix = _longest(word, STEP_4)
    if suffix is None:
        return word
    rest = word[: -len(suffix)]
    if measure(rest) < 2 or (suffix == "ion" and rest[-1] not in "st"):
        return word
    return rest


def _tidy(word: str) -> str:
    if word.endswith("e"):
        m = measure(word[:-1])
        if m > 1 or (m == 1 and not _ends_cvc(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 18)
def porter_stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past_and_gerund, _final_y, _double_suffix, _third_suffix, _fourth_suffix, _tidy):
        word = step(word)
    return word


def rouge_stem(token: str) -> str:
    """ROUGE stems only tokens longer than three characters."""
    return porter_stem(token) if len(token) > 3 else token


def stem_values(values: pa.Array) -> pa.Array:
    """Stem a flat Arrow string array through its dictionary: each distinct word is stemmed once."""
    encoded = values.dictionary_encode()
    stems = pa.array([None if w is None else rouge_stem(w) for w in encoded.dictionary.to_pylist()], pa.string())
    return stems.take(encoded.indices)


def flat_values(lists: pa.Array) -> tuple[pa.Array, pa.Array]:
    """A list array's values and its offsets counted from 0, whatever slice it was."""
    if len(lists) == 0:
        # The JVM writes no offsets at all for an empty vector.
        return pa.array([], lists.type.value_type), pa.array([0], pa.int32())
    offsets = lists.offsets
    first = offsets[0].as_py()
    values = lists.values.slice(first, offsets[-1].as_py() - first)
    return values, pc.subtract(offsets, pa.scalar(first, offsets.type))


def stem_nested(values: pa.Array) -> pa.Array:
    """Stem strings at whatever list depth they sit."""
    if not pa.types.is_list(values.type):
        return stem_values(values)
    inner, offsets = flat_values(values)
    return pa.ListArray.from_arrays(offsets, stem_nested(inner), mask=values.is_null() if values.null_count else None)


def stem_word(word: Column) -> Column:
    @F.arrow_udf("string")
    def stem(values: pa.Array) -> pa.Array:
        return stem_nested(values)

    return stem(word)


def stem_tokens(tokens: Column) -> Column:
    @F.arrow_udf("array<string>")
    def stem(values: pa.Array) -> pa.Array:
        return stem_nested(values)

    return stem(tokens)


def stem_lines(lines: Column) -> Column:
    """The same for a text kept as an array of token arrays, one per line."""

    @F.arrow_udf("array<array<string>>")
    def stem(values: pa.Array) -> pa.Array:
        return stem_nested(values)

    return stem(lines)
