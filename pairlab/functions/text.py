"""Column expressions over text: whitespace, words, letters, cleaning, digests.

Everything here is a built-in Spark expression, so it runs inside the JVM next to the scan.  The whitespace
class is the Unicode one plus the four ASCII separators ``\\x1c-\\x1f``, which Java's ``\\s`` leaves out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairlab.functions.arrays import let

# The patterns the results depend on.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_BLANK_WHITESPACE = r"(?U)[\s\x1c-\x1f&&[^ ]]"
LEADING_TAG = r"(?iU)^\(CNN\)[\s\x1c-\x1f]*(--)?[\s\x1c-\x1f]*"
DASH_RUN = r"-{2,}"
LETTERS_ONLY = r"^\p{L}+$"
ROUGE_SEPARATORS = r"[^a-z0-9]+"
SENTENCE = r"[^.!?]+[.!?]*"

# The 44 stop words left out of the word and n-gram counts.
STOP_WORDS = (
    "the a an and of to in for on with is are was were be by at as it this that from or has have had but not "
    "will would can could said its his her they he she you your we our i"
).split()

# The field texts a pandas CSV reader takes for null.
NULL_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_to_text(value: Column | str, text: str = "") -> Column:
    """Null as a text: ``""`` for the length profile, ``"nan"`` where words are counted on a cast column."""
    return F.coalesce(as_column(value), F.lit(text))


def null_spelling_to_null(value: Column | str) -> Column:
    column = as_column(value)
    return F.when(~column.isin(NULL_SPELLINGS), column)


def char_count(value: Column | str) -> Column:
    return F.char_length(as_column(value)).cast("bigint")


def blank_separated(value: Column | str, squeezed: bool = False) -> Column:
    """Every whitespace character as a blank; with ``squeezed``, every run of them as one.

    Most texts hold only blanks and line ends, which a plain byte replacement covers; the Unicode pattern runs
    on the rest.
    """
    pattern = NOT_BLANK_WHITESPACE + ("|  " if squeezed else "")
    lines_joined = F.replace(as_column(value), F.lit("\n"), F.lit(" "))
    return let(
        lines_joined, lambda t: F.when(t.rlike(pattern), F.regexp_replace(t, WHITESPACE, " ")).otherwise(t)
    )


def words(value: Column | str) -> Column:
    """Whitespace split; a blank text has no words."""
    return F.array_remove(F.split(blank_separated(value), " "), "")


def word_count(value: Column | str) -> Column:
    return F.size(words(value)).cast("bigint")


def first_words(value: Column | str, n: int) -> Column:
    """The first n words.  The split stops after n + 2 parts, however long the text: one may be the empty part
    before a leading blank, the last is the uncut rest."""
    parts = F.array_remove(F.split(blank_separated(value, squeezed=True), " ", n + 2), "")
    return F.slice(parts, 1, n)


def is_letters(word: Column | str) -> Column:
    return as_column(word).rlike(LETTERS_ONLY)


def is_counted_word(word: Column | str) -> Column:
    """Letters only and not a stop word; expects lower case."""
    return is_letters(word) & ~as_column(word).isin(STOP_WORDS)


def clean_text(value: Column | str, lowercase: bool = False) -> Column:
    """Drop one leading ``(CNN) --`` tag, squeeze dash runs and whitespace runs, trim, optionally lower.

    Each pattern runs only on texts that a cheap test lets through.
    """

    def untagged(t: Column) -> Column:
        return F.when(F.upper(F.substring(t, 1, 5)) == "(CNN)", F.regexp_replace(t, LEADING_TAG, "")).otherwise(t)

    def undashed(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("--")), F.regexp_replace(t, DASH_RUN, "-")).otherwise(t)

    cleaned = let(untagged(as_column(value)), lambda t: F.trim(blank_separated(undashed(t), squeezed=True)))
    return F.lower(cleaned) if lowercase else cleaned


def preview(value: Column | str, n: int) -> Column:
    return F.substring(as_column(value), 1, n)


def add_prefix(value: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), as_column(value))


def sentences(value: Column | str) -> Column:
    """Runs of text up to and including ``.``, ``!`` or ``?``, whitespace squeezed and trimmed, blanks left out."""
    found = F.regexp_extract_all(blank_separated(value, squeezed=True), F.lit(SENTENCE), F.lit(0))
    return F.array_remove(F.transform(found, lambda s: F.trim(s)), "")


def rouge_tokens(value: Column | str, separators: str = ROUGE_SEPARATORS) -> Column:
    """Lower-case runs of ``a-z`` and ``0-9``; every other character separates.

    Another pattern of separators, such as one that keeps all letters, suits other languages.  Line ends separate
    under any pattern, so scores by line and by text see the same tokens.
    """
    return F.array_remove(F.split(F.lower(as_column(value)), rf"(?:{separators})|\n"), "")


def file_stem(name: Column | str) -> Column:
    return F.regexp_replace(as_column(name), r"\.[^.]*$", "")


def text_digest(value: Column | str) -> Column:
    """32 bytes that stand for a text in a shuffle; null has a digest of its own, so null equals null."""
    return F.coalesce(F.unhex(F.sha2(as_column(value), 256)), F.lit(bytearray(32)))


def joint_digest(left: Column | str, right: Column | str) -> Column:
    """Digest of two digests.  Both are 32 bytes wide, so gluing them together is unambiguous."""
    return F.unhex(F.sha2(F.concat(as_column(left), as_column(right)), 256))
