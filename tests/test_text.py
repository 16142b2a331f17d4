import pytest
from pyspark.sql import functions as F

from pairlab.functions import arrays, text
from pairlab.operators import words

WS_CASES = [
    "a b", "a b", "a\u0085b", "a\x1cb", "a\x1f\x1db", "a​b", "a\tb\n\nc", "", "   ", " lead and trail ",
    "one", "double  blank", "x\r\ny", "　wide　", "a\x0b\x0cb", "line sep par",
]


@pytest.fixture(scope="module")
def ws(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(WS_CASES)], "id int, t string").orderBy("id")


def test_words_split_as_python_does(ws):
    got = [r.w for r in ws.select(text.words("t").alias("w")).collect()]
    assert got == [t.split() for t in WS_CASES]


def test_word_count(ws):
    got = [r.n for r in ws.select(text.word_count("t").alias("n")).collect()]
    assert got == [len(t.split()) for t in WS_CASES]


CLEAN_CASES = WS_CASES + [
    "(CNN) -- Tagged", "(cnn)untagged", "(CNN) --\n spaced", " (CNN) -- blank first", "(CNN) -- (CNN) -- twice",
    "a---b--c-d", "--", "(CNN)", "(Reuters) - kept", "mixed\n\n  runs --- here ", "É(CNN) -- inside",
]


CLEANED = {
    "(CNN) -- Tagged": "Tagged", "(cnn)untagged": "untagged", "(CNN) --\n spaced": "spaced",
    " (CNN) -- blank first": "(CNN) - blank first", "(CNN) -- (CNN) -- twice": "(CNN) - twice", "a---b--c-d": "a-b-c-d",
    "--": "-", "(CNN)": "", "(Reuters) - kept": "(Reuters) - kept", "mixed\n\n  runs --- here ": "mixed runs - here",
    "É(CNN) -- inside": "É(CNN) - inside", "": "", "   ": "", "tab\tand\u00a0nbsp": "tab and nbsp",
}


@pytest.mark.parametrize("lowercase", [False, True])
def test_clean_text(spark, lowercase):
    df = spark.createDataFrame([(t, c) for t, c in CLEANED.items()], "t string, want string")
    for row in df.select("t", "want", text.clean_text("t", lowercase).alias("c")).collect():
        assert row.c == (row.want.lower() if lowercase else row.want), row.t


def test_cleaning_twice_changes_nothing(spark):
    once = [c for c in CLEAN_CASES if not c.lstrip().lower().startswith("(cnn)")]
    df = spark.createDataFrame([(c,) for c in once], "t string")
    twice = df.select(text.clean_text("t").alias("a")).select("a", text.clean_text("a").alias("b"))
    assert twice.where("a <> b").count() == 0


def test_null_rules(spark):
    row = spark.createDataFrame([(None,)], "t string").select(
        text.word_count(text.null_to_text("t")).alias("empty"),
        text.word_count(text.null_to_text("t", "nan")).alias("nan"),
    ).first()
    assert (row.empty, row.nan) == (0, 1)


def test_counted_words(spark):
    cases = ["été word, a1 don't The cat", None, "and of to", "ß Ωmega naïve x_y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "id int, t string").orderBy("id")
    got = [r.w for r in df.select(words.counted_words(text.null_to_text("t", "nan")).alias("w")).collect()]
    assert len(set(text.STOP_WORDS)) == len(text.STOP_WORDS)
    assert got == [["été", "cat"], ["nan"], [], ["ß", "ωmega", "naïve"]]


def test_ngrams_of_short_arrays(spark):
    cases = [[], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, w array<string>").orderBy("id")
    got = [r.g for r in df.select(arrays.ngrams(F.col("w"), 2, 3).alias("g")).collect()]
    assert got == [
        [], [], ["a b"], ["a b", "b c", "a b c"], ["a b", "b c", "c d", "a b c", "b c d"],
    ]


def test_multiset_overlap(spark):
    cases = [
        ([], []), (["a"], []), (["a", "a", "b"], ["a", "b", "b"]), (["a"] * 5 + ["b"], ["a"] * 3),
        (["x", "y"], ["z"]), (["a", "b", "a", "b", "c"], ["b", "a", "b", "a", "a"]),
    ]
    df = spark.createDataFrame([(i, l, r) for i, (l, r) in enumerate(cases)], "id int, l array<string>, r array<string>")
    got = [r.o for r in df.orderBy("id").select(arrays.multiset_overlap(F.col("l"), F.col("r")).alias("o")).collect()]
    assert got == [sum(min(l.count(x), r.count(x)) for x in set(l)) for l, r in cases]


def test_sentences_and_stem_of_file_names(spark):
    row = spark.range(1).select(
        text.sentences(F.lit("One is\n here.  Two!! ... Three? tail")).alias("s"),
        text.file_stem(F.lit("notes.v2.txt")).alias("f"),
    ).first()
    assert row.s == ["One is here.", "Two!!", "...", "Three?", "tail"]
    assert row.f == "notes.v2"


def test_digests(spark):
    rows = [("a", "b"), ("ab", ""), (None, "b"), ("b", None), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = df.select(text.joint_digest(text.text_digest("x"), text.text_digest("y")).alias("k"))
    assert keys.distinct().count() == len(rows)
