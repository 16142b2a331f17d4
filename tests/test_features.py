import pytest
from pyspark.sql import functions as F

from pairlab.operators import features


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "train", "b a b c", "a b"), (2, "train", "b " * 40, "c"), (3, "test", None, ""), (4, "test", " zz  b\nzz ", "a zz")]
    return spark.createDataFrame(rows, "id long, split string, article string, highlights string")


@pytest.fixture(scope="module")
def vocab(table):
    return features.build_vocab(table, size=3).cache()


def test_vocab(vocab):
    assert [tuple(r) for r in vocab.orderBy("token_id").collect()] == [("b", 3, 44), ("a", 4, 3), ("zz", 5, 3)]


@pytest.fixture(scope="module")
def encoded(table, vocab):
    return features.encode_pairs(table, vocab, 6, 4, prefix="a ")


def test_encoding(encoded):
    got = {r.id: r for r in encoded.collect()}
    assert got[1].input_ids == [4, 3, 4, 3, 2, 1] and got[1].labels == [4, 3, 1, -100]
    assert got[2].input_ids == [4, 3, 3, 3, 3, 1] and got[2].labels == [2, 1, -100, -100]
    assert got[3].input_ids == [4, 2, 1, 0, 0, 0] and got[3].labels == [1, -100, -100, -100]
    assert got[4].input_ids == [4, 5, 3, 5, 1, 0] and got[4].attention_mask == [1, 1, 1, 1, 1, 0]


def test_decoding(encoded, vocab):
    got = {r.id: r.text for r in features.decode_ids(encoded, vocab, "labels").collect()}
    assert got == {1: "a b", 2: "", 3: "", 4: "a zz"}
    inputs = {r.id: r.text for r in features.decode_ids(encoded, vocab, "input_ids").collect()}
    assert inputs[4] == "a zz b zz"


def test_repeated_and_null_ids_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b", "a"), (1, "b", "b"), (None, "a", "")], "id long, article string, highlights string")
    vocab = spark.createDataFrame([("a", 3), ("b", 9)], "token string, token_id long")
    codes = features.encode_pairs(df, vocab, 4, 2)
    got = sorted(((r.id, r.input_ids) for r in codes.collect()), key=str)
    assert got == [(1, [3, 9, 1, 0]), (1, [9, 1, 0, 0]), (None, [3, 1, 0, 0])]
    texts = sorted((r.text for r in features.decode_ids(codes, vocab, "input_ids").collect()))
    assert texts == ["a", "a b", "b"]


def test_the_given_vocabulary_is_the_whole_one(spark):
    words = [f"w{i}" for i in range(32_101)]
    vocab = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "token string, token_id long")
    df = spark.createDataFrame([(1, " ".join(words[-3:]), "")], "id long, article string, highlights string")
    codes = features.encode_pairs(df, vocab, 5, 2)
    assert codes.first().input_ids == [32_101, 32_102, 32_103, 1, 0]
    assert features.decode_ids(codes, vocab, "input_ids").first().text == " ".join(words[-3:])


def test_decode_undoes_encode_for_known_words(spark):
    df = spark.createDataFrame([(1, "x y  z x", "z")], "id long, article string, highlights string")
    vocab = features.build_vocab(df)
    codes = features.encode_pairs(df, vocab, 12, 4)
    assert features.decode_ids(codes, vocab, "input_ids").first().text == "x y z x"


def test_unmask(encoded):
    row = encoded.where("id = 1").select(features.unmask_labels(F.col("labels")).alias("l")).first()
    assert row.l == [4, 3, 1, 0]


def test_truncation_report(table):
    got = {r.split: (r.article_truncated, r.summary_truncated) for r in features.truncation_report(table, 6, 3).collect()}
    assert got == {"train": (0.5, 0.0), "test": (0.0, 0.0)}


def test_masks_agree_with_those_made_from_ids(encoded):
    unmasked = encoded.select(
        "attention_mask", "labels",
        features.attention_mask(F.col("input_ids")).alias("m"),
        features.label_mask(features.unmask_labels(F.col("labels"))).alias("l"),
    )
    assert unmasked.where("m <> attention_mask OR l <> labels").count() == 0
