"""Quality scores: random-indexing word vectors, pooled per document, under a small calibrated network."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import give_back, parts, whole_text
from pairlab.llm.words import claim, split_words

WORD_BUCKETS = 4096
FORM_BUCKETS = 512
DIMENSIONS = 64
NONZEROS = 4
SLICE_BYTES = 2 << 20
_TAIL = re.compile(r"[^\w]+$")
_rng = np.random.default_rng(20)


def _index_vectors(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse ternary index vectors: NONZEROS different places and the +1 or -1 at each."""
    places, signs = np.zeros((n, NONZEROS), np.int64), np.zeros((n, NONZEROS))
    for k in range(n):
        places[k] = _rng.choice(DIMENSIONS, NONZEROS, replace=False)
        signs[k] = _rng.choice((-1, 1), NONZEROS)
    return places, signs


WORD_INDEX = _index_vectors(WORD_BUCKETS)
FORM_INDEX = _index_vectors(2 * FORM_BUCKETS)
FORM_VECTORS = np.zeros((2 * FORM_BUCKETS, DIMENSIONS), np.float32)
np.put_along_axis(FORM_VECTORS, FORM_INDEX[0], FORM_INDEX[1].astype(np.float32), axis=1)


def _code(word: str) -> int:
    """(bucket of the word's lower-case core) * FORM_BUCKETS + (bucket of its form: letter case and end marks)."""
    tail = "" if word.isalnum() else word[-1] if word[:-1].isalnum() and word[-1] != "_" else _TAIL.search(word)
    tail = tail if isinstance(tail, str) else tail[0] if tail else ""
    core = word[: len(word) - len(tail)]
    case = "U" if len(core) > 1 and core.isupper() else "T" if core[:1].isupper() else "D" if core.isdigit() else "L"
    return xxhash.xxh3_64_intdigest(core.lower()) % WORD_BUCKETS * FORM_BUCKETS + _form(f"{case if core else '-'}{tail}")


@lru_cache(maxsize=4096)
def _form(marks: str) -> int:
    return xxhash.xxh3_64_intdigest(marks) % FORM_BUCKETS


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, form buckets, n + 1 offsets) in order, of an array of texts without nulls; a word equal to the one
    before it in its text has a form of the upper half. Each distinct word is looked at once, and none is put aside."""
    words, offsets = split_words(texts)
    coded = words.dictionary_encode()
    known = coded.dictionary.to_numpy(zero_copy_only=False)
    codes = np.fromiter(map(_code, known), np.int64, len(known))[coded.indices.to_numpy()]
    form, same = codes % FORM_BUCKETS, np.zeros(len(codes) + 1, bool)
    same[1:-1] = codes[1:] == codes[:-1]
    same[offsets] = False
    return codes // FORM_BUCKETS, form + FORM_BUCKETS * same[:-1], offsets


def word_vectors(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """Context vectors of all word buckets over the whole table: the sum of the index vectors of each word's
    neighbours and form. Tasks add up their rows; sums per bucket are made by Spark; the result has a fixed size
    (WORD_BUCKETS x DIMENSIONS), whatever the corpus."""
    names = [f"v{d}" for d in range(DIMENSIONS)]

    def gather(batches):
        claim()
        total = np.zeros(WORD_BUCKETS * DIMENSIONS)

        def add(rows: np.ndarray, index: tuple[np.ndarray, np.ndarray], vectors: np.ndarray) -> None:
            cells = (rows[:, None] * DIMENSIONS + index[0][vectors]).ravel()
            np.add(total, np.bincount(cells, index[1][vectors].ravel(), len(total)), out=total)

        for whole in batches:
            for batch in parts(whole, SLICE_BYTES):
                word, form, offsets = tokens(batch.column(0))
                if not len(word):
                    continue
                linked = np.ones(len(word) - 1, bool)
                linked[offsets[(offsets > 0) & (offsets < len(word))] - 1] = False
                left, right = word[:-1][linked], word[1:][linked]
                add(left, WORD_INDEX, right)
                add(right, WORD_INDEX, left)
                add(word, FORM_INDEX, form)
        give_back()
        sums = np.rint(total).astype(np.int64).reshape(WORD_BUCKETS, DIMENSIONS)
        seen = np.flatnonzero(sums.any(1))
        columns = [pa.array(seen, pa.int32()), *(pa.array(sums[seen, d]) for d in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    partial = df.select(whole_text(text_column).alias("text")).mapInArrow(
        gather, "bucket int, " + ", ".join(f"{n} long" for n in names)
    )
    summed = partial.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    vectors = np.zeros((WORD_BUCKETS, DIMENSIONS))
    vectors[summed["bucket"].to_numpy()] = summed[names].to_numpy(float)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text the mean word vector, mean form vector and three lengths; zeros for a text without words."""
    words, shapes, offsets = tokens(texts)
    made = np.zeros((len(texts), 2 * DIMENSIONS + 3), np.float32)
    for k in np.flatnonzero(np.diff(offsets)).tolist():
        word, form = words[offsets[k] : offsets[k + 1]], shapes[offsets[k] : offsets[k + 1]]
        seen, n = np.unique(word, return_counts=True)
        forms, m = np.unique(form, return_counts=True)
        a = n.astype(np.float32) @ vectors[seen] / len(word)
        b = m.astype(np.float32) @ FORM_VECTORS[forms] / len(word)
        made[k] = *a, *b, np.linalg.norm(a), len(seen) / len(word), (form >= FORM_BUCKETS).mean()
    return made


@dataclass
class Model:
    """Two dense layers on standardised features, and a temperature."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum((features - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def scores(self, texts: pa.Array) -> np.ndarray:
        features = pooled(texts, self.vectors).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -40, 40)))


def fit(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 40,
        least_steps: int = 0) -> Model:
    """Adam on the log loss with weight decay; every fifth row is kept out of it and sets the temperature. Few rows are gone
    through more often than ``epochs`` times, until ``least_steps`` steps have been made."""
    rng = np.random.default_rng(7)
    width = features.shape[1]
    held = np.arange(len(labels)) % 5 == 0
    x, y = features[~held], labels[~held].astype(float)
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    w1, b1 = rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden)
    w2, b2 = rng.normal(0, hidden**-0.5, hidden), np.zeros(1)
    weights = [w1, b1, w2, b2]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    x = (x - mean) / scale
    per_epoch = max(1, -(-len(x) // 256))
    for _ in range(max(epochs, -(-least_steps // per_epoch)) if len(x) else 0):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            a = x[rows]
            pre = a @ w1 + b1
            h = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -40, 40)))
            d = (p - y[rows]) / len(rows)
            dh = np.outer(d, w2) * (pre > 0)
            step += 1
            for k, g in enumerate((a.T @ dh + 1e-4 * w1, dh.sum(0), h.T @ d + 1e-4 * w2, np.array([d.sum()]))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= 2e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, w1, b1, w2, float(b2[0]), 1.0)
    if held.any():
        raw, true = model.logits(features[held]), labels[held]
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.logaddexp(0, np.where(true == 1, -raw, raw) / t).mean() for t in tried]
        model.temperature = float(tried[int(np.argmin(loss))])
    return model


def held_out(id_column: str):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", max_train_rows: int = 20_000) -> Model:
    """A model from word vectors of all of ``docs`` and at most ``max_train_rows`` labelled rows: those of lowest hash of
    the id, held-out rows and null labels excepted. An id counts once: its least label, and of its texts that of least
    digest. Without labelled rows of both kinds the scores tell nothing, but exist."""
    vectors = word_vectors(docs, text_column)
    chosen = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
        .select(F.col(id_column).alias("_llm_id"), F.col(label_column).cast("int").alias("_llm_label"))
        .groupBy("_llm_id")
        .agg(F.min("_llm_label").alias("_llm_label"))
        .withColumn("_llm_order", F.xxhash64("_llm_id"))
        .orderBy("_llm_order", "_llm_id")
        .limit(max_train_rows)
    )
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vectors)  # WORD_BUCKETS x DIMENSIONS floats: 1 MB

    def features(batches):
        claim()
        for whole in batches:
            for batch in parts(whole, SLICE_BYTES):
                # One value per row: as lists of numbers, they would be millions of Python objects in the driver.
                rows = [row.tobytes() for row in pooled(batch.column("_llm_text"), shared.value)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_llm_order"), batch.column("_llm_label"), pa.array(rows, pa.binary())],
                    names=["place", "label", "features"],
                )

    found = docs.select(F.col(id_column).alias("_llm_id"), whole_text(text_column).alias("_llm_text")).join(
        F.broadcast(chosen), "_llm_id"  # at most max_train_rows
    )
    rows = (
        found.groupBy("_llm_id", "_llm_label", "_llm_order")
        .agg(F.min(F.struct(F.xxhash64("_llm_text"), "_llm_text")).alias("_llm_least"))
        .select("_llm_order", "_llm_label", F.col("_llm_least._llm_text").alias("_llm_text"))
        .mapInArrow(features, "place long, label int, features binary")
        .toPandas()
    )
    if rows.empty:
        return fit(np.zeros((0, 2 * DIMENSIONS + 3)), np.zeros(0), vectors)
    found = np.frombuffer(b"".join(rows["features"]), np.float32).reshape(len(rows), -1).astype(float)
    order = np.lexsort((rows["label"].to_numpy(), *found.T[:2], rows["place"].to_numpy()))
    return fit(found[order], rows["label"].to_numpy()[order], vectors)


def with_score(df: DataFrame, model: Model, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """All columns and the score of each row's whole text (null: empty). A column of the score's name is replaced."""
    df = df.drop(score_column)
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed size
    at = df.columns.index(text_column)

    def run(batches):
        claim()
        for whole in batches:
            for batch in parts(whole, SLICE_BYTES):
                scores = shared.value.scores(batch.column(at).cast(pa.string()).fill_null(""))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_column]
                )
        give_back()

    schema = df.select("*", F.lit(0.0).alias(score_column)).schema
    return df.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             threshold: float = 0.7, max_train_rows: int = 20_000) -> DataFrame:
    """(id, held_out, score, predicted) per row: the score is the probability of label 1.

    Word vectors are gathered over the whole table. Null and empty texts get the score of a text without words; null
    ids are never held out; repeated rows get equal scores, one row per input row. An empty table gives an empty
    table. Labels without a document, null labels and other columns play no part.
    """
    model = train(docs, labels, id_column, text_column, max_train_rows=max_train_rows)
    scored = with_score(docs.select(id_column, whole_text(text_column).alias("_llm_text")), model, "_llm_text", "score")
    return scored.select(
        id_column,
        held_out(id_column).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
