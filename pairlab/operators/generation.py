"""Batch summarisation with a pluggable predictor, and two bundled baselines that need no model."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.functions import text
from pairlab.functions.arrays import let
from pairlab.operators.cleaning import require_columns

# Generation settings handed to the predictor unless overridden.
GENERATION_DEFAULTS = {
    "max_new_tokens": 128,
    "min_new_tokens": 8,
    "num_beams": 4,
    "length_penalty": 2.0,
    "no_repeat_ngram_size": 3,
    "early_stopping": True,
}

# The instruction each model family expects before a text.
PREFIXES = {
    "t5-small": "summarize: ", "flan-t5-small": "summarize: ", "flan-t5-base": "summarize: ",
    "bart-base": "", "bart-large-cnn": "", "pegasus-xsum": "",
}

Predictor = Callable[..., list[str]]


def summarize_table(
    df: DataFrame,
    predictor_factory: Callable[[], Predictor],
    text_col: str = "article",
    batch_size: int = 8,
    prefix: str = "",
    output_col: str = "generated_summary",
    timing_col: str | None = None,
    **overrides,
) -> DataFrame:
    """Append a summary per row, and with ``timing_col`` where and how long it was made: (task, batch, seconds), a batch's
    seconds in equal parts on its rows (``predictor_seconds`` adds them up).

    ``predictor_factory`` runs once per task, so a model is loaded once and not per batch; the predictor it
    returns maps a list of texts (and the generation settings) to a list of summaries.  Only the text column
    goes to Python; all others stay in the JVM.  The column is marked nondeterministic: Spark then never
    evaluates the predictor twice for one reference.  Write the result before scoring it more than once.
    """
    require_columns(df, text_col)
    settings = {**GENERATION_DEFAULTS, **overrides}

    kinds = [("summary", pa.string()), ("task", pa.int32()), ("batch", pa.int64()), ("seconds", pa.float64())]

    @F.arrow_udf("summary string, task int, batch bigint, seconds double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor, task, number = predictor_factory(), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.to_pylist()
            summaries, numbers, seconds = [], [], []
            for start in range(0, len(texts), batch_size):
                part = texts[start:start + batch_size]
                begin = time.perf_counter()
                summaries.extend(predictor(part, **settings))
                seconds += [(time.perf_counter() - begin) / len(part)] * len(part)
                numbers += [number] * len(part)
                number += 1
            columns = (summaries, [task] * len(texts), numbers, seconds)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], fields=[pa.field(*k) for k in kinds])

    source = text.add_prefix(text.null_to_text(text_col, "nan"), prefix)
    made = df.withColumn("_predicted", predict.asNondeterministic()(source))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (output_col, timing_col)]
    timing = [] if timing_col is None else [F.struct("_predicted.task", "_predicted.batch", "_predicted.seconds").alias(timing_col)]
    return made.select(*kept, F.col("_predicted.summary").alias(output_col), *timing)


def predictor_seconds(df: DataFrame, timing_col: str = "timing") -> DataFrame:
    """(task, num_rows, num_batches, seconds) of a stored table of ``summarize_table`` with timing: the predictor's own
    seconds, without reading, writing and waiting for a free core."""
    timed = df.select(f"{timing_col}.*")
    return timed.groupBy("task").agg(
        F.count("*").alias("num_rows"), F.countDistinct("batch").alias("num_batches"), F.sum("seconds").alias("seconds")
    )


def lead(value: Column | str, k: int = 3, separator: str = " ") -> Column:
    """The first k sentences."""
    return F.array_join(F.slice(text.sentences(value), 1, k), separator)


def summarize_lead(df: DataFrame, k: int = 3, text_col: str = "article", output_col: str = "generated_summary") -> DataFrame:
    """First k sentences: the baseline to score against."""
    return df.withColumn(output_col, lead(text.null_to_text(text_col), k))


def lead_words(df: DataFrame, n: int = 128, text_col: str = "article", output_col: str = "generated_summary") -> DataFrame:
    """First n words, the other form of the baseline."""
    return df.withColumn(output_col, F.array_join(text.first_words(text.null_to_text(text_col), n), " "))


def extractive_predictor(k: int = 3) -> Callable[[], Predictor]:
    """Factory of a deterministic predictor: what ``summarize_extractive`` gives, for callers that want a predictor."""
    letters, ignored = regex.compile(text.LETTERS_ONLY), frozenset(text.STOP_WORDS)

    def summarize(document: str) -> str:
        sentences = list(filter(None, (" ".join(found.split()) for found in regex.findall(text.SENTENCE, document))))
        counted = [[w for w in s.lower().split() if letters.match(w) and w not in ignored] for s in sentences]
        total = Counter(chain.from_iterable(counted))
        means = [sum(map(total.__getitem__, words)) / max(len(words), 1) for words in counted]
        ranked = sorted(range(len(sentences)), key=means.__getitem__, reverse=True)
        return " ".join(sentences[i] for i in sorted(ranked[:k]))

    return lambda: lambda texts, **settings: list(map(summarize, texts))


def _runs(items: Column, field: str, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of each run of equal ``field`` in a sorted array of structs, and of the run's length."""

    def of_starts(s: Column, starts: Column) -> Column:
        def one(start: Column, j: Column) -> Column:
            n = F.coalesce(F.get(starts, j + 1), F.size(s)) - start
            return let(n, lambda n: body(F.slice(s, start + 1, n), n))

        return F.transform(starts, one)

    def of_sorted(s: Column) -> Column:
        start = F.transform(s, lambda x, i: F.when((i == 0) | (x[field] != F.get(s, i - 1)[field]), i))
        return let(F.array_compact(start), lambda starts: of_starts(s, starts))

    return let(F.sort_array(items), of_sorted)


def _best_sentences(found: Column, k: int) -> Column:
    """The k sentences whose words have the highest mean frequency, in their order; ties go to the earlier one."""

    def ranked(counted: Column) -> Column:
        words = F.flatten(F.transform(counted, lambda ws, i: F.transform(ws, lambda w: F.struct(w.alias("word"), i.alias("at")))))
        counts = F.flatten(_runs(words, "word", lambda run, n: F.transform(run, lambda x: F.struct(x["at"].alias("at"), n.alias("n")))))
        # A row of 0 per sentence, so that those without words are there too.
        rows = F.concat(F.transform(counted, lambda ws, i: F.struct(i.alias("at"), F.lit(0).alias("n"))), counts)

        def mean(run: Column, n: Column) -> Column:
            total = F.aggregate(run, F.lit(0).cast("bigint"), lambda t, x: t + x["n"])
            value = F.coalesce(F.try_divide(total.cast("double"), (n - 1).cast("double")), F.lit(0.0))
            return F.struct((-value).alias("mean"), F.get(run, F.lit(0))["at"].alias("at"))

        return F.sort_array(F.transform(F.slice(F.sort_array(_runs(rows, "at", mean)), 1, k), lambda x: x["at"]))

    counted = F.transform(found, lambda s: F.filter(text.words(F.lower(s)), text.is_counted_word))
    return let(let(counted, ranked), lambda best: F.transform(best, lambda i: F.get(found, i)))


def summarize_extractive(
    df: DataFrame, k: int = 3, text_col: str = "article", output_col: str = "generated_summary"
) -> DataFrame:
    """The k sentences whose words are most frequent in the text, in their order.

    Mean word frequency after A. Nenkova and L. Vanderwende, "The impact of frequency on summarization", 2005.
    Ties go to the earlier sentence.  It extracts; it does not write.

    Row-local: words are sorted and counted as an array inside their row, so nothing is exchanged and a task holds one text's
    words at a time, however many texts there are.  A text of any number of sentences costs what sorting its words costs.
    """
    best = let(text.sentences(text.null_to_text(text_col)), lambda found: _best_sentences(found, k))
    return df.withColumn(output_col, F.array_join(best, " "))


def generation_length_stats(preds: DataFrame, pred_col: str = "generated_summary") -> DataFrame:
    """Mean, least and most words of the predictions; no row when there are none."""
    counted = preds.select(text.word_count(text.null_to_text(pred_col)).alias("w"))
    return (
        counted.agg(
            F.count("*").alias("n"),
            F.avg("w").alias("mean_words"),
            F.min("w").alias("min_words"),
            F.max("w").alias("max_words"),
        )
        .where(F.col("n") > 0)
        .drop("n")
    )


def pair_predictions(preds: DataFrame, refs: DataFrame, on: str = "id") -> DataFrame:
    """Bring predictions and references together by key; a distributed table has no row order to rely on."""
    return preds.join(refs, on, "inner")


def comparison(
    df: DataFrame,
    text_col: str = "article",
    summary_col: str = "highlights",
    pred_col: str = "generated_summary",
    id_col: str = "id",
) -> DataFrame:
    """Predictions next to references, the article cut at 300 characters for reading."""
    return df.select(
        id_col,
        text.preview(text.null_to_text(text_col, "nan"), 300).alias("article"),
        text.null_to_text(summary_col, "nan").alias("reference_summary"),
        F.col(pred_col).alias("generated_summary"),
    )
