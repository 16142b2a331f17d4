"""Scans: CSV splits, processed Parquet splits, text folders, and the check of a source folder."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairlab.functions import text
from pairlab.operators.cleaning import require_columns, tag_split, union_splits
from pairlab.sources.scratch import materialize

SPLITS = ("train", "validation", "test")

def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _glob_text(name: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def validate_source(spark: SparkSession, folder: str, expected_files: Sequence[str]) -> DataFrame:
    """(file, path, n_bytes, ok) for every expected name; missing and empty are not ok.

    A file in ``folder`` itself comes before any below it; several below it and none in it have no path and are not ok.
    Only file names and sizes are listed, never contents.
    """
    wanted = "{" + ",".join(_glob_text(name) for name in expected_files) + "}"
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", wanted)
        .load(folder)
        .select(_base_name(F.col("path")).alias("file"), "path", F.col("length").alias("n_bytes"))
    )
    # Depth in the folder tree, least first; with a tie there is no telling which file is meant.
    depth = F.size(F.split("path", "/"))
    by_depth = listed.groupBy("file", depth.alias("depth")).agg(
        F.count("*").alias("n"), F.min("path").alias("path"), F.max("n_bytes").alias("n_bytes")
    )
    nearest = by_depth.groupBy("file").agg(F.min_by(F.struct("n", "path", "n_bytes"), "depth").alias("f"))
    one = F.col("f.n") == 1
    found = nearest.select(
        "file", F.when(one, F.col("f.path")).alias("path"), F.when(one, F.col("f.n_bytes")).alias("n_bytes"),
        (~one).alias("ambiguous"),
    )
    expected = spark.createDataFrame([(name,) for name in expected_files], "file string")
    return expected.join(found, "file", "left").withColumns(
        {"ok": F.coalesce(F.col("n_bytes") > 0, F.lit(False)), "ambiguous": F.coalesce("ambiguous", F.lit(False))}
    )


def require_source(spark: SparkSession, folder: str, expected_files: Sequence[str]) -> DataFrame:
    """The same, raising if anything is missing or empty."""
    verdict = validate_source(spark, folder, expected_files)
    missing = [row.file for row in verdict.where(~F.col("ok")).select("file").toLocalIterator()]
    if missing:
        raise FileNotFoundError(f"Missing or empty under {folder}: {missing}")
    return verdict


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV with a header, quoted multi-line fields and doubled quotes; every column is text.

    The spellings a pandas reader takes for null are null.  A multi-line file cannot be cut, so it is one task:
    convert to Parquet once (``ingest_local``) and work from there.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("nullValue", "")
        .csv(path)
    )
    return raw.select(*[text.null_spelling_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])


MALFORMED = "_malformed"


def read_csv_strict(
    spark: SparkSession, path: str, columns: Sequence[str], quarantine: str, header: bool = True
) -> DataFrame:
    """A CSV of one record a line whose rows must have the declared text columns.

    Lines that do not (too few or too many fields, a quote that is never closed) go to a table (line, path) in the folder
    ``quarantine``, which is written at once from one read of the file; the rows come from that same read.  Files of this
    kind can be cut, so any number of tasks reads them.
    """
    schema = ", ".join([*(f"`{c}` string" for c in columns), f"{MALFORMED} string"])
    raw = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
        .withColumn("_path", F.col("_metadata.file_path"))
    )
    kept = materialize(raw, "csv")
    bad = kept.where(F.col(MALFORMED).isNotNull())
    bad.select(F.col(MALFORMED).alias("line"), F.col("_path").alias("path")).write.mode("overwrite").parquet(quarantine)
    good = kept.where(F.col(MALFORMED).isNull())
    return good.select(*[text.null_spelling_to_null(F.col(f"`{c}`")).alias(c) for c in columns])


def split_files(spark: SparkSession, folder: str, splits: Sequence[str] = SPLITS) -> list[tuple[str, str]]:
    """(split, path) of the split files present."""
    verdict = validate_source(spark, folder, [f"{s}.csv" for s in splits])
    unclear = [row.file for row in verdict.where("ambiguous").toLocalIterator()]
    if unclear:
        raise ValueError(f"several files below {folder} could be meant by {', '.join(unclear)}")
    paths = {row.file: row.path for row in verdict.where(F.col("path").isNotNull()).toLocalIterator()}
    return [(s, paths[f"{s}.csv"]) for s in splits if f"{s}.csv" in paths]


def read_pairs_csv(
    spark: SparkSession,
    folder: str,
    text_col: str = "article",
    summary_col: str = "highlights",
    splits: Sequence[str] = SPLITS,
    require_any: bool = True,
) -> DataFrame:
    """All split files present, tagged with their split and united by column name.

    A missing file is skipped.  With ``require_any`` (profiling) none at all is an error; without it
    (preprocessing) the result is empty.
    """
    present = split_files(spark, folder, splits)
    if not present:
        if require_any:
            raise FileNotFoundError(f"{folder} holds none of {', '.join(splits)} as CSV")
        return spark.createDataFrame([], f"`{text_col}` string, `{summary_col}` string, split string")
    united = union_splits(*[tag_split(read_csv(spark, path), split) for split, path in present])
    return require_columns(united, text_col, summary_col)


def with_id(df: DataFrame) -> DataFrame:
    """Give rows an id in file order.  Store it: the value depends on how the files are read."""
    return df if "id" in df.columns else df.withColumn("id", F.monotonically_increasing_id())


def read_processed(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"nothing to read at {folder}") from error


def read_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """One split of a processed table; only its partition folder is read.  A split of the table that has no rows is an
    empty table with its columns."""
    if split not in SPLITS:
        raise ValueError(f"no split named {split!r}; there are {', '.join(SPLITS)}")
    try:
        return spark.read.option("basePath", folder).parquet(f"{folder}/split={split}")
    except AnalysisException:
        whole = read_processed(spark, folder)
    if "split" not in whole.columns:
        raise FileNotFoundError(f"{folder} is not cut into splits")
    return whole.limit(0)


def read_text_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, text): every ``*.txt`` as one document."""
    return (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
    )
