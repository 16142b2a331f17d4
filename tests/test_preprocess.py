import pytest
from conftest import LONG, plan_of

from pairlab.operators import cleaning, dedup, profile
from pairlab.plans.pairs import pairs
from pairlab.plans.preprocess import preprocess, step_row_counts
from pairlab.streaming.stateless import preprocess_stream


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_drop_na(pairs_small):
    assert ids(cleaning.drop_na(pairs_small)) == [1, 4, 5, 6, 7, 8]


def test_drop_duplicates_per_split_keeps_the_first(pairs_small):
    assert ids(dedup.drop_duplicates(cleaning.drop_na(pairs_small))) == [1, 4, 6, 7, 8]


def test_drop_duplicates_takes_null_for_equal(spark):
    df = spark.createDataFrame([(1, "s", None, "x"), (2, "s", None, "x"), (3, "s", "x", None)],
                               "id long, split string, article string, highlights string")
    assert ids(dedup.drop_duplicates(df)) == [1, 3]


def test_dedup_is_stable_under_repartitioning(pairs_small):
    assert ids(dedup.drop_duplicates(pairs_small.repartition(5))) == ids(dedup.drop_duplicates(pairs_small))


def test_length_bounds_are_inclusive(spark):
    rows = [(1, "a" * 199, "b" * 20), (2, "a" * 200, "b" * 20), (3, "a" * 20000, "b" * 2000),
            (4, "a" * 20001, "b" * 20), (5, "a" * 200, "b" * 19), (6, "a" * 200, "b" * 2001), (7, "é😀" * 100, "b" * 20)]
    df = spark.createDataFrame(rows, "id long, article string, highlights string")
    assert ids(cleaning.length_filter(df)) == [2, 3, 7]


def test_preprocess(pairs_small):
    kept = preprocess(pairs_small)
    assert ids(kept) == [1, 6, 7]
    assert kept.columns == pairs_small.columns
    texts = {r.article for r in kept.collect()}
    assert texts == {LONG.strip()}


def test_preprocess_flags(pairs_small):
    assert ids(preprocess(pairs_small, use_drop_duplicates=False)) == [1, 5, 6, 7]
    # Without null removal a null is cleaned as the text "nan", which is too short.
    assert ids(preprocess(pairs_small, use_drop_na=False)) == [1, 6, 7]
    assert ids(preprocess(pairs_small, min_summary_chars=5, min_article_chars=1)) == [1, 4, 6, 7, 8]


def test_step_row_counts(pairs_small):
    got = {r.step: (r.rows_before, r.rows_after) for r in step_row_counts(pairs_small).collect()}
    assert got == {"drop_na": (8, 6), "drop_duplicates": (6, 5), "text_cleaning": (5, 5), "length_filter": (5, 3)}


def test_step_row_counts_of_nothing(pairs_small):
    got = {r.step: (r.rows_before, r.rows_after) for r in step_row_counts(pairs_small.limit(0)).collect()}
    assert set(got.values()) == {(0, 0)}


# Rows per split after each step at sf0.01: train, validation, test.
STAGES = {"pairs": (800, 100, 100), "drop_na": (743, 94, 94), "drop_duplicates": (707, 93, 94), "length_filter": (623, 81, 78)}


def test_stage_counts_at_sf001(spark):
    table = pairs(spark, "/root/testdata/sf0.01")
    filled = cleaning.drop_na(table)
    got = {"pairs": table, "drop_na": filled, "drop_duplicates": dedup.drop_duplicates(filled), "length_filter": preprocess(table)}
    for name, df in got.items():
        counts = {r.split: r.num_rows for r in profile.split_sizes(df).collect()}
        assert (counts["train"], counts["validation"], counts["test"]) == STAGES[name], name


def test_pairs_equal_after_cleaning_survive(spark):
    cleaned = cleaning.clean_pairs(dedup.drop_duplicates(cleaning.drop_na(pairs(spark, "/root/testdata/sf0.01"))))
    groups = cleaned.groupBy("split", "article", "highlights").count()
    assert groups.selectExpr("sum(count - 1)").first()[0] == 11


def test_each_raw_pair_is_kept_at_most_once(spark):
    table = pairs(spark, "/root/testdata/sf0.001")
    kept = preprocess(table).select("id").join(table, "id")
    assert kept.groupBy("split", "article", "highlights").count().where("count > 1").count() == 0


@pytest.mark.parametrize("made", [dedup.drop_duplicates, preprocess])
def test_only_repeated_rows_move(spark, pairs_small, made):
    """No copy of the table is stored: digests of repeated pairs are. Exchanges carry texts only above the semi join."""
    seen = []
    write = dedup.materialize

    def spy(df, *args):
        seen.append(df)
        return write(df, *args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dedup, "materialize", spy)
        df = made(pairs_small)
    assert [d.columns for d in seen] == [["split", dedup._KEY]]
    for line in plan_of(seen[0]).splitlines():
        assert "Exchange" not in line or ("article" not in line and "highlights" not in line)
    lines = plan_of(df).splitlines()
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert any("LeftSemi" in below for below in lines[k:])


def test_rows_are_told_apart_without_ids(spark):
    rows = [(7, "train", "x", "y"), (7, "train", "x", "y"), (0, "train", "a", "b"), (0, "test", "a", "b"), (1, "train", "a", "b"),
            (None, "test", "n", "m"), (None, "test", "n", "m"), (None, "test", "o", "m")]
    df = spark.createDataFrame(rows, "id long, split string, article string, highlights string")
    kept = sorted((tuple(r) for r in dedup.drop_duplicates(df).collect()), key=str)
    assert kept == sorted({rows[0], rows[2], rows[3], rows[5], rows[7]}, key=str)
    assert dedup.drop_duplicates(df.drop("id")).count() == 5
    assert dedup.drop_duplicates(df.drop("split"), within=()).count() == 4


def test_no_split_column(pairs_small):
    assert ids(preprocess(pairs_small.drop("split"))) == [1, 7]


def test_patterns_run_once_per_text(pairs_small):
    """The length filter sits above the generator that cleans, so cleaning is not repeated inside it."""
    plan = plan_of(preprocess(pairs_small, use_drop_duplicates=False))
    assert plan.index("Filter") < plan.index("Generate inline")
    assert plan.count("regexp_replace") == plan[plan.index("Generate inline"):].count("regexp_replace")


def test_missing_column(pairs_small):
    with pytest.raises(KeyError, match="highlights"):
        preprocess(pairs_small.drop("highlights"))


def test_other_column_names_and_extra_columns(pairs_small):
    renamed = pairs_small.withColumnsRenamed({"article": "body", "highlights": "gist"}).selectExpr("*", "id * 2 AS extra")
    kept = preprocess(renamed, "body", "gist")
    assert kept.columns == renamed.columns and ids(kept) == [1, 6, 7]


def test_stateless_steps_on_a_stream(spark, pairs_small, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    pairs_small.write.parquet(source)
    stream = preprocess_stream(spark.readStream.schema(pairs_small.schema).parquet(source))
    query = (
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert ids(spark.read.parquet(sink)) == [1, 5, 6, 7]
