import pytest
from conftest import plan_of

from pairlab.operators import generation


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"Text number {i}. And more.") for i in range(25)] + [(25, None)]
    return spark.createDataFrame(rows, "id long, article string")


def test_predictor_sees_batches_prefix_and_settings(table):
    def factory():
        def predict(texts, **settings):
            return [f"{len(texts)}|{t}|{settings['num_beams']}|{settings['max_new_tokens']}" for t in texts]
        return predict

    rows = generation.summarize_table(table.coalesce(1), factory, prefix="summarize: ", batch_size=4, num_beams=2).collect()
    got = {r.id: r.generated_summary.split("|") for r in rows}
    assert got[3] == ["4", "summarize: Text number 3. And more.", "2", "128"]
    assert got[25][:2] == ["2", "summarize: nan"]
    assert all(int(v[0]) <= 4 for v in got.values())


def test_factory_runs_once_per_task(table):
    def factory():
        made = [0]

        def predict(texts, **settings):
            made[0] += 1
            return [str(made[0])] * len(texts)
        return predict

    rows = generation.summarize_table(table.coalesce(1), factory, batch_size=2).collect()
    assert max(int(r.generated_summary) for r in rows) == 13


def test_only_the_text_goes_to_python(table):
    plan = plan_of(generation.summarize_table(table.selectExpr("*", "id * 2 AS extra"), generation.extractive_predictor()))
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan


def test_missing_text_column(table):
    with pytest.raises(KeyError):
        generation.summarize_table(table, generation.extractive_predictor(), "body")


def test_lead(spark):
    df = spark.createDataFrame([(1, "One. Two!  Three? Four."), (2, None), (3, "no end")], "id long, article string")
    got = {r.id: r.generated_summary for r in generation.summarize_lead(df, 2).collect()}
    assert got == {1: "One. Two!", 2: "", 3: "no end"}
    got = {r.id: r.generated_summary for r in generation.lead_words(df, 3).collect()}
    assert got == {1: "One. Two! Three?", 2: "", 3: "no end"}


def test_extractive(spark):
    text = "Cats purr. Dogs bark loudly. Cats like cats. Nothing else matters."
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, article string")
    got = {r.id: r.generated_summary for r in generation.summarize_extractive(df, 2).collect()}
    # "cats." carries its full stop and is no word of letters; "Cats like" scores (2 + 1) / 2.
    assert got == {1: "Cats purr. Cats like cats.", 2: "", 3: ""}


def test_length_stats(spark):
    df = spark.createDataFrame([("a b",), ("",), ("a b c d",)], "generated_summary string")
    row = generation.generation_length_stats(df).first()
    assert (row.mean_words, row.min_words, row.max_words) == (2.0, 0, 4)
    assert generation.generation_length_stats(df.limit(0)).count() == 0


def test_pairing_and_preview(spark):
    preds = spark.createDataFrame([(2, "p2"), (1, "p1")], "id long, generated_summary string")
    refs = spark.createDataFrame([(1, "x" * 400, "r1"), (2, "y", None)], "id long, article string, highlights string")
    rows = {r.id: r for r in generation.comparison(generation.pair_predictions(preds, refs)).collect()}
    assert len(rows[1].article) == 300 and rows[1].generated_summary == "p1" and rows[2].reference_summary == "nan"
