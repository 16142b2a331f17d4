import json

import pandas as pd
import pytest

from pairlab.functions.text import NULL_SPELLINGS
from pairlab.operators import generation
from pairlab.plans import evaluate as scoring
from pairlab.sources import readers, sinks

HEADER = "article,highlights,url\n"


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    body = 'x' * 250
    (folder / "train.csv").write_text(
        HEADER + f'"(CNN) -- {body}\nsecond ""quoted"" line","a summary, with a comma and more",u1\n'
        + f'"(CNN) -- {body}\nsecond ""quoted"" line","a summary, with a comma and more",u2\n'
        + "NA,some summary,u3\n" + f'{body},"",u4\n', encoding="utf-8")
    (folder / "test.csv").write_text("highlights,article\n" + f"another summary of twenty chars,{body} é\n", encoding="utf-8")
    (folder / "validation.csv").write_text("", encoding="utf-8")
    return str(folder)


def test_validate_source(spark, raw):
    rows = {r.file: r for r in readers.validate_source(spark, raw, ["train.csv", "validation.csv", "none.csv"]).collect()}
    assert [rows[f].ok for f in ("train.csv", "validation.csv", "none.csv")] == [True, False, False]
    assert rows["train.csv"].n_bytes > 500 and rows["none.csv"].path is None
    with pytest.raises(FileNotFoundError, match="none.csv"):
        readers.require_source(spark, raw, ["train.csv", "none.csv"])


def test_validate_source_searches_below(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "a.csv").write_text("x")
    assert readers.validate_source(spark, str(tmp_path), ["a.csv"]).first().ok


def test_read_pairs_csv(spark, raw):
    df = readers.read_pairs_csv(spark, raw)
    rows = {r.url: r for r in df.where("split = 'train'").collect()}
    assert rows["u1"].article.endswith('\nsecond "quoted" line') and rows["u1"].highlights == "a summary, with a comma and more"
    assert rows["u3"].article is None and rows["u4"].highlights is None
    only_test = df.where("split = 'test'").first()
    assert only_test.article.endswith("é") and only_test.url is None


def test_no_split_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_pairs_csv(spark, str(tmp_path))
    assert readers.read_pairs_csv(spark, str(tmp_path), require_any=False).count() == 0


def test_null_spellings_match_pandas(spark, tmp_path):
    path = tmp_path / "nulls.csv"
    values = NULL_SPELLINGS + ["Null", "NIL", "na", "0", " ", "none"]
    path.write_text("k,v\n" + "".join(f"{i},{v}\n" for i, v in enumerate(values)))
    ours = {int(r.k) for r in readers.read_csv(spark, str(path)).where("v is null").collect()}
    theirs = pd.read_csv(path)
    assert ours == set(theirs.k[theirs.v.isna()])


def test_csv_cases_match_pandas(spark, tmp_path):
    frame = pd.DataFrame({"a": ['line\nbreak', 'dou"ble', "", " pad ", "x,y", 'back\\slash', '"'], "b": list("1234567")})
    path = tmp_path / "cases.csv"
    frame.to_csv(path, index=False)
    ours = {r.b: r.a for r in readers.read_csv(spark, str(path)).collect()}
    assert ours == {b: (a or None) for a, b in zip(frame.a, frame.b)}
    sinks.write_csv(spark.createDataFrame(frame), str(tmp_path / "out"))
    back = pd.concat([pd.read_csv(p) for p in (tmp_path / "out").glob("part-*.csv")])
    assert {str(b): a for a, b in zip(back.a.fillna(""), back.b)} == {b: a for a, b in zip(frame.a, frame.b)}


def test_run_preprocessing(spark, raw, tmp_path):
    target = str(tmp_path / "processed")
    counts = {r.split: r.num_rows for r in scoring.run_preprocessing(spark, raw, target).collect()}
    assert counts == {"train": 1, "test": 1}
    kept = readers.read_split(spark, target, "train").first()
    assert kept.article.startswith("xxx") and kept.url == "u1"
    assert readers.read_split(spark, target, "validation").count() == 0
    with pytest.raises(ValueError):
        readers.read_split(spark, target, "dev")
    with pytest.raises(FileNotFoundError):
        readers.read_processed(spark, str(tmp_path / "nowhere"))
    stats = [json.loads(line) for line in (tmp_path / "processed_stats").glob("part-*").__next__().read_text().splitlines()]
    assert stats == [{"num_rows": {"test": 1, "train": 1}}]


def test_ingest_keeps_what_is_there(spark, raw, tmp_path):
    target = str(tmp_path / "table")
    first = sinks.ingest_local(spark, raw, target)
    before = sorted((r.id, r.article) for r in first.collect() if r.article)
    assert len({r.id for r in first.collect()}) == 5
    again = sinks.ingest_local(spark, raw, target)
    assert sorted((r.id, r.article) for r in again.collect() if r.article) == before


def test_summarize_csv_and_folder(spark, raw, tmp_path):
    shout = lambda: lambda texts, **settings: [t[:8].upper() for t in texts]
    out = scoring.summarize_csv(spark, f"{raw}/train.csv", shout, str(tmp_path / "out"))
    assert {r.url: r.generated_summary for r in out.collect()} == {"u1": "(CNN) --", "u2": "(CNN) --", "u3": "NAN", "u4": "XXXXXXXX"}
    with pytest.raises(KeyError):
        scoring.summarize_csv(spark, f"{raw}/train.csv", shout, str(tmp_path / "o2"), text_col="body")
    folder = tmp_path / "texts"
    folder.mkdir()
    for name in ("b", "a.v2"):
        (folder / f"{name}.txt").write_text(f"text of {name}\nsecond line é", encoding="utf-8")
    (folder / "skip.md").write_text("no")
    done = scoring.summarize_folder(spark, str(folder), shout, str(tmp_path / "sums"))
    assert [(r.file_stem, r.generated_summary) for r in done.collect()] == [("a.v2", "TEXT OF "), ("b", "TEXT OF ")]


def test_evaluate_table(spark, tmp_path):
    rows = [(i, "test", f"First sentence {i}. Second one. Third here.", f"First sentence {i}.") for i in range(30)]
    df = spark.createDataFrame(rows, "id long, split string, article string, highlights string")
    out = str(tmp_path / "scores")
    results = scoring.evaluate_table(df, lambda: lambda texts, **s: [t.split(".")[0] + "." for t in texts], out, preset="dev", max_samples=10)
    row = results.first()
    assert (row.rouge1, row.rougeLsum, row.min_words, row.max_words) == (100.0, 100.0, 3, 3)
    assert row.avg_latency_sec_per_sample > 0
    saved = json.loads(next((tmp_path / "scores" / "evaluation_results").glob("part-*")).read_text())
    assert saved["rouge2"] == 100.0
    table = readers.read_csv(spark, f"{out}/predictions_vs_references")
    assert table.count() == 10 and table.columns == ["article", "reference_summary", "generated_summary"]


def test_single_text_with_and_without_reference(spark):
    df = spark.createDataFrame([(1, "One. Two.", "one"), (2, "One. Two.", None)], "id long, article string, reference_summary string")
    got = {r.id: r for r in scoring.summarize_single(df, generation.extractive_predictor(1)).collect()}
    assert got[1].generated_summary == "One." and got[1].rouge1 == 100.0 and got[2].rouge1 is None


def test_the_file_in_the_folder_itself_wins(spark, tmp_path):
    (tmp_path / "backup").mkdir()
    (tmp_path / "old").mkdir()
    (tmp_path / "train.csv").write_text("article,highlights\na,b\n")
    (tmp_path / "backup" / "train.csv").write_text("article,highlights\n" + "c,d\n" * 9)
    assert [r.article for r in readers.read_pairs_csv(spark, str(tmp_path)).collect()] == ["a"]
    for folder in ("backup", "old"):
        (tmp_path / folder / "test.csv").write_text("article,highlights\ne,f\n")
    with pytest.raises(ValueError):
        readers.read_pairs_csv(spark, str(tmp_path))


def test_empty_and_none_like_summaries_are_returned(spark, tmp_path):
    (tmp_path / "in.csv").write_text("article\nx\ny\n")
    made = lambda: lambda texts, **settings: ["" if t == "x" else "None" for t in texts]
    out = scoring.summarize_csv(spark, str(tmp_path / "in.csv"), made, str(tmp_path / "out"))
    assert {r.article: r.generated_summary for r in out.collect()} == {"x": "", "y": "None"}


def test_run_profile(spark, raw, tmp_path):
    made = scoring.run_profile(spark, raw, str(tmp_path / "profile")).first()
    saved = json.loads(next((tmp_path / "profile").glob("part-*")).read_text())
    assert saved["num_total_rows"] == made.num_total_rows == 5
