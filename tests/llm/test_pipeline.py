"""The stages on the smallest tables, each against a plain version of its decision."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pairlab.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder, docs, kept = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(docs)
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return [*kept, docs]


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_and_rows(steps):
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    for before, after in zip(steps, steps[1:]):
        assert ids(after) <= ids(before)
    assert steps[-1].columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and ids(steps[-1]) == ids(steps[-2])


def test_clean_labels_stay_and_junk_goes(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = ids(steps[1])
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in junk) <= 0.3 * len(junk)


def test_one_of_each_group_stays(steps):
    from test_small import brute_components

    want = brute_components([(r.doc_id, r.text) for r in steps[1].collect()], 5)
    assert ids(steps[2]) == {i for i, (_, _, kept) in want.items() if kept}


def test_repeats_are_cut(steps):
    from test_small import brute_removed

    before = [(r.doc_id, r.text) for r in steps[2].collect()]
    hits = brute_removed(before, corpus_pipeline.REPEATED_BYTES, lambda t: t.encode())
    after = {r.doc_id: r.text for r in steps[3].collect()}
    for i, text in before:
        _, hit = hits[i]
        if not any(hit):
            assert after[i] == text
        elif i in after:
            at, kept = 0, []
            for c in text:
                width = len(c.encode())
                kept += [] if all(hit[at:at + width]) else [c]
                at += width
            assert after[i] == "".join(kept)


def test_documents_with_items_go(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = ids(steps[3]) - ids(steps[4])
    for r in steps[3].collect():
        held = any(" ".join(t.split()) in " ".join(r.text.split()) for t in items)
        assert (r.doc_id in gone) == held


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        assert sorted(rows) == sorted(con.execute(ORACLES[name]).fetchall())
    assert rows or name == "op5_decontamination"
