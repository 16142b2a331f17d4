"""Samples whose digests collide, extractive summaries as a plan, counts and seconds of real runs, resampling, streams,
leakage between splits, malformed lines, vocabularies of both sizes."""

import hashlib
import random
from collections import defaultdict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from pairlab.operators import dedup, features, generation, rouge, sampling, words
from pairlab.plans import evaluate
from pairlab.plans.preprocess import preprocess, step_row_counts
from pairlab.sources import readers, scratch, sinks
from pairlab.streaming import stateless


def digest(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_ids_whose_digests_share_eight_digits(spark):
    found = defaultdict(list)
    for i in range(400_000):
        found[digest(i)[:8]].append(i)
    pairs = [ids for ids in found.values() if len(ids) > 1]
    assert len(pairs) > 3
    for ids in pairs:
        first = min(ids, key=digest)
        rows = spark.createDataFrame([(i, "x" * k) for i in ids for k in (1, 2)][::-1], "id long, t string")
        assert {r.id for r in sampling.sample_exact(rows, 2).collect()} == {first}
        assert {r.id for r in sampling.sample_exact(rows, 1).collect()} == {first}


@pytest.mark.parametrize("n", [1, 39, 40, 41, 55, 90, 100])
def test_equal_rows_are_counted_not_ranked(spark, n):
    """One id on 40 equal rows, 30 different ones and 20 others; each row comes at most as often as it is there."""
    values = ["same"] * 40 + [f"d{k}" for k in range(30)]
    df = spark.createDataFrame([(7, v) for v in values] + [(k + 100, "o") for k in range(20)], "id long, v string").repartition(4)
    got = [tuple(r) for r in sampling.sample_exact(df, n).collect()]
    assert len(got) == min(n, 90)
    there = [tuple(r) for r in df.collect()]
    assert all(got.count(r) <= there.count(r) for r in set(got))
    order = sorted(range(90), key=lambda k: digest(there[k][0]))
    whole = [there[k] for k in order[:n] if there[k][0] != 7]
    assert sorted(r for r in got if r[0] != 7) == sorted(whole)


def test_a_sample_is_one_filtered_scan(spark, tmp_path):
    spark.range(5_000).selectExpr("id", "repeat('t', 50) AS t").write.parquet(str(tmp_path / "t"))
    plan = plan_of(sampling.sample_exact(spark.read.parquet(str(tmp_path / "t")), 40))
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan and "Window" not in plan


def test_extractive_plan_has_no_python_and_equals_the_predictor(spark):
    draw = random.Random(2)
    vocabulary = ["alpha", "beta", "gamma", "the", "x1", "délta", "of"]
    texts = [" ".join(draw.choice(vocabulary) + draw.choice(["", "", ".", "!", "  \n"]) for _ in range(draw.randint(0, 60))) for _ in range(80)]
    rows = list(enumerate([*texts, texts[3], "", "...", None]))
    df = spark.createDataFrame(rows, "id long, article string")
    made = generation.summarize_extractive(df, 2)
    assert "Python" not in plan_of(made) and "ArrowEval" not in plan_of(made)
    predictor = generation.extractive_predictor(2)()
    assert {r.id: r.generated_summary for r in made.collect()} == {i: predictor([t or ""])[0] for i, t in rows}


def test_extractive_plan_on_a_very_long_text(spark):
    text = " ".join(f"word{'abcdefgh'[k % 8]} thing{'xyz'[k % 3]}." for k in range(100_000))
    df = spark.createDataFrame([(1, text)], "id long, article string")
    assert generation.summarize_extractive(df).first().generated_summary == "worda thingx. wordb thingy. wordc thingz."


def test_extractive_work_stays_in_its_row(spark):
    df = spark.createDataFrame([(1, "one two. two two. three.")], "id long, article string")
    plan = plan_of(generation.summarize_extractive(df, 1))
    assert not any(node in plan for node in ("Exchange", "Sort", "Window", "Generate"))


def test_words_of_a_large_vocabulary_meet_it_once_a_block(spark):
    rows = [(k % 7, "the cat sat the cat", "x the" if k % 2 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, article string, highlights string").coalesce(1)
    vocab = features.build_vocab(df, size=None)
    joined = features.encode_pairs(df, vocab, 8, 4, in_memory=0)
    assert joined.exceptAll(features.encode_pairs(df, vocab, 8, 4)).isEmpty() and joined.count() == 200
    paths = {f for f in joined.inputFiles() if "/blocks-" in f}
    blocks = spark.read.parquet(*paths)
    assert blocks.selectExpr("sum(size(items))").first()[0] <= 5 * len(paths)


def test_seconds_of_the_predictor(spark):
    df = spark.range(50).select("id", F.lit("a text").alias("article")).repartitionById(4, (F.col("id") % 4).cast("int"))
    made = generation.summarize_table(df, generation.extractive_predictor(), batch_size=5, timing_col="timing")
    rows = {r.task: r for r in generation.predictor_seconds(made).collect()}
    assert {t: (r.num_rows, r.num_batches) for t, r in rows.items()} == {0: (13, 3), 1: (13, 3), 2: (12, 3), 3: (12, 3)}
    assert all(r.seconds > 0 for r in rows.values())


def test_step_counts_come_from_the_run(spark, pairs_small, tmp_path):
    target = str(tmp_path / "out")
    got = [tuple(r) for r in evaluate.write_preprocessed(pairs_small, target).collect()]
    assert got == [tuple(r) for r in step_row_counts(pairs_small).collect()]
    assert spark.read.parquet(target).count() == got[-1][2]


def test_step_counts_after_a_stage_ran_again(pairs_small, tmp_path, monkeypatch):
    """Counts that may hold a row twice are not used."""
    monkeypatch.setattr(sinks, "counted_write", lambda df, seen, write: write(df))
    got = [tuple(r) for r in evaluate.write_preprocessed(pairs_small, str(tmp_path / "out")).collect()]
    assert got == [tuple(r) for r in step_row_counts(pairs_small).collect()]


def test_interval_equals_resampling_by_hand(spark):
    draw = random.Random(8)
    rows = [(i, draw.random() if i % 9 else None) for i in range(200)]
    got = rouge.rouge_interval(spark.createDataFrame(rows, "id long, rouge1 double"), ("rouge1",), resamples=20).first()
    means = []
    for r in range(1, 21):
        total = weight = 0
        for i, score in rows:
            u = int(hashlib.md5(f"{r}:{i}".encode()).hexdigest()[:8], 16) / 2**32
            w = sum(u >= p for p in rouge.POISSON)
            if score is not None:
                total, weight = total + w * score, weight + w
        means.append(total / weight)
    means.sort()

    def at(q):
        place = q * 19
        low = int(place)
        return means[low] + (place - low) * (means[min(low + 1, 19)] - means[low])

    assert (got.low, got.mid, got.high) == pytest.approx([100 * at(q) for q in (0.025, 0.5, 0.975)], abs=1e-4)
    nothing = spark.createDataFrame([], "id long, rouge1 double")
    assert rouge.rouge_interval(nothing, ("rouge1",)).first().mid is None


def test_a_stream_goes_on_where_it_stopped(spark, pairs_small, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    pairs_small.where("id < 5").repartition(2).write.parquet(source)
    assert sum(stateless.run_preprocess_stream(spark, source, target, checkpoint, max_files=1)) == 4
    assert sum(stateless.run_preprocess_stream(spark, source, target, checkpoint)) == 0
    pairs_small.where("id >= 5").write.mode("append").parquet(source)
    assert sum(stateless.run_preprocess_stream(spark, source, target, checkpoint)) == 4
    want = sorted(r.id for r in preprocess(pairs_small, use_drop_duplicates=False).collect())
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == want


def test_leakage_between_splits(spark):
    rows = [("a", "x", None), ("b", "x", None), ("b", "x", None), ("c", "x", "y"), ("a", "x", "y"), ("c", "z", "z"), ("other", "z", "z"), (None, "x", "y")]
    df = spark.createDataFrame(rows, "split string, article string, highlights string")
    got = {(r.split_a, r.split_b): r.n_pairs for r in dedup.split_leakage(df, ("a", "b", "c")).collect()}
    assert got == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 0}
    assert {r.n_pairs for r in dedup.split_leakage(df.limit(0), ("a", "b")).collect()} == {0}


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text\n1,"a ""b"", c"\n2\n3,x,y\n"4,never closed\n5,\n6,nan\n')
    aside = str(tmp_path / "aside")
    good = readers.read_csv_strict(spark, str(tmp_path / "in.csv"), ["id", "text"], aside)
    assert sorted(map(tuple, good.collect())) == [("1", 'a "b", c'), ("5", None), ("6", None)]
    bad = spark.read.parquet(aside).collect()
    assert sorted(r.line for r in bad) == ['"4,never closed', "2", "3,x,y"] and all(r.path.endswith("in.csv") for r in bad)


def test_ties_in_order_of_first_places(spark):
    df = spark.createDataFrame([(2, "beta alpha"), (1, "gamma delta gamma"), (3, "beta alpha delta")], "id long, highlights string")
    got = [tuple(r) for r in words.top_words(df, 3, ties="first").collect()]
    assert got == [("gamma", 2), ("delta", 2), ("beta", 2)]
    assert [r.term for r in words.top_words(df, 3).collect()] == ["alpha", "beta", "delta"]
    with pytest.raises(ValueError):
        words.top_words(df, ties="last")


def test_vocabularies_in_memory_and_joined_agree(spark):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, None]), " ".join(draw.choices(["a", "b", "c", "zz"], k=k % 7)) if k % 5 else None, "b") for k in range(40)]
    df = spark.createDataFrame(rows, "id long, article string, highlights string")
    vocab = spark.createDataFrame([("a", 3), ("b", 9), ("c", 1_000_000)], "token string, token_id long")
    few, many = (sorted(map(str, features.encode_pairs(df, vocab, 6, 3, in_memory=limit).collect())) for limit in (3, 2))
    assert few == many
    codes = features.encode_pairs(df, vocab, 6, 3).unionByName(
        spark.createDataFrame([(9, None, None, None)], "id long, input_ids array<int>, attention_mask array<int>, labels array<int>")
    )
    few, many = (sorted(map(str, features.decode_ids(codes, vocab, "input_ids", in_memory=limit).collect())) for limit in (3, 2))
    assert few == many
    assert "Exchange" not in plan_of(features.encode_pairs(df, vocab, 6, 3))


def test_all_words_are_numbered_in_order(spark):
    df = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k % 50, 50))) for k in range(200)], "id long, highlights string")
    vocab = features.build_vocab(df, ("highlights",), size=None).collect()
    want = sorted(((r.n, r.token) for r in vocab), key=lambda x: (-x[0], x[1]))
    assert [(r.n, r.token) for r in sorted(vocab, key=lambda r: r.token_id)] == want
    assert sorted(r.token_id for r in vocab) == list(range(3, 53))


def test_groups_have_their_own_match(spark):
    scored = spark.createDataFrame([(1, "a", "x", "x"), (2, "b", "x y", "x"), (3, None, "z", "x")], "id long, grp string, generated_summary string, reference_summary string")
    tokens = [(1, "pred", 0, [1.0, 0.0]), (1, "ref", 0, [1.0, 0.0]), (2, "pred", 0, [1.0, 0.0]), (2, "ref", 0, [0.0, 1.0]), (3, "pred", 0, [3.0, 4.0]), (3, "ref", 0, [1.0, 0.0])]
    vectors = spark.createDataFrame(tokens, "id long, side string, pos long, vec array<float>")
    got = {r.grp: (r.match_f1, r.rouge1) for r in evaluate.evaluate(scored, group_cols=["grp"], token_embeddings=vectors).collect()}
    assert got == {"a": (1.0, 100.0), "b": (0.0, 66.6667), None: (0.6, 0.0)}


def test_scratch_tables_can_be_discarded(spark):
    kept = scratch.materialize(spark.range(3), "kept")
    gone = scratch.materialize(spark.range(3), "gone")
    path = [p for p in scratch._written if "/kept-" in p][-1]
    assert scratch.discard(spark, keep=scratch._written[:-2] + [path]) == 1
    assert kept.count() == 3 and path in scratch._written
    with pytest.raises(Exception, match="gone"):
        spark.read.parquet(gone.inputFiles()[0])
