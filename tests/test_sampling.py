import hashlib

import pytest
from conftest import plan_of

from pairlab.operators import sampling


def first_by_digest(ids, n, seed=42):
    return sorted(sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:n])


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).selectExpr("id", "CASE id % 4 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 10, 700, 1999, 2000, 5000])
def test_exact_size_and_order_of_digests(rows, n):
    assert ids(sampling.sample_exact(rows, n)) == first_by_digest(range(2000), n)


def test_none_takes_all(rows):
    assert len(ids(sampling.sample_exact(rows, None))) == 2000


def test_stable_under_repartitioning_and_seeded(rows):
    assert ids(sampling.sample_exact(rows.repartition(7), 50)) == ids(sampling.sample_exact(rows, 50))
    assert ids(sampling.sample_exact(rows, 50, seed=7)) == first_by_digest(range(2000), 50, 7)


def test_digests_that_share_a_prefix(spark, monkeypatch):
    """Every row in one prefix: the ranking alone decides."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(sampling, "sample_rank", lambda seed, id_col="id": F.lpad(F.col(id_col).cast("string"), 12, "0"))
    assert ids(sampling.sample_exact(spark.range(300), 17)) == list(range(17))


def test_presets_per_split(rows):
    counts = {r.split: r["count"] for r in sampling.load_subset(rows, "dev").groupBy("split").count().collect()}
    assert counts == {"train": 500, "validation": 100, "test": 100}
    tests = [i for i in range(2000) if i % 4 == 0]
    assert ids(sampling.load_subset(rows, "dev").where("split = 'test'")) == first_by_digest(tests, 100)
    assert ids(sampling.load_subset_split(rows, "test", "dev")) == first_by_digest(tests, 100)
    assert len(ids(sampling.load_subset(rows, "full"))) == 2000


def test_unknown_preset_and_split(rows):
    with pytest.raises(KeyError):
        sampling.load_subset(rows, "huge")
    with pytest.raises(ValueError):
        sampling.load_subset_split(rows, "dev", "dev")


def test_head(rows):
    assert len(ids(sampling.head(rows, 0))) == len(ids(sampling.head(rows, None))) == 2000
    assert len(ids(sampling.head(rows, 3))) == 3


def test_plan_reads_ids_and_sorts_no_rows(rows):
    plan = plan_of(sampling.sample_exact(rows, 20))
    assert "TakeOrdered" not in plan and "NestedLoop" not in plan


def test_top_k_ranks_only_ties_at_the_cut(spark):
    counts = spark.range(500).selectExpr("concat('t', id) AS term", "id % 7 AS n")
    want = sorted(((r.term, r.n) for r in counts.collect()), key=lambda x: (-x[1], x[0]))
    for k in (1, 70, 120, 500, 900):
        assert [tuple(r) for r in sampling.top_k(counts, k).collect()] == want[:k]


@pytest.mark.parametrize("n", [0, 2, 7, 30, 100])
def test_repeated_and_null_ids(spark, n):
    rows = spark.range(30).selectExpr("CASE WHEN id < 12 THEN NULL ELSE id % 3 END AS id", "id AS x")
    got = [r.x for r in sampling.sample_exact(rows, n).collect()]
    assert len(got) == len(set(got)) == min(n, 30)


def test_sizes_given_by_the_caller(rows):
    counts = {r.split: r["count"] for r in sampling.load_subset(rows, {"train": 10, "validation": 0, "test": None}).groupBy("split").count().collect()}
    assert counts == {"train": 10, "test": 500}
