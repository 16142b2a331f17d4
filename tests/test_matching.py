import numpy as np
import pytest

from pairlab.operators import matching


def brute(rows):
    out = {}
    for i in {r[0] for r in rows}:
        sides = {s: [np.array(v, dtype=np.float64) for k, t, _, v in rows if k == i and t == s] for s in ("pred", "ref")}

        def mean_best(a, b):
            cos = lambda x, y: x @ y / (np.linalg.norm(x) * np.linalg.norm(y))
            return np.mean([max(cos(x, y) for y in b) for x in a]) if a and b else 0.0

        p, r = mean_best(sides["pred"], sides["ref"]), mean_best(sides["ref"], sides["pred"])
        out[i] = (p, r, 2 * p * r / (p + r) if p + r else 0.0)
    return out


@pytest.fixture(scope="module")
def rows():
    g = np.random.default_rng(7)
    made = []
    # One pair holds most of the rows, one has a single side.
    for i, (n, m) in enumerate([(40, 25), (1, 1), (3, 0), (5, 2)]):
        made += [(i, "pred", k, g.normal(size=6).tolist()) for k in range(n)]
        made += [(i, "ref", k, g.normal(size=6).tolist()) for k in range(m)]
    return made


@pytest.mark.parametrize("block", [1024, 7, 1])
def test_against_brute_force(spark, rows, block):
    df = spark.createDataFrame(rows, "id long, side string, pos long, vec array<float>")
    got = {r.id: (r.precision, r.recall, r.f1) for r in matching.greedy_match_score(df, block=block).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for i in want:
        assert got[i] == pytest.approx(want[i], abs=1e-5), i


def test_corpus(spark, rows):
    df = spark.createDataFrame(rows, "id long, side string, pos long, vec array<float>")
    row = matching.greedy_match_corpus(df).first()
    assert row.match_precision == pytest.approx(np.mean([v[0] for v in brute(rows).values()]), abs=1e-4)


def test_positions_may_be_sparse_and_negative(spark):
    g = np.random.default_rng(3)
    rows = [(1, side, pos, g.normal(size=4).tolist()) for side in ("pred", "ref") for pos in (0, 10**9, -7)]
    df = spark.createDataFrame(rows, "id long, side string, pos long, vec array<float>")
    row = matching.greedy_match_score(df).first()
    assert (row.precision, row.recall, row.f1) == pytest.approx(brute(rows)[1], abs=1e-5)
