import random
from collections import Counter

import pytest
from conftest import plan_of

from pairlab.functions.lcs import PositionMasks, lcs_length, lcs_positions, union_lcs_hits
from pairlab.functions.stem import porter_stem, rouge_stem
from pairlab.operators import rouge

# Examples of the paper's rules and of the small changes.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "radically": "radic", "differently": "differ", "vilely": "vile", "analogously": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formality": "formal",
    "sensitivity": "sensit", "sensibility": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "angularity": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "skies": "sky", "dying": "die", "news": "news", "enjoy": "enjoy", "cried": "cri", "died": "die", "spied": "spi",
    "lies": "lie",
}


def test_stems():
    assert {w: porter_stem(w) for w in STEMS} == STEMS


def test_short_tokens_are_not_stemmed():
    assert [rouge_stem(w) for w in ("ties", "his", "was", "bus")] == ["tie", "his", "was", "bus"]


def dp_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
    return t


def dp_positions(ref, can):
    t, i, j, out = dp_table(ref, can), len(ref), len(can), []
    while i > 0 and j > 0:
        if ref[i - 1] == can[j - 1]:
            out.insert(0, i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def brute_union_hits(ref_lines, can_lines):
    counts_r = Counter(x for line in ref_lines for x in line)
    counts_c = Counter(x for line in can_lines for x in line)
    hits = 0
    for line in ref_lines:
        union = sorted({p for can in can_lines for p in dp_positions(line, can)})
        for p in union:
            if counts_c[line[p]] > 0 and counts_r[line[p]] > 0:
                hits += 1
                counts_c[line[p]] -= 1
                counts_r[line[p]] -= 1
    return hits


def random_lists(seed, n, longest, letters):
    r = random.Random(seed)
    return [[r.randrange(letters) for _ in range(r.randrange(longest))] for _ in range(n)]


@pytest.mark.parametrize("letters", [2, 6, 40])
def test_lcs_against_dynamic_programming(letters):
    for a, b in zip(random_lists(1, 350, 40, letters), random_lists(2, 350, 40, letters)):
        assert lcs_length(a, b) == dp_table(a, b)[-1][-1]
        assert lcs_positions(a, PositionMasks(b), b) == dp_positions(a, b)


def test_trace_back_over_several_kept_rows():
    r = random.Random(5)
    a, b = [r.randrange(9) for _ in range(700)], [r.randrange(9) for _ in range(300)]
    assert lcs_positions(a, PositionMasks(b), b) == dp_positions(a, b)


@pytest.mark.parametrize("letters", [2, 5, 20])
def test_union_lcs_against_brute_force(letters):
    r = random.Random(3)
    for _ in range(200):
        ref = random_lists(r.random(), r.randrange(1, 5), 9, letters)
        can = random_lists(r.random(), r.randrange(1, 5), 9, letters)
        assert union_lcs_hits(ref, can) == brute_union_hits(ref, can)


CASES = [
    (1, "the quick brown fox jumps", "the quick brown fox jumps"),
    (2, "alpha beta", "gamma delta"),
    (3, "the the the the", "the cat and the dog"),
    (4, "", "some reference here"),
    (5, "some prediction", None),
    (6, "some prediction", ""),
    (7, "running dogs\nran home quickly", "a dog runs\nquick running home\ndogs"),
    (8, "Été 42 don't", "t 42 don"),
    (9, "one", "one"),
    (10, None, "a reference"),
    (11, "... !!!", "???"),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, "id long, generated_summary string, reference_summary string")


def tokens(value, stem=True):
    import re
    found = [t for t in re.split("[^a-z0-9]+", value.lower()) if t]
    return [rouge_stem(t) for t in found] if stem else found


def f1(overlap, n, m):
    p, r = (overlap / n if n else 0.0), (overlap / m if m else 0.0)
    return 2 * p * r / (p + r) if p + r else 0.0


def expected(pred, ref, stem=True):
    p, r = tokens(pred, stem), tokens(ref, stem)
    out = []
    for n in (1, 2):
        gp = Counter(tuple(p[i:i + n]) for i in range(len(p) - n + 1))
        gr = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
        out.append(f1(sum((gp & gr).values()), sum(gp.values()), sum(gr.values())))
    out.append(f1(dp_table(p, r)[-1][-1], len(p), len(r)))
    lines = [[tokens(x, stem) for x in t.split("\n") if x] for t in (ref, pred)]
    out.append(f1(brute_union_hits(*lines), len(p), len(r)))
    return [round(100 * x, 4) for x in out]


@pytest.mark.parametrize("stem", [True, False])
def test_rouge_rows(cases, stem):
    got = {r.id: [r.rouge1, r.rouge2, r.rougeL, r.rougeLsum] for r in rouge.rouge_rows(cases, stem).collect()}
    for i, pred, ref in CASES:
        assert got[i] == (expected(pred or "", ref, stem) if ref else [None] * 4), i


def test_single_scores_agree_with_the_combined_pass(cases):
    scored = cases.where("id not in (5, 6, 10)")
    combined = {r.id: r for r in rouge.rouge_rows(scored).collect()}
    parts = {"rouge1": rouge.rouge_n(scored, 1), "rouge2": rouge.rouge_n(scored, 2), "rougeL": rouge.rouge_l(scored),
             "rougeLsum": rouge.rouge_lsum(scored)}
    for name, df in parts.items():
        assert {r.id: round(100 * r.f1, 4) for r in df.collect()} == {i: r[name] for i, r in combined.items()}, name


def test_identical_texts_score_100(cases):
    row = rouge.rouge_corpus(cases.where("id = 1")).first()
    assert list(row) == [100.0] * 4


def test_f1_is_symmetric(cases):
    pairs = cases.where("id in (1, 2, 3, 7, 8)")
    swapped = pairs.selectExpr("id", "reference_summary AS generated_summary", "generated_summary AS reference_summary")
    for score in (lambda d: rouge.rouge_n(d, 1), lambda d: rouge.rouge_n(d, 2), rouge.rouge_l):
        assert {(r.id, round(r.f1, 9)) for r in score(pairs).collect()} == {(r.id, round(r.f1, 9)) for r in score(swapped).collect()}


def test_corpus_mean_per_group(cases):
    grouped = cases.where("id <= 3").selectExpr("*", "id % 2 AS grp")
    got = {r.grp: r.rouge1 for r in rouge.rouge_corpus(grouped, ["grp"]).collect()}
    each = {i: expected(p, r)[0] for i, p, r in CASES[:3]}
    assert got == {1: pytest.approx((each[1] + each[3]) / 2, abs=1e-3), 0: each[2]}


def test_row_scores_need_no_shuffle(cases):
    for df in (rouge.rouge_n(cases, 2), rouge.rouge_l(cases), rouge.rouge_lsum(cases), rouge.rouge_rows(cases)):
        assert "Exchange" not in plan_of(df)
    # The corpus mean moves one partial sum per task.
    assert plan_of(rouge.rouge_corpus(cases)).count("Exchange") == 1


def test_stems_and_subsequences_share_one_python_worker(cases):
    for scored in (rouge.rouge_l(cases), rouge.rouge_lsum(cases)):
        assert plan_of(scored).count("ArrowEvalPython") == 1


def test_stem_map(spark):
    df = spark.createDataFrame([("Running runs", ), ("run RUNNING cats!",)], "t string")
    assert {(r.token, r.stem) for r in rouge.stem_map(df, "t").collect()} == {
        ("running", "run"), ("runs", "run"), ("run", "run"), ("cats", "cat")}


def test_other_separators(spark):
    df = spark.createDataFrame([(1, "élan vert", "lan vert")], "id long, generated_summary string, reference_summary string")
    assert rouge.rouge_n(df, 1, stem=False).first().p == 1.0
    keep_letters = r"[^\p{L}\p{N}]+"
    assert rouge.rouge_n(df, 1, stem=False, separators=keep_letters).first().p == 0.5
    assert rouge.rouge_rows(df, separators=keep_letters).first().rougeLsum == 50.0


def test_evaluation_in_one_row(spark, cases):
    from pairlab.plans.evaluate import evaluate
    from pairlab.sources.sinks import Throughput

    vectors = spark.createDataFrame(
        [(1, "pred", 0, [1.0, 0.0]), (1, "ref", 0, [1.0, 0.0])], "id long, side string, pos long, vec array<float>"
    )
    row = evaluate(cases.where("id in (1, 2)"), token_embeddings=vectors, throughput=Throughput(4, 2.0)).first()
    assert (row.rouge1, row.mean_words, row.match_f1, row.avg_latency_sec_per_sample) == (50.0, 3.5, 1.0, 0.5)
    grouped = evaluate(cases.where("id in (1, 2)"), group_cols=["id"])
    assert {r.id: r.rouge1 for r in grouped.collect()} == {1: 100.0, 2: 0.0}


def test_empty_reference_counts_as_zero_in_the_corpus(cases):
    """Rows alone have no score without a reference; in a mean an empty reference is a miss, a null is no row."""
    assert rouge.rouge_corpus(cases.where("id in (1, 6)")).first().rouge1 == 50.0
    assert rouge.rouge_corpus(cases.where("id in (1, 5)")).first().rouge1 == 100.0
    assert rouge.rouge_rows(cases.where("id = 6")).first().rouge1 is None


def test_one_tokenizer_for_all_scores(spark):
    df = spark.createDataFrame([(1, "a b\nc d", "a\nb c e")], "id long, generated_summary string, reference_summary string")
    by_text = rouge.rouge_n(df, 1, stem=False, separators=" ").first().f1
    assert rouge.with_f1(df, stem=False, separators=" ").first().rouge1 == pytest.approx(by_text)
    assert by_text == pytest.approx(0.75)
